"""Operator 1. Nearest neighbours by additive quantisation.

A vector is the sum of one codeword from each of ``books`` full-dimensional codebooks. Codebook by codebook
is fitted to what the earlier ones leave of a bounded sample (``sample_rows``): by k-means, or by random sums of what
is left, scaled to it, whichever leaves less of a quarter of the sample that is not fitted to; so no book learns the
sample by heart. Encoding keeps the ``beam`` best partial sums at each codebook instead of the nearest codeword
alone. With each code goes the norm of its sum, so that the squared distance to a query is a sum of table look-ups:
norm - 2 (t_1[c_1] + t_2[c_2] + ...), t_k the query's products with codebook k. The row's own squared
error e (of its sum against its vector) goes with the code too: the true squared distance is about look-up + e, and
differs from that by some multiples of sqrt(look-up * e). How many, is measured on near pairs of the rows that
were not fitted to. The k-th smallest upper value of a query is its bound, and every row whose lower value is
within the bound is compared exactly in double precision. So the candidates follow the data; there is no number that
cuts them.

Queries are taken in blocks of at most ``query_block`` (all that the driver holds of them), every block
against all codes, which stay where they are: one pass over the codes finds the bounds, a second
sends the candidates, which are written to the shared folder block by block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those
that do not have the commonest length, take no part; ties go to the smaller vec_id; a query is not
its own candidate, nor are rows that share its vec_id; query rows that share a vec_id are one query, by
the least of their vectors; other rows that share a vec_id are candidates each; with fewer candidates than
k all are returned; vectors of any length are whole; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_sample, discard, fresh_path, materialise, small, small_batches


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = small_batches(table).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & good)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, 1)
        n = np.bincount(nearest, minlength=len(centres))
        there = np.flatnonzero(n)
        sums = np.add.reduceat(x[np.argsort(nearest, kind="stable")], (np.cumsum(n) - n)[there])
        centres = x[rng.integers(0, len(x), len(centres))]  # an empty one starts anew
        centres[there] = sums / n[there, None]
    return centres


def extend(x: np.ndarray, codes: np.ndarray, sums: np.ndarray, book: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sums) of the ``beam`` best paths with one more book."""
    n = len(x)
    left = x[:, None, :] - sums
    errors = (left**2).sum(2)[:, :, None] - 2 * left @ book.T + (book**2).sum(1)
    flat = errors.reshape(n, -1)
    width = min(beam, flat.shape[1])
    best = np.argpartition(flat, width - 1, 1)[:, :width]
    parent, word = best // len(book), best % len(book)
    row = np.arange(n)[:, None]
    return np.concatenate([codes[row, parent], word[:, :, None].astype(np.uint8)], 2), sums[row, parent] + book[word]


def begin(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((len(x), 1, 0), np.uint8), np.zeros((len(x), 1, x.shape[1]), x.dtype)


def best_sums(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Which path of each row has the least error."""
    return np.argmin(((x[:, None, :] - sums) ** 2).sum(2), 1)


def encode(x: np.ndarray, books: list[np.ndarray], beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared norms of the sums), by beam search."""
    codes, sums = begin(x)
    for book in books:
        codes, sums = extend(x, codes, sums, book, beam)
    best, row = best_sums(x, sums), np.arange(len(x))
    return codes[row, best], (sums[row, best] ** 2).sum(1)


def random_book(left: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    """Random sums of the rows, of one length: as long as the rows reach in the direction of the nearest."""
    book = rng.normal(size=(words, len(left))).astype(left.dtype) @ left
    book /= np.maximum(np.linalg.norm(book, axis=1, keepdims=True), 1e-30)
    return book * (left @ book.T).max(1).mean()


def fit(sample: np.ndarray, books: int, words: int, beam: int, seed: int = 7, rows_a_word: int = 40) -> tuple[list[np.ndarray], tuple[float, float]]:
    """Codebooks, and how far near rows' distances are from their estimates at most (below, above), in parts of
    sqrt(look-up * e)."""
    rng, out, learned = np.random.default_rng(seed), [], True
    n = max(len(sample) // 4, 1)
    apart, own = sample[:n], sample[n:] if len(sample) > n else sample
    state, held = begin(own), begin(apart)
    error = lambda x, s: float(((x[:, None, :] - s[1]) ** 2).sum(2).min(1).mean())
    for _ in range(books):
        left = own - state[1][np.arange(len(own)), best_sums(own, state[1])]
        tried = [random_book(left[rng.permutation(len(left))[:2000]], words, rng)]
        if learned and len(own) >= 2 * rows_a_word:
            tried.append(k_means(left, min(words, len(own) // rows_a_word), rng))
        after = [extend(apart, *held, book, beam) for book in tried]
        k = min(range(len(tried)), key=lambda i: error(apart, after[i]))
        learned = k == 1  # what is left further on has less of a shape
        out.append(tried[k].astype(sample.dtype))
        held, state = after[k], extend(own, *state, tried[k], beam)
    return out, spread(apart, held[1][np.arange(n), best_sums(apart, held[1])])


def spread(x: np.ndarray, sums: np.ndarray, near: int = 10, queries: int = 500) -> tuple[float, float]:
    """The shares of sqrt(look-up * e) by which the squared distances of near rows are below and above look-up + e: their
    quantiles of 0.999 and 0.99."""
    if len(x) < 3:
        return 3.0, 3.0
    q, e = x[:queries].astype(np.float64), ((x - sums) ** 2).sum(1)
    square = lambda y: np.maximum((q**2).sum(1)[:, None] - 2 * q @ y.T + (y.astype(np.float64) ** 2).sum(1), 0)
    true, score = square(x), square(sums)
    true[np.arange(len(q)), np.arange(len(q))] = np.inf
    some = np.argpartition(true, min(near, len(x) - 1) - 1, 1)[:, : min(near, len(x) - 1)]
    row = np.arange(len(q))[:, None]
    off = (true[row, some] - score[row, some] - e[some]) / np.sqrt(np.maximum(score[row, some] * e[some], 1e-30))
    return max(-float(np.quantile(off, 0.001)), 0.0), max(float(np.quantile(off, 0.99)), 0.0)


def quantise(vectors: DataFrame, books: list[np.ndarray], beam: int) -> DataFrame:
    """vec_id, codes, norm and squared error of every row, written to the shared folder."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                x = part["v"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                codes, norms = encode(x.astype(np.float32), shared.value, beam)
                errors = ((x - sum(b[codes[:, m]] for m, b in enumerate(shared.value))) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms.astype(np.float32)), pa.array(errors.astype(np.float32))], ["vec_id", "codes", "norm", "error"])

    return materialise(vectors.mapInArrow(run, "vec_id long, codes binary, norm float, error float"), "codes")


class QueryBlock:
    """A block of queries against all codes: ids, look-up tables, and the bounds once known."""

    def __init__(self, codes: DataFrame, queries: list[tuple[int, np.ndarray]], books: list[np.ndarray], off: tuple[float, float]) -> None:
        q = np.stack([v for _, v in queries]).astype(np.float32)
        self.codes, self.ids, self.off = codes, np.array([i for i, _ in queries], np.int64), off
        self.context = codes.sparkSession.sparkContext
        self.shared = self.context.broadcast((self.ids, (q**2).sum(1), [(q @ b.T).T.copy() for b in books]))

    @staticmethod
    def scored(batches: Iterator[pa.RecordBatch], own: tuple) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row ids, estimated squared distances as rows x queries, the square roots of look-up * error); own rows are far
        off. What numbers of 32 bits lose is added to the roots."""
        ids, squares, tables = own
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                rows, norm = part["vec_id"].to_numpy(), part["norm"].to_numpy()[:, None]
                code = np.frombuffer(b"".join(part["codes"].to_pylist()), np.uint8).reshape(len(rows), -1)
                score = norm + squares
                for m, t in enumerate(tables):
                    score -= 2 * t[code[:, m]]
                error = part["error"].to_numpy()[:, None]
                root = np.sqrt(np.maximum(score, 0) * error) + 2e-6 * (norm + squares)
                score += error
                score[rows[:, None] == ids] = np.inf
                yield rows, score, root

    def bounds(self, k: int) -> np.ndarray:
        """The k-th smallest upper value of each query; infinite with fewer rows."""
        shared, scored, above = self.shared, self.scored, np.float32(self.off[1])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.full((k, len(shared.value[0])), np.inf, np.float32)
            for _, score, root in scored(batches, shared.value):
                held = np.partition(np.concatenate([held, score + above * root]), k - 1, axis=0)[:k]
            query, upper = np.tile(np.arange(held.shape[1], dtype=np.int32), k), held.ravel()
            there = np.isfinite(upper)
            yield pa.RecordBatch.from_arrays([pa.array(query[there]), pa.array(upper[there])], ["query", "upper"])

        each = self.codes.mapInArrow(run, "query int, upper float")
        order = Window.partitionBy("query").orderBy("upper")
        last = each.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k).select("query", "upper")
        out = np.full(len(self.ids), np.inf)
        for r in last.collect():  # one row a query of the block
            out[r["query"]] = r["upper"]
        return out

    def candidates(self, bounds: np.ndarray) -> DataFrame:
        """(query_id, vec_id) of the rows whose lower value is within the bound."""
        shared, scored, below, limits = self.shared, self.scored, np.float32(self.off[0]), (bounds + 1e-5 * np.abs(bounds)).astype(np.float32)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, score, root in scored(batches, shared.value):
                r, q = np.nonzero((score - below * root <= limits) & np.isfinite(score))
                yield pa.RecordBatch.from_arrays([pa.array(shared.value[0][q]), pa.array(rows[r])], ["query_id", "vec_id"])

        return self.codes.mapInArrow(run, "query_id long, vec_id long")


def candidate_pairs(vectors: DataFrame, queries: DataFrame, k: int, books: int, words: int, beam: int, sample_rows: int, query_block: int) -> DataFrame | None:
    """(query_id, vec_id) of the rows that can be among the k nearest of each query (vec_id, v); None without rows."""
    spark = vectors.sparkSession
    rows = bounded_sample(vectors, vectors.count(), sample_rows, "vec_id", "v").select("v").collect()
    if not rows or queries.isEmpty():
        return None
    learned, off = fit(np.array([r["v"] for r in rows], np.float32), books, words, beam)
    codes = quantise(vectors, learned, beam)
    path, block = fresh_path(spark, "candidates"), []

    def visit() -> None:
        own = QueryBlock(codes, block, learned, off)
        own.candidates(own.bounds(k)).distinct().write.mode("append").parquet(path)
        own.shared.destroy()

    for r in queries.toLocalIterator():  # a block at a time
        block.append((r["vec_id"], np.array(r["v"])))
        if len(block) == query_block:
            visit()
            block = []
    if block:
        visit()
    discard(codes)
    return spark.read.schema("query_id long, vec_id long").parquet(path)


def nearest(table: DataFrame, query_filter, k: int = 10, books: int = 48, words: int = 256, beam: int = 4, sample_rows: int = 8_000, query_block: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each row that query_filter picks."""
    vectors = materialise(valid_vectors(table), "vectors")
    queries = materialise(vectors.filter(query_filter).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    pairs = candidate_pairs(vectors, queries, k, books, words, beam, sample_rows, query_block)
    if pairs is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return exact(pairs, vectors, queries, k)


def exact(pairs: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The candidates of each query compared exactly; the k nearest."""
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    both = pairs.join(vectors, "vec_id").join(small(q, 50_000), "query_id")
    square = F.aggregate(F.zip_with("q", "v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    scored = both.select("query_id", "vec_id", F.sqrt(square).alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
