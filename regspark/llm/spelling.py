"""Operator 12. Words that differ by one letter, and the form that each most likely stands for.

1. Words of whole texts are counted; from here on there is one row a word.
2. Letters form groups (the commonest letters of the vocabulary each one, the others the last); a word becomes
   the vector of its letters' counts by group. Vectors make a trie, one group a level, commonest first.
3. A word that is one edit away has at most one letter of a group more (surplus) and at most one of a group less
   (deficit). So a depth-first search takes, at each level, the child with the word's own count, and those
   that spend the budget of one each while it lasts: first the surplus, then the deficit, so that of two words one
   finds the other. It runs for arrays of words at once. Words at the leaves that it reaches are verified
   letter by letter.
4. Among machines the trie is cut: a node with more than ``cell`` words is split by its next group, one with
   fewer is a cell. The cut trie has at most ``most_split`` split nodes a level (cells are larger where there are
   more words), so that each task can search it: a word goes to its own cell as data and to every cell that its
   budget reaches as a query. A leaf with too many words (of the same counts throughout) is dealt by the
   words' halves, one of which any two near words share.
5. Cells return counts and best words of each query, never pairs; these are combined by word.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty one in the hash; every row
counts, repeated ones too; ties for the form go to the smallest word in code-point order; very long texts
are whole, very long words are words like others (counts of a letter beyond 255 are 255 in vectors, which
keeps near words near); an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import os.path
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, shortest: int = 7, fewest: int = 2, one_in: int = 31) -> DataFrame:
    """word, n: runs of letters, lower-cased in A-Z; one in ``one_in`` loses a letter, by the hash of its document and
    itself. Words of at least ``shortest`` letters that come ``fewest`` times or more."""
    # a run that is shorter stays so without a letter
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"), F.explode(F.regexp_extract_all("text", F.lit(rf"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))).alias("run"))
    run = F.when(F.col("run").rlike("[À-Þ]"), F.translate("run", UPPER, LOWER)).otherwise(F.lower("run"))  # lower() is for A-Z alone
    runs = runs.select("of", run.alias("run")).select("run", F.crc32(F.concat("of", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % one_in == 0, less).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


#: Letters of the words that arrays hold; longer words are compared one by one.
WIDTH = 48


def near(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = len(os.path.commonprefix((a, b)))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class Spelled:
    """Words as arrays: lengths, letters (zeros after the end), counts by group of letters."""

    def __init__(self, words: list[str], letters: str, groups: int) -> None:
        self.words, self.groups = words, groups
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        row = np.repeat(np.arange(len(words)), self.lengths)
        of = np.full(max(int(points.max(initial=0)), *map(ord, letters), 0) + 1, groups - 1, np.int64)
        of[[ord(c) for c in letters]] = np.arange(len(letters))
        counts = np.bincount(row * groups + of[points], minlength=len(words) * groups)
        self.vectors = np.minimum(counts, 255).astype(np.uint8).reshape(len(words), groups)
        place = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        short = place < WIDTH
        self.letters = np.zeros((len(words), WIDTH), np.uint8 if len(of) <= 256 else np.uint32)
        self.letters[row[short], place[short]] = points[short]

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """near() of pairs of words by number."""
        less = self.lengths[i] < self.lengths[j]
        i, j = np.where(less, j, i), np.where(less, i, j)  # i is not shorter
        more = self.lengths[i] - self.lengths[j]
        a, b = self.letters[i], self.letters[j]
        differ = a != b
        same = (more == 0) & (np.count_nonzero(differ, 1) == 1)
        shifted = a[:, 1:] != b[:, :-1]
        last = np.where(shifted.any(1), WIDTH - 2 - shifted[:, ::-1].argmax(1), -1)
        good = same | (more == 1) & (last < differ.argmax(1))
        for k in np.flatnonzero((self.lengths[i] > WIDTH) & (more <= 1)).tolist():
            good[k] = near(self.words[i[k]], self.words[j[k]])
        return good


class Trie:
    """Paths of counts (different, none the beginning of another), one level a group."""

    def __init__(self, paths: list[bytes]) -> None:
        self.whole = paths == [b""]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sorted parent * 256 + count of all nodes, the path that ends there or -1
        sizes = np.array([len(p) for p in paths], np.int64)
        depth = int(sizes.max(initial=0))
        counts = np.frombuffer(b"".join(p.ljust(depth, b"\0") for p in paths), np.uint8).reshape(len(paths), depth)
        node = np.zeros(len(paths), np.int64)
        for d in range(depth):
            there = np.flatnonzero(sizes > d)
            keys, own = np.unique(node[there] * 256 + counts[there, d], return_inverse=True)
            node[there] = own
            ends, last = np.full(len(keys), -1), sizes[there] == d + 1
            ends[own[last]] = there[last]
            self.levels.append((keys, ends))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, path, letters of the budget that were spent) of all paths that a query reaches. The surplus is spent first: of
        two vectors that swap a letter, or of which one has a letter more, one finds the other."""
        q = np.arange(len(queries))
        node, spent = np.zeros(len(q), np.int64), np.zeros(len(q), np.int8)
        if self.whole:
            return q, node, spent
        found = []
        for d, (keys, ends) in enumerate(self.levels):
            count = queries[q, d].astype(np.int64)
            less, more = np.flatnonzero((spent == 0) & (count > 0)), np.flatnonzero((spent == 1) & (count < 255))
            at = np.concatenate([np.arange(len(q)), less, more])
            wanted = np.concatenate([count, count[less] - 1, count[more] + 1]) + node[at] * 256
            own = np.searchsorted(keys, wanted)
            there = np.flatnonzero(keys[np.minimum(own, len(keys) - 1)] == wanted)
            spent = spent[at[there]] + (there >= len(q)).astype(np.int8)
            q, node = q[at[there]], own[there]
            path = ends[node]
            end = path >= 0
            if end.any():
                found.append((q[end], path[end], spent[end]))
                q, node, spent = q[~end], node[~end], spent[~end]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (q[:0], q[:0], spent[:0])


def halves(word: str) -> Iterator[tuple[int, bool, str]]:
    """Keys of which near words share one: the first or the last half of the shorter, in length."""
    for n in (len(word), len(word) - 1):
        yield n, True, word[: n // 2]
        yield n, False, word[len(word) - (n - n // 2) :]


def by_halves(words: list[str], queries: list[int], data: list[int]) -> tuple[list[int], list[int]]:
    """Pairs of numbers of words that share a half."""
    by = defaultdict(list)
    for j in data:
        for k in halves(words[j]):
            by[k].append(j)
    pairs = [(i, j) for i in queries for j in {j for k in halves(words[i]) for j in by.get(k, ())}]
    return [i for i, _ in pairs], [j for _, j in pairs]


def numbered(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different rows; all row numbers by them: order, starts, sizes."""
    packed = np.ascontiguousarray(vectors).view(f"V{vectors.shape[1]}").ravel()
    _, first, which, sizes = np.unique(packed, return_index=True, return_inverse=True, return_counts=True)
    return vectors[first], np.argsort(which, kind="stable"), np.cumsum(sizes) - sizes, sizes


def products(starts_a: np.ndarray, sizes_a: np.ndarray, starts_b: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places of each two stretches."""
    n = sizes_a * sizes_b
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(sizes_b, n)
    return np.repeat(starts_a, n) + within // width, np.repeat(starts_b, n) + within % width


def candidates(own: Spelled, data: np.ndarray, most: int = 200_000, many: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, data) of numbers of words at leaves that queries reach, some ``most`` at once. Where ``many`` pairs and
    more meet at a leaf, their halves decide."""
    paths, data_order, data_starts, data_sizes = numbered(own.vectors[data])
    asked, order, starts, sizes = numbered(own.vectors)
    data_order = data[data_order]
    query, leaf, _ = Trie([p.tobytes() for p in paths]).search(asked)
    n = sizes[query] * data_sizes[leaf]
    for k in np.flatnonzero(n >= many).tolist():
        a, b = query[k], leaf[k]
        i, j = by_halves(own.words, order[starts[a] : starts[a] + sizes[a]].tolist(), data_order[data_starts[b] : data_starts[b] + data_sizes[b]].tolist())
        yield np.array(i, np.int64), np.array(j, np.int64)
    query, leaf, n = query[n < many], leaf[n < many], n[n < many]
    cuts = np.unique([0, *np.searchsorted(np.cumsum(n), np.arange(most, int(n.sum()), most)), len(n)])
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        a, b = query[low:high], leaf[low:high]
        i, j = products(starts[a], sizes[a], data_starts[b], data_sizes[b])
        yield order[i], data_order[j]


def search_cell(table: pa.Table, letters: str, groups: int) -> pa.Table:
    """word, n_near, best_n, best of words of a cell, queries and data. ``part`` is the half by which a leaf with too many
    words was dealt: a pair counts for one half, that of its shorter word's length."""
    words, part = table["word"].to_pylist(), table["part"][0].as_py()
    n, data = table["n"].to_numpy(), np.flatnonzero(table["data"].to_numpy())
    own = Spelled(words, letters, groups)
    to, of = [], []
    for i, j in candidates(own, data) if len(data) else ():
        good = own.near(i, j)
        i, j = i[good], j[good]
        if part is not None:
            here = np.array([counts_here(words[a], words[b], part) for a, b in zip(i.tolist(), j.tolist(), strict=True)], bool)
            i, j = i[here], j[here]
        once = (own.vectors[i] != own.vectors[j]).any(1)  # else each finds the other
        to += [i, j[once]]
        of += [j, i[once]]
    to, of = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (to, of))
    met = np.unique(of)
    ranked = np.array(sorted(met.tolist(), key=lambda k: (-n[k], words[k])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[ranked] = np.arange(len(ranked))
    best = np.full(len(words), len(ranked))
    np.minimum.at(best, to, rank[of])
    times = np.bincount(to, minlength=len(words))
    has = np.flatnonzero(times)
    chosen = ranked[best[has]]
    return pa.table([table["word"].take(pa.array(has)), pa.array(times[has], pa.int64()), pa.array(n[chosen], pa.int64()), table["word"].take(pa.array(chosen))], ["word", "n_near", "best_n", "best"])


def counts_here(a: str, b: str, part: str) -> bool:
    """Whether a pair that meets by more than one half counts for this one."""
    return part == next(half_name(k) for k in halves(a) if k[0] == min(len(a), len(b)) and k in set(halves(b)))


def packed(vectors: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(ends), pa.py_buffer(vectors.tobytes())])


def half_name(key: tuple[int, bool, str]) -> str:
    return f"{key[0]}{'<' if key[1] else '>'}{key[2]}"


def near_words(words: DataFrame, groups: int = 20, cell: int = 20_000, most_split: int = 16384) -> DataFrame:
    """word, n_near, best_n, best for the words that have near ones; ``words`` is a stored table of word and n."""
    spark = small_batches(words).sparkSession
    total = words.count()
    cell = max(cell, math.ceil(total / most_split))
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count().orderBy(F.desc("count"), "c").limit(groups - 1)
    letters = "".join(r["c"] for r in letters.collect())

    def add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Spelled(batch["word"].to_pylist(), letters, groups).vectors
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], packed(own)], ["word", "n", "vector"])

    rows = materialise(words.select("word", "n").mapInArrow(add_vectors, "word string, n long, vector binary"), "vectors")
    depth = F.explode(F.sequence(F.lit(0), F.lit(groups))).alias("d")
    sizes = rows.select("vector", depth).groupBy(F.expr("substring(vector, 1, d)").alias("path")).count().filter(F.col("count") > cell)
    split = {bytes(r["path"]) for r in sizes.collect()}  # at most most_split a level
    full = {p for p in split if len(p) == groups}  # cannot be split by counts

    def cell_of(vector: bytes) -> bytes:
        return next((vector[:d] for d in range(groups) if vector[:d] not in split), vector)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array({cell_of(v) for v in batch["vector"].to_pylist()}, pa.binary())], ["cell"])

    paths = sorted(bytes(r["cell"]) for r in rows.select("vector").mapInArrow(cells, "cell binary").distinct().collect())  # children of split nodes
    shared = spark.sparkContext.broadcast((Trie(paths), np.array([p in full for p in paths], bool)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, is_full = shared.value
        for batch in batches:
            own = np.frombuffer(b"".join(batch["vector"].to_pylist()), np.uint8).reshape(batch.num_rows, groups)
            query, cell, spent = trie.search(own)
            full = is_full[cell]
            for some, parts in ((~full, None), (full, [[half_name(k) for k in halves(w)] for w in batch["word"].take(pa.array(query[full])).to_pylist()])):
                times = 1 if parts is None else [len(p) for p in parts]
                at = pa.array(np.repeat(query[some], times))
                part = pa.nulls(len(at), pa.string()) if parts is None else pa.array([p for own in parts for p in own], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(cell[some], times), pa.int32()), part, batch["word"].take(at), batch["n"].take(at), pa.array(np.repeat(spent[some] == 0, times))], ["cell", "part", "word", "n", "data"]
                )

    dealt = rows.mapInArrow(deal, "cell int, part string, word string, n long, data boolean")
    found = dealt.groupBy("cell", "part").applyInArrow(lambda held: search_cell(held, letters, groups), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def spelling_variants(words: DataFrame, times: int = 10, **limits: int) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of word and n: a word's form is its commonest near word, if that is
    ``times`` as common or more; its root is the last of its forms. Each form is ``times`` as common, so 19
    steps or fewer lead to any root."""
    words = materialise(words, "words")
    found = materialise(near_words(words, **limits), "near-words")
    rows = words.join(found, "word", "left").withColumn("has", F.col("best_n") >= F.col("n") * times)
    rows = materialise(rows.select("word", F.when(F.col("has"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("best_n")).alias("form_n")), "forms")
    steps = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        then = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = materialise(steps.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = ahead.select("word", "root")
        if ahead.filter("moved").isEmpty():
            break
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of documents."""
    return spelling_variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))
