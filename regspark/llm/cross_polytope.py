"""Operator 13. Near-duplicate embeddings by cross-polytope hashing.

1. Exact copies (label and vector) are one class with a number of members.
2. A hash turns the vector by three rounds of random signs and a fast Hadamard transform; its value is the
   nearest of the 2 d signed axes. ``width`` such values make a bucket, so many that the largest label's vectors
   spread over enough buckets. Each of several tables has hashes of its own.
3. Multiprobe: a vector lies in one bucket a table, as data, and asks the ``probes`` buckets that it is closest to, by
   what its coordinates lack of the largest. The number of tables follows from a simulation: two vectors whose
   cosine is the threshold miss each other in all tables with a probability of ``miss`` at most.
4. Candidates are verified in the bucket by products of whole blocks in double precision. A pair may meet in
   several buckets; it counts in the first one, which each task can tell from the two vectors. Tasks
   return a count and a root for each vector, never pairs.
5. Buckets with more than ``block`` vectors are dealt as a grid of blocks of data and blocks of queries.

Comparing all distinct vectors of a dense group is what their numbers of links ask for; memory and shuffles of a task
are bounded by two blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those without a label,
link with nothing and are components of their own; vectors of different length do not link; rows that share
a vec_id are one vector, of those that take part the least by label and components; rows without vec_id take no
part and are one row; ties and copies all link; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small, small_batches
from .components import connected_components


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of the last axis, whose length is a power of two, without its scale."""
    half = 1
    while half < x.shape[-1]:
        pairs = x.reshape(*x.shape[:-1], -1, 2, half)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], -2).reshape(x.shape)
        half *= 2
    return x


class Hashes:
    """The hashes of all tables for vectors of some dims."""

    def __init__(self, dims: int, tables: int, width: int, probes: int, seed: int = 13) -> None:
        self.dims, self.size, self.probes = dims, 1 << max(dims - 1, 0).bit_length(), probes
        self.signs = np.random.default_rng([seed, dims]).choice([-1.0, 1.0], (tables, width, 3, self.size))

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors -> n x tables x probes, the own bucket first; -1 where there are fewer buckets."""
        x = np.pad(x, ((0, 0), (0, self.size - self.dims)))
        out = np.full((len(x), len(self.signs), self.probes), -1, np.int64)
        for t, signs in enumerate(self.signs):
            lacks, codes = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for rounds in signs:
                y = x
                for s in rounds:
                    y = hadamard(y * s) / math.sqrt(self.size)
                size = np.abs(y)
                some = min(self.probes, self.size)
                axes = np.argpartition(-size, some - 1, 1)[:, :some]
                most = np.take_along_axis(size, axes, 1)
                value = axes * 2 + (np.take_along_axis(y, axes, 1) < 0)
                lack = (most.max(1, keepdims=True) - most) ** 2
                lacks = (lacks[:, :, None] + lack[:, None, :]).reshape(len(x), -1)
                codes = (codes[:, :, None] * (2 * self.size) + value[:, None, :]).reshape(len(x), -1)
                order = np.argsort(lacks, 1, kind="stable")[:, : self.probes]
                lacks, codes = np.take_along_axis(lacks, order, 1), np.take_along_axis(codes, order, 1)
            out[:, t, : codes.shape[1]] = codes
        return out


def meet(buckets: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """Whether a asks the bucket of b in table t."""
    return (buckets[a, t] == buckets[b, t, :1]).any(1)


def chance(dims: int, width: int, probes: int, cosine: float, pairs: int = 4000) -> float:
    """The simulated chance that two vectors at this cosine meet in one table."""
    rng = np.random.default_rng(1)
    a, c = rng.normal(size=(2, pairs, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    c -= (c * a).sum(1, keepdims=True) * a
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300)
    both = Hashes(dims, 1, width, probes).buckets(np.concatenate([a, cosine * a + math.sqrt(1 - cosine**2) * c]))
    one, two = np.arange(pairs), np.arange(pairs, 2 * pairs)
    return float((meet(both, one, two, 0) | meet(both, two, one, 0)).mean())


def tables_for(dims: int, width: int, probes: int, cosine: float, miss: float) -> int:
    p = min(max(chance(dims, width, probes, cosine), 1e-3), 1 - 1e-9)
    return math.ceil(math.log(miss) / math.log(1 - p))


def prepared(table: DataFrame) -> DataFrame:
    """vec_id, own (label, dims, key, vector as 64-bit floats; null if it takes no part); one row a vec_id."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = small_batches(table).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    rows = rows.withColumn("v", F.when(good & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.col("v")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = batch["v"].flatten().to_numpy(zero_copy_only=False) + 0.0, np.cumsum(batch["v"].value_lengths().fill_null(0).to_numpy())
            parts = [p.tobytes() if ok else None for p, ok in zip(np.split(flat, ends[:-1]), batch["v"].is_valid().to_pylist(), strict=True)] if batch.num_rows else []
            keys = [None if p is None else hashlib.blake2b(p, digest_size=16, key=hashlib.sha256(label.encode()).digest()).digest() for p, label in zip(parts, batch["label"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array(keys, pa.binary()), pa.array(parts, pa.binary())], ["vec_id", "label", "key", "vector"])

    packed = rows.mapInArrow(pack, "vec_id long, label string, key binary, vector binary")
    own = F.when(F.col("key").isNotNull(), F.struct("label", "vector", "key"))
    return packed.groupBy("vec_id").agg(F.min(own).alias("own")).select("vec_id", "own.label", "own.key", "own.vector")


def units(vectors: pa.Array, dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors.to_pylist()), np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small numbers
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def joined_roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The roots, once a and b are linked too."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


class Buckets:
    """The parameters that all tasks share."""

    def __init__(self, dims: int, tables: int, width: int, probes: int, cosine: float) -> None:
        self.tables, self.width, self.probes, self.cosine = tables, width, probes, cosine
        self.all = (4 * max(dims, 1)) ** width  # more than any code

    def hashes(self, dims: int) -> Hashes:
        return Hashes(dims, self.tables, self.width, self.probes)

    def asked(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, table * all + bucket, whether it is the row's own) of everything that the rows ask."""
        dims = batch["dims"].to_numpy()
        rows, buckets = [], []
        for d in np.unique(dims):
            own = np.flatnonzero(dims == d)
            found = self.hashes(int(d)).buckets(units(batch["vector"].take(pa.array(own)), int(d)))
            buckets.append(np.where(found < 0, -1, found + np.arange(self.tables)[:, None] * self.all).ravel())
            rows.append(np.repeat(own, self.tables * self.probes))
        row, bucket = np.concatenate(rows), np.concatenate(buckets)
        is_own, there = np.arange(len(row)) % self.probes == 0, bucket >= 0
        return row[there], bucket[there], is_own[there]

    def compare(self, table: pa.Table) -> pa.Table:
        """id, links, root of the vectors of a bucket (or of a block of data and one of queries) that link."""
        ids, members = table["id"].to_numpy(), table["members"].to_numpy()
        x = units(table["vector"], table["dims"][0].as_py())
        data, queries = np.flatnonzero(table["data"].to_numpy()), np.flatnonzero(table["query"].to_numpy())
        t = table["bucket"][0].as_py() // self.all
        links, root, buckets = np.zeros(len(ids), np.int64), np.arange(len(ids)), None
        for k in range(0, len(queries), 128):
            part = queries[k : k + 128]
            a, b = np.nonzero(x[part] @ x[data].T >= self.cosine)
            a, b = part[a], data[b]
            differ = ids[a] != ids[b]
            a, b = a[differ], b[differ]
            if not len(a):
                continue
            if buckets is None:
                buckets = self.hashes(x.shape[1]).buckets(x)
            root = joined_roots(root, a, b)
            first = ~((ids[a] > ids[b]) & meet(buckets, b, a, t))
            for s in range(t):
                first &= ~(meet(buckets, a, b, s) | meet(buckets, b, a, s))
            np.add.at(links, a[first], members[b[first]])
            np.add.at(links, b[first], members[a[first]])
        kept = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pa.table([pa.array(c) for c in (ids[kept], links[kept], ids[root[kept]])], ["id", "links", "root"])


def near_embeddings(table: DataFrame, cosine: float = 0.93, probes: int = 4, miss: float = 0.001, bucket: int = 256, block: int = 4096, most_broadcast: int = 100_000) -> DataFrame:
    """vec_id, n_links, component_id, kept. ``bucket`` is how many vectors of the largest label a bucket should
    have on average at most."""
    vectors = materialise(prepared(table), "vectors")
    live = vectors.filter("key is not null")
    classes = live.groupBy("label", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("members"), F.min("vector").alias("vector"))
    classes = materialise(classes.withColumn("dims", (F.octet_length("vector") / 8).cast("int")), "classes")
    largest = classes.groupBy("label", "dims").count().agg(F.max("count").alias("n"), F.max("dims").alias("dims")).head()
    n, dims = largest["n"] or 1, largest["dims"] or 1
    width = max(1, math.ceil(math.log(n / bucket) / math.log(2 * max(dims, 2)))) if n > bucket else 1
    probes *= width
    plan = Buckets(dims, tables_for(dims, width, probes, cosine, miss), width, probes, cosine)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                row, found, own = plan.asked(some)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(some[c].take(at) for c in some.schema.names), pa.array(found), pa.array(own)], [*some.schema.names, "bucket", "own"])

    asked = classes.select("label", "id", "members", "dims", "vector").mapInArrow(ask, "label string, id long, members long, dims int, vector binary, bucket long, own boolean")
    place = ["label", "dims", "bucket"]
    sizes = asked.groupBy(*place).agg(F.sum(F.col("own").cast("long")).alias("data"), F.count(F.lit(1)).alias("queries"))
    large = sizes.filter(F.col("queries") > block).select(*place, *(F.ceil(F.col(c) / block).cast("int").alias(f"{c}_blocks") for c in ("data", "queries")))
    large = materialise(large, "large-buckets")
    i, j = (F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(c, F.lit(1))).cast("int") for k, c in enumerate((F.col("data_blocks"), F.col("queries_blocks"))))
    cell = lambda i, j, data, query: F.struct(i.alias("i"), j.alias("j"), data.alias("data"), query.alias("query"))
    zero, yes, no = F.lit(0), F.lit(True), F.lit(False)
    over = lambda c: F.sequence(F.lit(1), F.greatest(c, F.lit(1)))
    as_query = F.transform(over(F.col("data_blocks")), lambda k: cell(k - 1, j, no, yes))
    as_data = F.when(F.col("own"), F.transform(over(F.col("queries_blocks")), lambda k: cell(i, k - 1, yes, no))).otherwise(F.array().cast("array<struct<i:int,j:int,data:boolean,query:boolean>>"))
    cells = F.when(F.col("data_blocks").isNull(), F.array(cell(zero, zero, F.col("own"), yes))).otherwise(F.concat(as_query, as_data))
    dealt = asked.join(small(large, most_broadcast), place, "left").select(*place, "id", "members", "vector", F.inline(cells))
    found = materialise(dealt.groupBy(*place, "i", "j").applyInArrow(lambda held: plan.compare(held), "id long, links long, root long"), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = connected_components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    told = classes.select("key", "id", "members").join(links, "id", "left").join(labels.withColumnRenamed("node", "id"), "id", "left")
    told = told.select("key", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = live.select("vec_id", "key").join(told, "key").select("vec_id", "n_links", "component_id")
    out = out.unionByName(vectors.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of all rows of embeddings."""
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
