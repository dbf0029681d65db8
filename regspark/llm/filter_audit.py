"""Operator 11. How filters interact: what each removes, at each step of each order, and what is redundant.

1. Every document becomes a bit mask of the filters that it fails. Documents of one part, mask and
   label count as one row with a weight from here on; at most 2**k masks a part are left.
2. Min-plus removal ranks: the mask matrix has 0 where a mask fails a filter and infinity elsewhere, the
   position matrix holds the inverse permutation of each order. Their min-plus product, the minimum of
   mask + position over the filters, is the step at which a mask goes under an order.
3. That step drives weighted scatter counts (what each step removes), and what fails a filter but has
   a smaller rank is redundant there.

A copy is a text that a smaller doc_id has too. Texts meet as digests of 256 bits, counted by text, part, labels
and doc_id before any shuffle, so that a text which a third of all documents share is a few rows.

Defined cases: a null text is empty (and a copy of other empty ones); a null lang is the part ''; a row without
doc_id is no copy, makes no other row one and has no labels; rows that repeat a doc_id with its text count
each and are no copies of one another; a document with several labels is good (toxic) if one of them says so;
a very long text is whole; an empty table has no parts and gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> dict[str, Column]:
    """Which of the filters that look at the text alone it fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit k: the k-th of ABCDE fails), good, toxic, n."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((c.cast("int") * (1 << k) for k, c in enumerate(failures(text).values())), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), bits.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    # rows without doc_id have no label; their digests keep them from meeting in one task
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("k"))
    known = known.agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.withColumn("k", F.coalesce("doc_id", F.xxhash64("digest"))).join(known.withColumn("of", F.col("k")), "k", "left")
    is_own = F.col("of").eqNullSafe(F.col("doc_id"))
    texts = rows.groupBy("digest", "part", "mask", (is_own & F.coalesce("good", F.lit(False))).alias("good"), (is_own & F.coalesce("toxic", F.lit(False))).alias("toxic"))
    texts = texts.agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("of_least"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"))
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    texts = texts.withColumn("no_copy", F.col("nameless") + F.when(first, F.col("of_least")).otherwise(0))
    each = F.array(F.struct("mask", F.col("no_copy").alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("no_copy")).alias("n")))
    found = texts.select("part", "good", "toxic", F.inline(each)).filter("n > 0")
    return found.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def removal_ranks(own: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The min-plus product of the mask matrix of the given masks and the positions (orders x filters): the step, from
    1, at which a mask goes under an order; one more than there are filters if it stays."""
    k = positions.shape[1]
    fails = own[:, None] >> np.arange(k) & 1
    matrix = np.where(fails == 1, 0, k + 1)
    return np.minimum((matrix[:, None, :] + positions[None, :, :]).min(2), k + 1)


def audit_part(held: list[dict], names: str) -> dict[str, np.ndarray]:
    """All counts of one part, by order and step."""
    k = len(names)
    orders = np.array(list(permutations(range(k))))
    positions = np.argsort(orders, 1) + 1  # inverse permutations
    own = np.array([r["mask"] for r in held], np.int64)
    n = np.array([r["n"] for r in held], np.int64)
    ranks, o = removal_ranks(own, positions), np.arange(len(orders))

    def scattered(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(orders), k + 2), np.int64)
        np.add.at(out, (np.broadcast_to(o, ranks.shape), ranks), weights[:, None])
        return out[:, 1 : k + 1]

    removed = scattered(n)
    fails = (own[:, None, None] >> orders & 1).astype(bool)  # mask, order, step: fails that step's filter
    earlier = ranks[:, :, None] < np.arange(1, k + 1)
    of_filter = np.zeros(k, np.int64)
    np.add.at(of_filter, orders, removed)
    single = np.array([n[own == 1 << f].sum() for f in range(k)], np.int64)
    good, toxic = (n * np.array([r[c] for r in held], np.int64) for c in ("good", "toxic"))
    return {
        "filter_order": np.repeat(["".join(names[f] for f in order) for order in orders], k),
        "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)),
        "kept": (n.sum() - np.cumsum(removed, 1)).ravel(),
        "removed": removed.ravel(),
        "redundant": np.tensordot(n, fails & earlier, 1).ravel(),
        "unique_fails": single[orders].ravel(),
        "good_lost": scattered(good).ravel(),
        "toxic_lost": scattered(toxic).ravel(),
        "shapley": of_filter[orders].ravel(),
    }


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(found: DataFrame, names: str) -> DataFrame:
    """The audit of (part, mask, good, toxic, n) for filters with one-letter names, of which bit k is the k-th. All
    orders are looked at: there may be seven filters at most."""
    if not 0 < len(names) <= 7:
        raise ValueError("all orders of one to seven filters can be audited")
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("held"))  # 4 * 2**k rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(batch["part"], batch["held"], strict=True):
                out = audit_part(held.as_py(), names)
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * len(out["step"]), pa.string()), *(pa.array(x) for x in out.values())], ["part", *out])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, filter_order, step and counts, for all 120 orders of the five filters."""
    return audit(masks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")), "ABCDE")
