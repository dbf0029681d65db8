"""Choosing and merging rows: one per key, top k, continuation rows, row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if it has fewer: for costly work on rows of a small table in a
    file or two. Larger tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; give a total order, so that the choice is the same each time."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "place") -> DataFrame:
    """The first k rows of each key with their rank; Spark prunes to k before the shuffle too."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def running_count(df: DataFrame, keys: Sequence[str], order: str, counts: Column, name: str) -> DataFrame:
    """How many rows of its key up to each one count, by ranges of (keys, order): each range counts its own rows and hands on
    its total for the key that goes over into the next. A key with any number of rows is many tasks' work."""
    part, own, total, before = "_part", "_own", "_total", "_before"
    dealt = cut(df.withColumn(own, counts.cast("int")).repartitionByRange(*keys, order).withColumn(part, F.spark_partition_id()))
    within = dealt.withColumn(own, F.sum(own).over(Window.partitionBy(part, *keys).orderBy(order)))
    totals = dealt.groupBy(part, *keys).agg(F.coalesce(F.sum(own), F.lit(0)).alias(total))  # a row a key and range
    carried = totals.withColumn(before, F.coalesce(F.sum(total).over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    handed = carried.select(F.col(part).alias("_of"), *(F.col(k).alias(f"_of_{n}") for n, k in enumerate(keys)), before)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{n}")) for n, k in enumerate(keys)), F.col(part) == F.col("_of"))
    return within.join(handed, same).withColumn(name, F.coalesce(own, F.lit(0)) + F.col(before)).select(*df.columns, name)


def merge_continuations(df: DataFrame, keys: Sequence[str], order: str, starts: Column, note: str, separator: str = " | ") -> DataFrame:
    """Rows that start nothing add their note to the entry before them (entry 0: before the first).
    Columns: keys, entry, first (the order value), the notes joined, rows."""
    numbered = running_count(df, keys, order, starts, "entry")
    own = F.transform(F.sort_array(F.collect_list(F.when(F.col(note) != "", F.struct(order, note)))), lambda x: x[note])
    return numbered.groupBy(*keys, "entry").agg(F.min(order).alias("first"), F.array_join(own, separator).alias("notes"), F.count(F.lit(1)).alias("rows"))


def stages(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Each row's place from the first and from the last of its key."""
    up, down = (Window.partitionBy(key).orderBy(*(getattr(F.col(c), way)() for c in order)) for way in ("asc", "desc"))
    return df.withColumns({"from_first": F.row_number().over(up), "from_last": F.row_number().over(down)})


def stable_row_number(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """1, 2, 3 ... over a total order, without one task for all rows: rows are dealt by ranges, numbered in
    their partition, and shifted by the sizes of those before. Only partition sizes meet."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    # the ranges are drawn by sampling; the rows are written once so that each keeps its partition
    dealt = cut(dealt)
    own = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return own.join(F.broadcast(before.drop("_size")), "_p").withColumn(name, F.col("_n") + F.col("_before")).drop("_p", "_n", "_before")


def running_sum(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """The sum of value over all rows before each, in a total order; dealt by ranges as above."""
    dealt = cut(df.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    own = dealt.withColumn("_own", F.sum(value).over(Window.partitionBy("_p").orderBy(order)) - F.col(value))
    totals = dealt.groupBy("_p").agg(F.sum(value).alias("_t"))
    before = totals.select("_p", F.coalesce(F.sum("_t").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return own.join(F.broadcast(before), "_p").withColumn(name, F.col("_own") + F.col("_before")).drop("_p", "_own", "_before")


def numbered_page(df: DataFrame, number: int, size: int, order: Sequence[Column]) -> DataFrame:
    """One page (from 1) of an ordered result, with total, pages and last (whether it is the last page). The result is dealt
    by ranges of the order; the sizes of the ranges tell which of them the page lies in, and only those are sorted."""
    if number < 1 or size < 1:
        raise ValueError("pages are numbered from 1 and hold at least one row")
    part, place, before, n = "_part", "_place", "_before", "_n"
    dealt = cut(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    everything = Window.orderBy(part)  # a row a range
    sizes = sizes.select(part, n, (F.sum(n).over(everything) - F.col(n)).alias(before), F.sum(n).over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    first, end = (number - 1) * size, number * size
    inside = sizes.filter((F.col(before) < end) & (F.col(before) + F.col(n) > first))
    rows = dealt.join(F.broadcast(inside), part).withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(*order)) + F.col(before))
    rows = rows.filter((F.col(place) > first) & (F.col(place) <= end))
    return rows.select(*df.columns, "total", F.ceil(F.col("total") / size).alias("pages"), (F.col("total") <= end).alias("last"))
