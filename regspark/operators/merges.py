"""Joins with a rule: precedence, dictionaries, stars of counts, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, trim_blank


def once(df: DataFrame, key: str) -> DataFrame:
    """df, or an error when it runs if a key comes twice. The join that follows uses the same partitioning."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} comes twice: "), F.col(key).cast("string")))).otherwise(F.col(key))
    return df.withColumn("_n", n).withColumn(key, checked).drop("_n")


def merge_by_precedence(left: DataFrame, right: DataFrame, key: str, shared: Sequence[str], left_only: Sequence[str] = (), right_only: Sequence[str] = ()) -> DataFrame:
    """Full outer merge: the left side's shared columns win, their gaps are filled from the right; each
    side's own columns come from it alone. A key that a side has twice is an error."""
    left = once(left.select(key, *shared, *left_only), key)
    r = once(right, key).select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in [*shared, *right_only]))
    both = left.join(r, left[key] == r["_key"], "full_outer")
    return both.select(
        F.coalesce(left[key], r["_key"]).alias(key),
        *(F.coalesce(left[c], r[f"_{c}"]).alias(c) for c in shared),
        *(left[c] for c in left_only),
        *(r[f"_{c}"].alias(c) for c in right_only),
        F.when(r["_key"].isNull(), "left").when(left[key].isNull(), "right").otherwise("both").alias("side"),
    )


def coverage(merged: DataFrame) -> DataFrame:
    return merged.agg(*(F.count_if(F.col("side") == s).alias(f"{s}_only" if s != "both" else s) for s in ("left", "right", "both")))


def match_list(df: DataFrame, keys: Sequence[str], items: Column, dictionary: DataFrame, normal) -> DataFrame:
    """A list against a dictionary (name, number) by the normal form: parts, numbers and names (null where
    unknown), all_known. Parts are trimmed, empty ones go, the order stays; a row without parts stays with
    empty lists and all_known false. The lowest number wins on equal forms. keys are unique in df."""
    best = dictionary.select(normal("name").alias("_k"), "name", "number").filter("_k <> ''")
    best = best.groupBy("_k").agg(F.min("number").alias("number"), F.min_by("name", F.struct("number", "name")).alias("name"))
    parts = F.filter(F.transform(items, trim_blank), lambda x: x != "")
    each = df.select(*keys, F.posexplode_outer(parts).alias("at", "part")).withColumn("_k", normal("part"))
    found = each.join(best, "_k", "left")
    rows = F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "part", "number", "name"))))
    listed = lambda c: F.transform(rows, lambda r: r[c]).alias(f"{c}s")
    known = F.bool_and(F.when(F.col("at").isNotNull(), F.col("number").isNotNull()))
    return found.groupBy(*keys).agg(*map(listed, ("part", "number", "name")), F.coalesce(known, F.lit(False)).alias("all_known"))


def star(keys: DataFrame, key: str, sides: Sequence[DataFrame], counts: Sequence[str]) -> DataFrame:
    """Left joins of aggregates onto a set of keys, counts filled with zero."""
    return reduce(lambda a, b: a.join(b, key, "left"), sides, keys).fillna(0, list(counts))


def search(df: DataFrame, equals: dict | None = None, contains: dict | None = None) -> DataFrame:
    """Rows that equal and contain what is asked; at least one filter is required."""
    wanted = {k: v for k, v in (equals or {}).items() if v is not None}
    parts = {k: v for k, v in (contains or {}).items() if v}
    if not wanted and not parts:
        raise ValueError("a search needs at least one filter")
    for k, v in wanted.items():
        df = df.filter(F.col(k) == v)
    for k, v in parts.items():
        df = df.filter(fold(F.coalesce(F.col(k), F.lit(""))).contains(fold(F.lit(v))))
    return df
