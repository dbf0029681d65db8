"""Data quality as DataFrames; a guard raises only when asked to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A guard failed."""


def nulls_added(df: DataFrame, typed: dict[str, Column]) -> DataFrame:
    """One row per typed column: name, present (values in the source), lost (those that do not parse)."""
    sums = []
    for name, value in typed.items():
        there = F.nullif(F.col(name), F.lit("")).isNotNull()
        sums += [F.count_if(there).alias(f"{name}__present"), F.count_if(there & value.isNull()).alias(f"{name}__lost")]
    one = df.agg(*sums)
    rows = F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"{n}__present").alias("present"), F.col(f"{n}__lost").alias("lost")) for n in typed))
    return one.select(F.inline(rows))


def over_limit(profile: DataFrame, part: str = "lost", whole: str = "present", limit: float = 0.2) -> DataFrame:
    """The profile and whether the lost share is over the limit."""
    return profile.withColumn("failed", (F.col(whole) > 0) & (F.col(part) > F.col(whole) * limit))


def guard(checked: DataFrame, column: str = "failed") -> None:
    """Raise if a row failed; at most ten are named."""
    bad = checked.filter(column).limit(10).collect()
    if bad:
        raise QualityError("; ".join(str(r.asDict()) for r in bad))


def rejects(df: DataFrame, fields: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Records with the right number of fields, and the others."""
    ok = F.size(fields) == width
    return df.filter(ok), df.filter(~ok)


def shrunk(now: DataFrame, before: DataFrame, ratio: float = 0.9) -> DataFrame:
    """name, rows, rows_before, failed: tables (name, rows) that lost too many rows, or vanished."""
    b = before.select("name", F.col("rows").alias("rows_before"))
    both = b.join(now.select("name", "rows"), "name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return both.withColumn("failed", F.col("rows") < F.col("rows_before") * ratio).select("name", "rows", "rows_before", "failed")


def source_age(stamps: DataFrame, now: Column, limits: DataFrame) -> DataFrame:
    """name, newest, days, limit, failed; stamps (name, stamp), limits (name, limit: days or null)."""
    newest = stamps.groupBy("name").agg(F.max("stamp").alias("newest"))
    out = newest.join(limits, "name", "left").withColumn("days", F.datediff(now, F.col("newest")))
    return out.select("name", "newest", "days", "limit", F.coalesce(F.col("days") > F.col("limit"), F.lit(False)).alias("failed"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key comes twice; at most ten are named."""
    guard(duplicate_keys(df, keys).withColumn("failed", F.lit(True)))

