"""Incremental refresh: which tables are built anew, which carried, which kept after a failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def decide(now: DataFrame, before: DataFrame, derived: DataFrame, same_code: bool = True) -> DataFrame:
    """name, action. now and before: (name, print) of sources; derived: (name, source).

    A source is built if it is new or its fingerprint changed, else carried. A derived table is skipped if a
    source is missing; all others are built as soon as any source is, or the code is new; if nothing
    changed, all is carried."""
    b = before.select("name", F.col("print").alias("old"))
    sources = now.join(b, "name", "left").select("name", F.when(F.col("old").eqNullSafe(F.col("print")), "carry").otherwise("build").alias("action"))
    need = derived.join(sources.select(F.col("name").alias("source"), "action"), "source", "left")
    own = need.groupBy("name").agg(F.bool_or(F.col("action").isNull()).alias("missing"))
    changed = not same_code or not sources.filter("action = 'build'").isEmpty()
    return sources.unionByName(own.select("name", F.when(F.col("missing"), "skip").otherwise("build" if changed else "carry").alias("action")))


def build_each(makers: dict[str, Callable[[], DataFrame]], write: Callable[[str, DataFrame], None], keep: Callable[[str], bool] = lambda name: False) -> dict[str, str]:
    """Build table by table; one failure leaves the others, and keep(name) then carries the earlier table if
    there is one. name -> '' or what became of the table and the error."""
    out = {}
    for name, make in makers.items():
        try:
            write(name, make())
            out[name] = ""
        except Exception as e:  # noqa: BLE001 - the failure is data here
            out[name] = f"{'kept' if keep(name) else 'missing'}: {type(e).__name__}: {e}"[:500]
    return out


def failures(spark: SparkSession, outcome: dict[str, str]) -> DataFrame:
    """name, error of what failed."""
    return spark.createDataFrame([(n, e) for n, e in outcome.items() if e], "name string, error string")


def refresh_texts(entries: DataFrame, texts: DataFrame) -> DataFrame:
    """entries (name, columns with name, type, description) of carried tables with today's descriptions (name,
    column, description); a column without one keeps its own."""
    t = texts.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("column", "description"))).alias("_texts"))
    newer = lambda c: F.coalesce(F.try_element_at("_texts", c["name"]), c["description"])
    columns = F.transform("columns", lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"), newer(c).alias("description")))
    return entries.join(t, "name", "left").withColumn("columns", columns).drop("_texts")
