"""What a build made, as data: one row per table, and one per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entries(tables: dict[str, DataFrame], about: dict[str, dict[str, str]] | None = None, loaded: str | None = None) -> DataFrame:
    """name, rows, columns (name, type, description), loaded (the latest of that column, if there is one)."""
    out = []
    for name, df in tables.items():
        known = (about or {}).get(name, {})
        columns = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.lit(known.get(c, "")).alias("description")) for c, t in df.dtypes))
        newest = F.max(loaded).cast("timestamp") if loaded in df.columns else F.lit(None).cast("timestamp")
        out.append(df.agg(F.count(F.lit(1)).alias("rows"), newest.alias("loaded")).select(F.lit(name).alias("name"), "rows", columns.alias("columns"), "loaded"))
    return reduce(DataFrame.unionByName, out)


def dictionary(entry_rows: DataFrame) -> DataFrame:
    """name, column, type, description."""
    each = entry_rows.select("name", F.explode("columns").alias("c"))
    return each.select("name", F.col("c.name").alias("column"), "c.type", "c.description")
