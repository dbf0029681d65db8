"""Writing: sorted Parquet with small row groups, clean CSV, bucket folders, build folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_sorted(df: DataFrame, path: str, sort: Sequence[str], rows_per_group: int = 8192) -> None:
    """Ranges of the sort columns to files, sorted inside, nulls last: readers skip row groups."""
    order = [F.col(c).asc_nulls_last() for c in sort]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").option("parquet.block.row.count.limit", rows_per_group).parquet(path)


def _on_a_line(c: str, kind: T.DataType) -> Column:
    """A column's values as numbers in the same order (of texts the first six bytes)."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.col(c).cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    return F.unix_micros(F.col(c).cast("timestamp")).cast("double") if isinstance(kind, T.TimestampType | T.TimestampNTZType) else F.col(c).cast("double")


def _up_to(borders: Column, x: Column) -> Column:
    return F.filter(borders, lambda b: b <= x)


def curve(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """A row's place on a curve that keeps near rows near in all columns: each value's place among 2**bits equal shares
    of its column, the bits of all places interleaved. Nulls come first."""
    lines = {c: _on_a_line(c, df.schema[c].dataType) for c in columns}
    shares = [k / 2**bits for k in range(1, 2**bits)]
    borders = df.agg(*(F.percentile_approx(x, shares, 10_000).alias(f"b{k}") for k, x in enumerate(lines.values()))).head()  # 2**bits numbers a column
    out = F.lit(0).cast("long")
    for k, x in enumerate(lines.values()):
        known = F.array(*(F.lit(float(b)) for b in borders[f"b{k}"] or [])).cast("array<double>")
        place = F.coalesce(F.size(_up_to(known, x)), F.lit(0))
        for bit in range(bits):
            out = out + F.shiftleft(F.shiftright(place, bit).bitwiseAND(1).cast("long"), bit * len(columns) + len(columns) - 1 - k)
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], rows_per_group: int = 8192, bits: int = 6) -> None:
    """Like write_sorted, along a curve through several columns, so that row groups are skipped by a filter on any of them."""
    at = curve(df, columns, bits)
    placed = df.withColumn("_curve", at)
    dealt = placed.repartitionByRange("_curve", *columns).sortWithinPartitions("_curve", *columns).drop("_curve")
    dealt.write.option("compression", "zstd").option("parquet.block.row.count.limit", rows_per_group).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket") -> None:
    df.repartition(bucket).sortWithinPartitions(bucket).write.partitionBy(bucket).parquet(path)


def build_path(root: str, table: str, now: dt.datetime) -> str:
    """A folder of this build alone; what is there is never changed."""
    return f"{root}/data/{now:%Y%m%dT%H%M%SZ}/{table}"
