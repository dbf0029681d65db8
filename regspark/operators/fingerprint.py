"""What a table holds, in a few numbers; and where two tables differ, by ranges of a key.

A row's hash is 60 bits of the md5 of its text: for each column n if it is null, else v and its value, joined by
the unit separator. Numbers that are not whole count to nine decimals. Such hashes can be computed by any
engine that has md5. A table's fingerprint is the number of rows, the exclusive or and the sum of
their hashes: the same for the same rows in any order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import cut


def canonical(value: Column, kind: T.DataType) -> Column:
    """A value as text, the same in every engine."""
    if isinstance(kind, T.FloatType | T.DoubleType | T.DecimalType):
        return F.coalesce(value.cast("double").try_cast("decimal(38,9)").cast("string"), value.cast("string"))
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: marked(x, kind.elementType)), ","), F.lit("]"))
    if isinstance(kind, T.StructType):
        return F.concat(F.lit("("), F.concat_ws(",", *(marked(value[f.name], f.dataType) for f in kind.fields)), F.lit(")"))
    if isinstance(kind, T.MapType):
        return canonical(F.array_sort(F.map_entries(value)), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")


def marked(value: Column, kind: T.DataType) -> Column:
    return F.when(value.isNull(), "n").otherwise(F.concat(F.lit("v"), canonical(value, kind)))


def row_hash(df: DataFrame) -> Column:
    """A whole number of 60 bits for each row; columns count in their order, names do not."""
    text = F.concat_ws("\x1f", *(marked(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def totals(h: Column) -> list[Column]:
    """rows, bits and total of row hashes, for any aggregation."""
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("bits"), F.sum(h.cast("decimal(38,0)")).alias("total")]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, bits, total."""
    return df.agg(*totals(row_hash(df)))


def digests(df: DataFrame, key: str, leaf_bits: int = 12, fan_bits: int = 6, levels: int = 4) -> DataFrame:
    """A tree of fingerprints over ranges of a whole-numbered key: level (0: ranges of 2**leaf_bits keys), node (the keys
    shifted right; null: rows without key), rows, bits, total. Each level up joins 2**fan_bits nodes."""
    leaves = df.select(F.shiftright(F.col(key).cast("long"), leaf_bits).alias("node"), row_hash(df).alias("h")).groupBy("node").agg(*totals(F.col("h")))
    level = cut(leaves)
    out = [level.select(F.lit(0).alias("level"), "*")]
    for k in range(1, levels):
        level = level.groupBy(F.shiftright("node", fan_bits).alias("node")).agg(F.sum("rows").alias("rows"), F.bit_xor("bits").alias("bits"), F.sum("total").cast("decimal(38,0)").alias("total"))
        out.append(level.select(F.lit(k).alias("level"), "*"))
    return cut(reduce(DataFrame.unionByName, (x.withColumn("total", F.col("total").cast("decimal(38,0)")) for x in out)))


def changed_ranges(before: DataFrame, after: DataFrame, leaf_bits: int = 12, fan_bits: int = 6, levels: int = 4) -> DataFrame:
    """low, high, rows_before, rows_after of the ranges of keys in which two tables differ, by their digests. From the top
    down only children of nodes that differ are compared. Rows without key are the range from null to null."""

    def differing(level: int, within: DataFrame | None) -> DataFrame:
        one, two = (x.filter(F.col("level") == level).select("node", *(F.col(c).alias(f"{c}_{s}") for c in ("rows", "bits", "total"))) for x, s in ((before, "before"), (after, "after")))
        if within is not None:
            inside = within.select(F.col("node").alias("parent"))
            one, two = (x.join(inside, F.shiftright("node", fan_bits).eqNullSafe(F.col("parent")), "left_semi") for x in (one, two))
        both = one.withColumnRenamed("node", "node_before").join(two, F.col("node_before").eqNullSafe(F.col("node")), "full")
        same = reduce(lambda a, b: a & b, (F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after")) for c in ("rows", "bits", "total")))
        return both.filter(~same).select(F.coalesce("node", "node_before").alias("node"), "rows_before", "rows_after")

    found = None
    for level in range(levels - 1, -1, -1):
        found = cut(differing(level, found))
    low = F.shiftleft("node", leaf_bits)
    return found.select(low.alias("low"), (low + ((1 << leaf_bits) - 1)).alias("high"), F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
