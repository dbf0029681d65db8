"""What several operators share: materialised tables in the shared folder, hashing, a size check."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import BATCHES, small_batches  # noqa: F401


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir. Only a local session may lack it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = os.path.join(tempfile.gettempdir(), f"regspark-{uuid.uuid4().hex}")
    spark.sparkContext.setCheckpointDir(base)
    return f"file://{base}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, and lost executors
    cost nothing that was finished before. options: for the writer."""
    spark, schema = df.sparkSession, df.schema
    path = fresh_path(spark, name)
    writer = df.write.options(**{"compression": "zstd", **(options or {})})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again."""
    for table in tables:
        jvm, jsc = table.sparkSession._jvm, table.sparkSession._jsc
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(column: str | Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo modulus. Null stays null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(value.cast("string").cast("binary")) % F.lit(modulus)


def prose(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null: empty) and no other column, so that clashing names do no harm."""
    small_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def share_by_hash(df: DataFrame, rows: int, about: int, *key: str) -> DataFrame:
    """About ``about`` of the ``rows`` rows of df, by a threshold on the 64-bit hash of the key columns; all rows
    if df is not larger, or has so few different keys that none is below it."""
    share = about / max(rows, 1)
    if share >= 1:
        return df
    some = df.filter(F.xxhash64(*key) < F.lit(int(share * 2**64) - 2**63))
    return df if some.isEmpty() else some


def bounded_sample(df: DataFrame, rows: int, most: int, *key: str) -> DataFrame:
    """At most ``most`` of the ``rows`` rows of df: those with the smallest hashes of the key columns. A
    threshold lets only some more than ``most`` rows into the sort, at any size."""
    some = share_by_hash(df, rows, int(1.2 * (most + 50)), *key)
    return some.orderBy(F.xxhash64(*key), *key).limit(most)


def private(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """df, to be broadcast if it has at most most_rows rows; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= most_rows else df
