"""Whether a query gives the same rows however its work is dealt out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fingerprint import fingerprint

#: Other numbers of partitions, other pieces of files in another order, plans that are not changed at run time.
OTHER_WAYS = (
    {"spark.sql.shuffle.partitions": "3", "spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1024"},
    {"spark.sql.shuffle.partitions": "17", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"},
)


@contextmanager
def dealt(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session's settings, changed for a while."""
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def print_of(df: DataFrame, decimals: int = 6) -> tuple:
    """Rows and hashes; numbers that are not whole count to some decimals, as sums of them depend on the order."""
    rounded = [F.round(F.col(f"`{f.name}`"), decimals).alias(f.name) if isinstance(f.dataType, T.FloatType | T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return tuple(fingerprint(df.select(*rounded)).head())


def differing(spark: SparkSession, make: Callable[[], DataFrame], ways: Sequence[dict[str, str]] = OTHER_WAYS) -> list[dict[str, str]]:
    """The ways in which the query's rows are not what they are as the session stands."""
    want, out = print_of(make()), []
    for settings in ways:
        with dealt(spark, settings):
            if print_of(make()) != want:
                out.append(settings)
    return out
