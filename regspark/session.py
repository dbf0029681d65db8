"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that the operators count on: results do not depend on the machine's time zone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(name: str, cores: str = "4", shuffle_partitions: int = 8, checkpoint_dir: str | None = None, memory: str = "4g") -> SparkSession:
    """A session on this machine, for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=DEFAULTS)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", memory)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", f"file://{checkpoint_dir}")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
