"""Tables that are written once where all machines find them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all machines share: in the session's spark.checkpoint.dir. Only a local session may lack one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read back: it is computed once, lost executors cost none
    of it, and later reads take the columns that they need."""
    path, schema = shared_folder(df.sparkSession, "cut"), df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete what cut() wrote, once nothing will read it again."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for file in table.inputFiles():
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder, True)
            break


#: Rows and bytes that go to Python at once: what a task holds of texts, on either side.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def small_batches(df: DataFrame) -> DataFrame:
    """df, once its session hands batches of bounded size to Python. The setting stays: it changes no
    result, and smaller settings are left alone."""
    conf = df.sparkSession.conf
    for name, most in BATCHES.items():
        own = conf.get(name).rstrip("bB")
        if not own.isdigit() or not 0 < int(own) <= int(most):
            conf.set(name, most)
    return df
