"""A corpus pipeline: each stage reads what the one before wrote.

STAGES are (name, function); a function takes (spark, docs, sf_dir). All but the last return the
columns of documents; the last returns the packed pieces. ``run`` applies them to documents.

Defined cases, as the operators have them: a null or letterless text has no language and its document goes;
documents without doc_id are nobody's copy and stay; of copies, the smallest doc_id stays, with all its
rows if it comes more than once; repeated rows are judged each by itself; a very long text is one row
until it is packed; empty tables pass through all stages; other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.llm.common import fresh_path
from regspark.llm.decontaminate import without_contaminated
from regspark.llm.language import only_known
from regspark.llm.packing import pack_documents
from regspark.llm.secrets import redact
from regspark.llm.similarity_join import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return only_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, a similarity of 0.8) the smallest doc_id stays."""
    return one_of_each(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark passages go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows, where there is one."""
    done = redact(docs)
    return done.withColumn("n_chars", F.length("text").cast(done.schema["n_chars"].dataType)) if "n_chars" in done.columns else done


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents in sequences of at most 1024 tokens."""
    return pack_documents(docs, with_ids=False)


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate), ("secret scans", secrets), ("best-fit packing", packing)]

#: Tokens, learned profiles and trained Markov models are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
