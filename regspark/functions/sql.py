"""The text functions for those who write SQL: session functions made from the same columns, so that they run inside Spark's
own code like any expression."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import text

#: Name in SQL: (function of a column, what it returns).
FUNCTIONS = {
    "join_key": (text.key, "STRING"), "strip_accents": (text.strip_accents, "STRING"), "fold": (text.fold, "STRING"), "squeeze": (text.squeeze, "STRING"),
    "strip_or_null": (text.strip_or_null, "STRING"), "trim_blank": (text.trim_blank, "STRING"), "digits": (text.digits, "STRING"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to this session's SQL; their names."""
    for name, (function, kind) in FUNCTIONS.items():
        plan = spark.range(0).select(F.lit("").alias("given")).select(function("given").alias("made"))._jdf.queryExecution().analyzed()
        body = plan.expressions().head().child().sql()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(given STRING) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
