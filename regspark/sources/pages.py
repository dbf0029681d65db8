"""Paged JSON: files of pages with their rows in an array, nested rows made flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import cut


def read_pages(spark: SparkSession, path: str, schema: str | None = None, rows: str = "content", last: str = "last", place: Column | None = None, folder: Column | None = None, in_lines: bool = False) -> DataFrame:
    """The rows of the pages of each folder, one file a page, up to the first page that says it is the last, or is empty;
    those after it are left over from a longer answer. A page's place is the last number in its file's name (or ``place``,
    of the column path); page numbers that the answers hold are not trusted. in_lines: files hold many pages, one a line, as
    hundreds of thousands of small files take longer than their content; ``place`` is then of a column that was stored with
    the page when it was asked for."""
    if in_lines and place is None:
        raise ValueError("pages in lines need a place")
    reader = spark.read.option("multiLine", not in_lines)
    found = (reader.schema(schema) if schema else reader).json(path).withColumn("path", F.col("_metadata.file_path"))
    place = F.regexp_extract("path", r"([0-9]+)[^0-9/]*\z", 1).cast("long") if place is None else place
    folder = F.regexp_extract("path", r"\A(.*)/", 1) if folder is None else folder
    empty = F.coalesce(F.size(rows), F.lit(0)) <= 0
    stops = F.coalesce(F.col(last), F.lit(False)) | empty if last in found.columns else empty
    # files are opened once: what ends a folder and what stays are both told by what was read
    own = cut(found.select(place.alias("_place"), folder.alias("_folder"), stops.alias("_stops"), F.col(rows).alias("_rows")).hint("rebalance"))
    ends = own.filter("_stops").groupBy("_folder").agg(F.min("_place").alias("_end"))
    return own.join(ends, "_folder", "left").filter(F.col("_end").isNull() | (F.col("_place") <= F.col("_end"))).filter(F.size("_rows") > 0).select(F.inline("_rows"))


def read_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def flatten(df: DataFrame, array: str, keep: list[str]) -> DataFrame:
    """A row per element of an array of structs, rows with none kept once."""
    return df.select(*keep, F.inline_outer(array))
