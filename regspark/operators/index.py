"""A search index by words, companies and numbers: postings, vocabulary, buckets, files and look-ups."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_or_null, words
from .rows import running_sum, spread
from .store import cut


def postings(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """A row per different word of a row's name, with the given columns."""
    return spread(df).select(*columns, F.explode(words(name)).alias("word"))


def vocabulary(posted: DataFrame) -> DataFrame:
    return posted.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def buckets(counts: DataFrame, key: str, target: int) -> DataFrame:
    """Consecutive keys in buckets of about target rows: the bucket is the running sum before the key
    over the target. Sums run over ranges of keys, whose totals alone meet in one place."""
    return running_sum(counts, key, "n", "before").select(key, "n", F.floor(F.col("before") / target).cast("int").alias("bucket"))


def _next(sums: np.ndarray, start: int, target: int) -> int:
    """Where the bucket ends that begins at a place; sums[k] is the sum before place k."""
    return max(int(np.searchsorted(sums, sums[start] + target, "right")) - 1, start + 1)


def fill_map(sizes: np.ndarray, target: int) -> tuple[list[int], list[int], list[int]]:
    """What a range of keys does to the bucket that is open before it: for a fill of up to ``most`` the fill after it (0: grows
    by the whole range) and how many buckets began. A fill of target is full."""
    sums, known = np.concatenate([[0], np.cumsum(sizes)]), {}
    end = len(sizes)
    most, after, began = [], [], []
    if sums[end] < target:
        most, after, began = [target - int(sums[end])], [0], [0]
    for start in range(min(end, int(np.searchsorted(sums, target))) - 1, -1, -1):
        at, passed = start, []
        while at < end and at not in known:
            passed.append(at)
            at = _next(sums, at, target)
        fill, n = known.get(at, (0, 0)) if at < end else (min(int(sums[end] - sums[passed[-1]]), target), 0)
        for k, place in enumerate(reversed(passed), 1):
            known[place] = fill, n + k
        fill, n = known[start]
        if after and (after[-1], began[-1]) == (fill, n):
            most[-1] = target - int(sums[start])
        else:
            most, after, began = [*most, target - int(sums[start])], [*after, fill], [*began, n]
    return most, after, began


def fills(maps: list[tuple[int, list[int], list[int], list[int]]], target: int) -> list[tuple[int, int]]:
    """(fill, buckets begun) before each range of (sum, most, after, began), in order."""
    out, fill, begun = [], target, 0
    for total, most, after, began in maps:
        out.append((fill, begun))
        k = bisect_left(most, fill)
        fill, begun = (after[k] if began[k] else fill + total), begun + began[k]
    return out


def bucket_numbers(sizes: np.ndarray, target: int, fill: int, begun: int) -> np.ndarray:
    """The bucket of each key of a range."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    begins = np.zeros(len(sizes), np.int64)
    at = int(np.searchsorted(sums, target - fill, "right")) - 1
    while at < len(sizes):
        begins[at] = 1
        at = _next(sums, at, target)
    return begun - 1 + np.cumsum(begins)


def packed(counts: DataFrame, key: str, target: int) -> DataFrame:
    """Exact greedy packing of the ordered (key, n), n at least 1: a bucket closes when the next key would pass
    the target, a larger key stands alone.

    Keys are dealt by ranges. What a range does to the open bucket depends on that bucket's fill alone, and packings that
    begin at different keys soon agree, so a range tells it in a few numbers (``fill_map``). These are followed in order,
    one step a range, and each range numbers its buckets from the fill that really reaches it."""
    dealt = cut(counts.select(key, F.col("n").cast("long").alias("n")).repartitionByRange(key).withColumn("_p", F.spark_partition_id()))

    def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.take(pc.sort_indices(table, [(key, "ascending")], null_placement="at_start"))
        return table, table["n"].to_numpy()

    def tell(table: pa.Table) -> pa.Table:
        _, sizes = ordered(table)
        most, after, began = fill_map(sizes, target)
        return pa.table({"p": pa.array([table["_p"][0].as_py()], pa.int32()), "total": [int(sizes.sum())], "most": [most], "after": [after], "began": [began]})

    told = sorted(dealt.groupBy("_p").applyInArrow(tell, "p int, total long, most array<long>, after array<long>, began array<long>").collect(), key=lambda r: r["p"])  # a row a partition
    entered = list(zip((r["p"] for r in told), fills([(r["total"], r["most"], r["after"], r["began"]) for r in told], target), strict=True))
    before = dealt.sparkSession.createDataFrame([(p, fill, begun) for p, (fill, begun) in entered], "_p int, _fill long, _begun long")

    def number(table: pa.Table) -> pa.Table:
        table, sizes = ordered(table)
        own = bucket_numbers(sizes, target, table["_fill"][0].as_py(), table["_begun"][0].as_py())
        return pa.table([table[key], table["n"], pa.array(own, pa.int32())], [key, "n", "bucket"])

    return dealt.join(F.broadcast(before), "_p").groupBy("_p").applyInArrow(number, T.StructType([dealt.schema[key], T.StructField("n", T.LongType()), T.StructField("bucket", T.IntegerType())]))


def index_table(bucketed: DataFrame, key: str, kind: str) -> DataFrame:
    """kind, first_key, last_key, rows, bucket."""
    own = bucketed.groupBy("bucket").agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.sum("n").cast("long").alias("rows"))
    return own.select(F.lit(kind).alias("kind"), F.col("first_key").cast("string"), F.col("last_key").cast("string"), "rows", "bucket")


def number_buckets(df: DataFrame, columns: Sequence[str], last: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """(number, bucket and what to keep) of all-digit values of the columns, by their last digits."""
    each = df.select(*keep, F.explode(F.array(*(F.col(c).cast("string") for c in columns))).alias("number")).filter(r"number rlike '\\A[0-9]+\\z'")
    return each.withColumn("bucket", F.expr(f"right(number, {last})"))


def company_names(df: DataFrame, company: str, name: str) -> DataFrame:
    """One name a company, the first in order."""
    return df.groupBy(company).agg(F.min(name).alias(name))


def write_index(df: DataFrame, folder: str, name: str, company: str, company_name: str, numbers: Sequence[str], columns: Sequence[str], target: int = 3000, part_rows: int = 1_000_000) -> None:
    """The index of df in a folder: words and companies in buckets of keys, numbers by their last digits, the
    table of buckets, all keys with their buckets, company names and the vocabulary. A key with many rows is written by
    several tasks, in parts of some ``part_rows``. A missing column is an error before any work."""
    missing = {name, company, company_name, *numbers, *columns} - set(df.columns)
    if missing:
        raise ValueError(f"the index needs the columns {', '.join(sorted(missing))}")
    keep = list(dict.fromkeys([*columns, company]))
    # a file a bucket: what costs is the number of files, so that small tables are written by all cores too
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    posted = cut(postings(df, name, keep))
    by_word = cut(packed(vocabulary(posted), "word", target))
    by_company = cut(packed(df.filter(F.col(company).isNotNull()).groupBy(company).agg(F.count(F.lit(1)).alias("n")), company, target))
    part = F.pmod(F.xxhash64(*keep), F.ceil(F.col("n") / part_rows)).alias("_part")
    for path, rows, of, key in (("words", posted, by_word, "word"), ("companies", df.select(*keep), by_company, company)):
        parts = rows.join(of.select(key, "n", "bucket"), key).select(*rows.columns, "bucket", part)
        parts.repartition(tasks, "bucket", "_part").drop("_part").sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(f"{folder}/{path}")
    number_buckets(df, numbers, keep=keep).repartition(tasks, "bucket").sortWithinPartitions("bucket", "number").write.partitionBy("bucket").parquet(f"{folder}/numbers")
    index_table(by_word, "word", "word").unionByName(index_table(by_company, company, "company")).write.parquet(f"{folder}/buckets")
    keys = by_word.select(F.lit("word").alias("kind"), F.col("word").alias("key"), "n", "bucket").unionByName(by_company.select(F.lit("company").alias("kind"), F.col(company).cast("string").alias("key"), "n", "bucket"))
    keys.repartitionByRange("kind", "key").sortWithinPartitions("kind", "key").write.parquet(f"{folder}/keys")
    company_names(df, company, company_name).write.parquet(f"{folder}/names")
    by_word.select("word", "n").write.parquet(f"{folder}/vocabulary")


def look_up_all(spark: SparkSession, folder: str, queries: DataFrame, key: str, company: str) -> DataFrame:
    """query, and the key of each row that it finds, for a table of (query, text): 14 digits are a company, other digits
    a number; else each word of the text must begin a word of the name.

    A query's rarest word finds rows, the others narrow them. Nothing is collected: buckets are
    joined as a partition column, so that Spark leaves out at run time the files of buckets that no query asks."""
    asked = cut(queries.select("query", strip_or_null("text").alias("text")).filter("text is not null").distinct())
    digits = F.col("text").rlike(r"\A[0-9]+\z")
    keys = spark.read.parquet(f"{folder}/keys")
    by_company = asked.filter(digits & (F.length("text") == 14)).select("query", F.col("text").alias("key")).join(keys.filter("kind = 'company'").select("key", "bucket"), "key")
    companies = spark.read.parquet(f"{folder}/companies").withColumn("key", F.col(company).cast("string"))
    found = companies.join(by_company, ["bucket", "key"]).select("query", F.col(f"`{key}`").alias("found"))
    by_number = asked.filter(digits & (F.length("text") != 14)).select("query", F.col("text").alias("number"), F.expr("right(text, 3)").alias("bucket"))
    rows = spark.read.option("basePath", f"{folder}/numbers").schema(companies.select(key).schema.add("number", "string").add("bucket", "string")).parquet(f"{folder}/numbers")
    found = found.unionByName(rows.join(by_number, ["bucket", "number"]).select("query", F.col(f"`{key}`").alias("found")))

    begins = asked.filter(~digits).select("query", F.explode(words("text")).alias("begin"))
    distinct = cut(begins.select("begin").distinct())
    # every beginning of a known word that some query has
    known = keys.filter("kind = 'word'").select("key", "n", "bucket", F.explode(F.transform(F.sequence(F.lit(2), F.length("key")), lambda k: F.substring("key", F.lit(1), k))).alias("begin"))
    reach = cut(known.join(distinct, "begin").select("begin", F.col("key").alias("word"), "n", "bucket"))
    often = reach.groupBy("begin").agg(F.sum("n").alias("often"))
    rated = begins.join(often, "begin", "left").withColumns({"place": F.row_number().over(Window.partitionBy("query").orderBy("often", "begin")), "words": F.count(F.lit(1)).over(Window.partitionBy("query"))})
    rated = cut(rated)  # a word that nothing begins with comes first and finds nothing
    posted = spark.read.parquet(f"{folder}/words")
    hits = lambda some: posted.join(reach.join(some.select("begin").distinct(), "begin", "left_semi"), ["bucket", "word"]).select("begin", F.col(f"`{key}`").alias("found")).distinct()
    rarest = rated.filter("place = 1")
    first = cut(hits(rarest).join(rarest.select("query", "begin", "words"), "begin").select("query", "found", "words"))
    others = rated.filter("place > 1")
    narrowed = first.filter("words > 1").join(others.select("query", "begin"), "query").join(hits(others), ["begin", "found"])
    whole = narrowed.groupBy("query", "found", "words").agg(F.count(F.lit(1)).alias("n")).filter("n = words - 1").select("query", "found")
    return found.unionByName(first.filter("words = 1").select("query", "found")).unionByName(whole).distinct().withColumnRenamed("found", key)


def look_up(spark: SparkSession, folder: str, query: str, key: str, company: str) -> DataFrame:
    """Keys of the rows that one query finds."""
    return look_up_all(spark, folder, spark.createDataFrame([(1, query)], "query int, text string"), key, company).select(key)
