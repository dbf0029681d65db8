"""Profiles, guards, fingerprints, refresh decisions and the catalogue."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import typing as ty
from ..operators import fingerprint, quality, refresh
from ..operators.store import shared_folder
from ..sources import manifest
from ..sources.builds import Builds, Snapshot, Source
from ..sources.spec import Catalogue, Derived, TableSpec
from .registry import query
from .table_queries import read

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf, "orders").select(
        F.when(k % 11 == 0, "x").when(k % 13 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(k % 4 == 0, F.date_format("o_orderdate", "MM-dd-yyyy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"),
        F.when(F.col("o_orderstatus") == "P", "?").otherwise("S").alias("open"),
    )


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.nulls_added(_raw_orders(spark, sf), {"customer": ty.integer("customer"), "day": ty.when_any("day", ["d/M/yyyy"]), "open": ty.flag("open")})


PROFILE_SQL = """
WITH p AS (SELECT 'customer' AS name, count(*) FILTER (WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 > 0) AS present, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS lost FROM orders
UNION ALL SELECT 'day', count(*), count(*) FILTER (WHERE o_orderkey % 4 = 0) FROM orders UNION ALL SELECT 'open', count(*), count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders) """


@query("nulls_added_profile", PROFILE_SQL + "SELECT * FROM p")
def nulls_added_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf)


@query("null_guard", PROFILE_SQL + "SELECT *, lost > present * 0.2 AS failed FROM p")
def null_guard(spark: SparkSession, sf: str) -> DataFrame:
    return quality.over_limit(_profile(spark, sf))


@query("reject_guard", "SELECT count(*) AS records, count(*) FILTER (WHERE contains(text, ';')) AS rejected, count(*) FILTER (WHERE contains(text, ';')) > count(*) * 0.001 AS failed FROM documents")
def reject_guard(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select(F.split(F.concat_ws(";", F.col("doc_id").cast("string"), "text"), ";").alias("fields"))
    good, bad = quality.rejects(d, "fields", 2)
    both = good.select(F.lit(0).alias("r")).union(bad.select(F.lit(1).alias("r"))).agg(F.count(F.lit(1)).alias("records"), F.sum("r").alias("rejected"))
    return quality.over_limit(both, "rejected", "records", 0.001)


@query("shrink_guard", """
SELECT o_orderpriority AS name, count(*) FILTER (WHERE o_orderstatus <> 'P') AS rows, count(*) AS rows_before, count(*) FILTER (WHERE o_orderstatus <> 'P') < count(*) * 0.9 AS failed FROM orders GROUP BY 1""")
def shrink_guard(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    count = lambda df: df.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    return quality.shrunk(count(o.filter("o_orderstatus <> 'P'")), count(o))


@query("source_age", """
SELECT event_type AS name, max(ts) AS newest, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') AS days, CASE event_type WHEN 'click' THEN 7 WHEN 'error' THEN 45 END AS limit,
  coalesce(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') > CASE event_type WHEN 'click' THEN 7 WHEN 'error' THEN 45 END, false) AS failed FROM events GROUP BY event_type""")
def source_age(spark: SparkSession, sf: str) -> DataFrame:
    stamps = read(spark, sf, "events").select(F.col("event_type").alias("name"), F.col("ts").alias("stamp"))
    limits = stamps.select("name").distinct().withColumn("limit", F.when(F.col("name") == "click", 7).when(F.col("name") == "error", 45))
    return quality.source_age(stamps, F.lit("2024-02-15").cast("date"), limits)


@query("domain_checks", "SELECT count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS unknown_flag, count(*) FILTER (WHERE l_discount > 0.09) AS high_discount, count(*) FILTER (WHERE l_partkey IS NULL) AS no_part FROM lineitem")
def domain_checks(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    return li.agg(F.count_if(~F.col("l_returnflag").isin("A", "N")).alias("unknown_flag"), F.count_if(F.col("l_discount") > 0.09).alias("high_discount"), F.count_if(F.col("l_partkey").isNull()).alias("no_part"))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("disjoint_keys", "SELECT count(*) AS common FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)")
def disjoint_keys(spark: SparkSession, sf: str) -> DataFrame:
    a = read(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k"))
    b = read(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_orderkey").alias("k"))
    return a.join(b, "k", "left_semi").distinct().agg(F.count(F.lit(1)).alias("common"))


#: The columns of the tables whose kinds need more than a cast to text.
DOUBLES = {"c_acctbal", "s_acctbal", "p_retailprice", "o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "value"}
STAMPS = {"o_orderdate", "l_shipdate", "ts"}
COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate", "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars", "embeddings": "vec_id embedding label", "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


def hash_sql(columns: str) -> str:
    """A row's hash in SQL."""

    def text(c: str) -> str:
        if c == "embedding":
            return f"'[' || array_to_string(list_transform({c}, lambda x: CASE WHEN x IS NULL THEN 'n' ELSE 'v' || CAST(CAST(CAST(x AS DOUBLE) AS DECIMAL(38, 9)) AS VARCHAR) END), ',') || ']'"
        return f"CAST(CAST({c} AS DECIMAL(38, 9)) AS VARCHAR)" if c in DOUBLES else f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if c in STAMPS else f"CAST({c} AS VARCHAR)"

    each = " || chr(31) || ".join(f"CASE WHEN {c} IS NULL THEN 'n' ELSE 'v' || {text(c)} END" for c in columns.split())
    return f"CAST('0x' || substr(md5({each}), 1, 15) AS BIGINT)"


@query("content_fingerprint", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, bit_xor(h) AS bits, CAST(sum(h) AS VARCHAR) AS total FROM (SELECT {hash_sql(columns)} AS h FROM {t})" for t, columns in COLUMNS.items()))
def content_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    prints = [fingerprint.fingerprint(read(spark, sf, t)).select(F.lit(t).alias("name"), "rows", "bits", F.col("total").cast("string").alias("total")) for t in TABLES]
    return reduce(DataFrame.unionByName, prints)


@query("changed_ranges", f"""
WITH a AS (SELECT o_orderkey AS k, {hash_sql(COLUMNS["orders"])} AS h FROM orders),
b AS (SELECT o_orderkey AS k, {hash_sql(COLUMNS["orders"])} AS h FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3331 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderkey % 2999 <> 7)),
x AS (SELECT k >> 9 AS node, count(*) AS n, bit_xor(h) AS bits, sum(h) AS total FROM a GROUP BY 1), y AS (SELECT k >> 9 AS node, count(*) AS n, bit_xor(h) AS bits, sum(h) AS total FROM b GROUP BY 1)
SELECT node << 9 AS low, (node << 9) + 511 AS high, coalesce(x.n, 0) AS rows_before, coalesce(y.n, 0) AS rows_after FROM x FULL JOIN y USING (node) WHERE (x.n, x.bits, x.total) IS DISTINCT FROM (y.n, y.bits, y.total)""")
def changed_ranges(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    status = F.when(F.col("o_orderkey") % 3331 == 0, "X").otherwise(F.col("o_orderstatus"))
    now = o.filter("o_orderkey % 2999 <> 7").withColumn("o_orderstatus", status)
    before, after = (fingerprint.digests(x, "o_orderkey", leaf_bits=9) for x in (o, now))
    return fingerprint.changed_ranges(before, after, leaf_bits=9)


ORDERS = TableSpec("orders", {"ORDER": "int", "CUSTOMER": "int", "PRIORITY": "string", "DAY": "date"}, sort=("CUSTOMER", "ORDER"), loaded="DAY")
CUSTOMERS = TableSpec("customers", {"CUSTOMER": "int", "SEGMENT": "string"}, sort=("CUSTOMER",))


def _per_segment(have: dict[str, DataFrame]) -> DataFrame:
    both = have["orders"].join(have["customers"], "customer")
    return both.groupBy("segment").agg(F.count(F.lit(1)).alias("orders"), F.max("day").alias("latest"))


def _published(spark: SparkSession, sf: str) -> Snapshot:
    """Two builds: of orders until some day and customers; then of all orders, while customers cannot be opened."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    when = F.when(k % 97 == 0, "31/02/2020").otherwise(F.date_format(day, "d/M/yyyy"))
    fields = F.array(k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderpriority"), when)
    o = read(spark, sf, "orders").select(F.when(k % 2003 == 0, F.array_append(fields, "x")).otherwise(fields).alias("fields"), day.alias("_day"))
    c = read(spark, sf, "customer").select(F.array(F.col("c_custkey").cast("string"), F.col("c_mktsegment")).alias("fields"))

    def closed() -> Source:
        raise OSError("403")

    catalogue = Catalogue(ORDERS, CUSTOMERS, Derived("per_segment", ("orders", "customers"), _per_segment, ("segment",)))
    builds = Builds(spark, shared_folder(spark, "builds"))
    builds.publish(catalogue, {"orders": lambda: Source(o.filter("_day < '2001-07-01'"), "1"), "customers": lambda: Source(c, "1")}, dt.datetime(2024, 1, 1))
    builds.publish(catalogue, {"orders": lambda: Source(o, "2"), "customers": closed}, dt.datetime(2024, 1, 2))
    return builds.live()


@query("published_build", """
SELECT 'orders' AS name, 'built' AS action, count(*) FILTER (o_orderkey % 2003 <> 0) AS rows, count(*) FILTER (o_orderkey % 97 = 0 AND o_orderkey % 2003 <> 0) AS lost, count(*) FILTER (o_orderkey % 2003 = 0) AS rejected,
  CAST(max(o_orderdate) FILTER (o_orderkey % 97 <> 0 AND o_orderkey % 2003 <> 0) AS DATE) AS loaded, NULL AS error FROM orders
UNION ALL SELECT 'customers', 'kept', count(*), 0, 0, NULL, 'OSError: 403' FROM customer
UNION ALL SELECT 'per_segment', 'built', count(DISTINCT c_mktsegment), 0, 0, (SELECT CAST(max(o_orderdate) FILTER (o_orderkey % 97 <> 0 AND o_orderkey % 2003 <> 0) AS DATE) FROM orders), NULL
  FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 2003 <> 0""")
def published_build(spark: SparkSession, sf: str) -> DataFrame:
    rows = _published(spark, sf).manifest()
    return rows.select("name", "action", "rows", F.coalesce(F.try_element_at("nulls_added", F.lit("day")), F.lit(0)).alias("lost"), "rejected", F.col("loaded").cast("date").alias("loaded"), "error")


@query("published_tables", """
SELECT c_mktsegment AS segment, count(*) AS orders, CAST(max(o_orderdate) FILTER (o_orderkey % 97 <> 0) AS DATE) AS latest FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 2003 <> 0 GROUP BY 1""")
def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _published(spark, sf).read("per_segment")


@query("incremental_refresh", """
WITH n AS (SELECT o_orderpriority AS name, count(*) AS now, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-07-01') AS old FROM orders GROUP BY 1),
s AS (SELECT name, CASE WHEN now = old THEN 'carry' ELSE 'build' END AS action FROM n), d AS (SELECT DISTINCT 'all' AS name, name AS source FROM s UNION ALL SELECT 'gone', '9-MISSING')
SELECT * FROM s UNION ALL SELECT d.name, CASE WHEN bool_or(action IS NULL) THEN 'skip' WHEN bool_or(action = 'build') THEN 'build' ELSE 'carry' END FROM d LEFT JOIN s ON s.name = source GROUP BY d.name""")
def incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    mark = lambda df: df.groupBy(F.col("o_orderpriority").alias("name")).agg(F.bit_xor(F.xxhash64(*o.columns)).alias("print"))
    now = mark(o)
    derived = now.select(F.lit("all").alias("name"), F.col("name").alias("source")).unionByName(spark.createDataFrame([("gone", "9-MISSING")], "name string, source string"))
    return refresh.decide(now, mark(o.filter("o_orderdate < '2001-07-01'")), derived)


@query("table_catalog", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, (SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS columns FROM {t}" for t in TABLES))
def table_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.entries({t: read(spark, sf, t) for t in TABLES}).select("name", "rows", F.size("columns").alias("columns"))


@query("data_dictionary", " UNION ALL ".join(f"SELECT '{t}' AS name, column_name AS column FROM information_schema.columns WHERE table_name = '{t}'" for t in TABLES))
def data_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.dictionary(manifest.entries({t: read(spark, sf, t) for t in TABLES})).select("name", "column")
