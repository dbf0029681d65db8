"""Choosing rows, lists, joins, text and types on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import typing as ty
from ..operators import index, lists, merges, rows
from ..operators.store import shared_folder
from .registry import query


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


STATUS = {"O": "Aberto", "F": "Fechado"}


@query("top_orders_per_customer", """
SELECT o_custkey AS custkey, CAST(rn AS INTEGER) AS place, o_orderkey AS orderkey,
  CASE o_orderstatus WHEN 'O' THEN 'Aberto' WHEN 'F' THEN 'Fechado' ELSE 'Outro' END AS status, c_name AS name
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'O') DESC, o_totalprice DESC NULLS LAST, o_orderkey) rn FROM orders)
LEFT JOIN customer ON c_custkey = o_custkey WHERE rn <= 100""")
def top_orders_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    order = [(F.col("o_orderstatus") == "O").desc(), F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    top = rows.top_k(read(spark, sf, "orders"), ["o_custkey"], order, 100)
    label = F.lit("Outro")
    for code, word in STATUS.items():
        label = F.when(F.col("o_orderstatus") == code, word).otherwise(label)
    names = read(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"))
    return top.join(names, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_custkey").alias("custkey"), "place", F.col("o_orderkey").alias("orderkey"), label.alias("status"), "name")


@query("keep_one_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) rn FROM lineitem) WHERE rn = 1""")
def keep_one_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    rest = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    one = rows.keep_one(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last(), *map(F.asc, rest)])
    return one.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("part_presentations", """
SELECT p_partkey AS partkey, min(p_name) AS name, CAST(count(l_orderkey) AS INTEGER) AS presentations, coalesce(bool_or(l_returnflag = 'N'), false) AS active,
  min(l_shipdate) AS since, max(l_shipdate) AS until, CAST(count(DISTINCT l_suppkey) AS INTEGER) AS suppliers,
  coalesce(list_sort(list(DISTINCT l_suppkey) FILTER (WHERE l_linestatus = 'O')), []) AS open_suppliers,
  CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS INTEGER) AS open_lines
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""")
def part_presentations(spark: SparkSession, sf: str) -> DataFrame:
    opened = F.col("l_linestatus") == "O"
    summary = read(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("int").alias("presentations"), F.bool_or(F.col("l_returnflag") == "N").alias("active"), F.min("l_shipdate").alias("since"), F.max("l_shipdate").alias("until"),
        F.count_distinct("l_suppkey").cast("int").alias("suppliers"), lists.sorted_set("l_suppkey", opened).alias("open_suppliers"), F.count_if(opened).cast("int").alias("open_lines"),
    )
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_name").alias("name"))
    both = p.join(summary, F.col("partkey") == F.col("l_partkey"), "left").drop("l_partkey")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("presentations", "suppliers", "open_lines")}
    return both.withColumns({**zero, "active": F.coalesce("active", F.lit(False)), "open_suppliers": F.coalesce("open_suppliers", F.array().cast("array<bigint>"))})


@query("surrogate_ids", """
SELECT c_custkey AS custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'R' || c_custkey END,
  'sem-registro-' || substr(md5(c_name || '|' || c_mktsegment || '|' || coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '')), 1, 12)) AS id,
  regexp_extract(lpad(CAST(c_custkey AS VARCHAR), 14, '0') || ' - ' || c_name, '^([0-9]{14}) - ', 1) AS holder_id,
  regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 14, '0') || ' - ' || c_name, '^([0-9]{14}) - ', '') AS holder FROM customer""")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    known = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("R"), F.col("c_custkey").cast("string")))
    process = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    both = F.concat(F.lpad(F.col("c_custkey").cast("string"), 14, "0"), F.lit(" - "), F.col("c_name"))
    holder_id, holder = ty.id_and_name(both)
    own = ty.surrogate_id(known, "sem-registro-", F.col("c_name"), F.col("c_mktsegment"), F.coalesce(process, F.lit("")))
    return c.select(F.col("c_custkey").alias("custkey"), own.alias("id"), holder_id.alias("holder_id"), holder.alias("holder"))


@query("aligned_lists", """
SELECT l_partkey AS partkey, list(s_name ORDER BY s_name, key, nation) AS makers, list(key ORDER BY s_name, key, nation) AS keys, list(nation ORDER BY s_name, key, nation) AS nations
FROM (SELECT DISTINCT l_partkey, s_name, regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') AS key, CASE WHEN s_nationkey % 5 > 0 THEN n_name END AS nation
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) GROUP BY l_partkey""")
def aligned_lists(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier").join(read(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    s = s.select("s_suppkey", "s_name", tx.key("s_name").alias("key"), F.when(F.col("s_nationkey") % 5 > 0, F.col("n_name")).alias("nation"))
    each = read(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("l_partkey", "s_name", "key", "nation").distinct()
    made = lists.aligned_lists(["s_name", "key", "nation"], ["s_name", "key", "nation"])
    return each.groupBy(F.col("l_partkey").alias("partkey")).agg(made["s_name"].alias("makers"), made["key"].alias("keys"), made["nation"].alias("nations"))


@query("commonest_spelling", """
SELECT p_brand AS brand, p_type AS spelling FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) rn
FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_brand, p_type) WHERE rn = 1""")
def commonest_spelling(spark: SparkSession, sf: str) -> DataFrame:
    both = read(spark, sf, "lineitem").select("l_partkey").join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lists.commonest(both, ["p_brand"], "p_type", "spelling").withColumnRenamed("p_brand", "brand")


@query("list_to_dictionary", """
WITH d AS (SELECT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS k, min(p_partkey) AS number, arg_min(p_name, p_partkey) AS name FROM part WHERE p_size > 20 GROUP BY 1),
g AS (SELECT grp, CASE WHEN grp % 10 < 2 THEN [] ELSE l END AS l FROM (SELECT p_partkey % 300 AS grp, list_sort(list(DISTINCT p_name)) AS l FROM part GROUP BY 1)),
f AS (SELECT grp, part, number, name FROM (SELECT grp, unnest(l) AS part FROM g) LEFT JOIN d ON k = regexp_replace(lower(part), '[^a-z0-9]', '', 'g'))
SELECT g.grp, coalesce(list(part ORDER BY part) FILTER (WHERE part IS NOT NULL), []) AS parts, coalesce(list(number ORDER BY part) FILTER (WHERE part IS NOT NULL), []) AS numbers,
  coalesce(list(name ORDER BY part) FILTER (WHERE part IS NOT NULL), []) AS names, coalesce(bool_and(number IS NOT NULL) FILTER (WHERE part IS NOT NULL), false) AS all_known FROM g LEFT JOIN f USING (grp) GROUP BY g.grp""")
def list_to_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Some lists are null, some hold only blanks; the others have blanks and an empty part."""
    p = read(spark, sf, "part")
    grp = F.col("p_partkey") % 300
    text = F.concat(F.array_join(lists.sorted_set("p_name"), " ; "), F.lit(" ;; "))
    grouped = p.groupBy(grp.alias("grp")).agg(text.alias("text"))
    grouped = grouped.withColumn("text", F.when(F.col("grp") % 10 == 1, " ; ").when(F.col("grp") % 10 > 1, F.col("text")))
    dictionary = p.filter("p_size > 20").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("number"))
    return merges.match_list(grouped, ["grp"], F.split("text", ";"), dictionary, tx.key)


MERGE_SQL = """
WITH l AS (SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT l_orderkey, max(l_linestatus) AS status, min(l_returnflag) AS note, CAST(count(*) AS BIGINT) AS lines FROM lineitem WHERE l_quantity > 20 GROUP BY 1),
m AS (SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, coalesce(l.status, r.status) AS status, coalesce(l.note, r.note) AS note, price, lines,
  CASE WHEN l_orderkey IS NULL THEN 'left' WHEN o_orderkey IS NULL THEN 'right' ELSE 'both' END AS side FROM l FULL JOIN r ON o_orderkey = l_orderkey) """


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    left = read(spark, sf, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("note"), F.col("o_totalprice").alias("price"))
    right = read(spark, sf, "lineitem").filter("l_quantity > 20").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linestatus").alias("status"), F.min("l_returnflag").alias("note"), F.count(F.lit(1)).alias("lines"))
    return merges.merge_by_precedence(left, right, "o_orderkey", ["status", "note"], ["price"], ["lines"])


@query("outer_merge_precedence", MERGE_SQL + "SELECT * FROM m")
def outer_merge_precedence(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf)


@query("merge_coverage", MERGE_SQL + "SELECT count(*) FILTER (WHERE side = 'left') AS left_only, count(*) FILTER (WHERE side = 'right') AS right_only, count(*) FILTER (WHERE side = 'both') AS both FROM m")
def merge_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return merges.coverage(_merged(spark, sf))


@query("semi_join_open", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 45)")
def semi_join_open(spark: SparkSession, sf: str) -> DataFrame:
    some = read(spark, sf, "lineitem").filter("l_linestatus = 'O' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf, "orders").join(some, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


@query("hierarchy_walk", """
SELECT r_name AS region, n_name AS nation, CAST(count(c_custkey) AS INTEGER) AS customers, min(c_name) AS first_name
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY ALL""")
def hierarchy_walk(spark: SparkSession, sf: str) -> DataFrame:
    up = read(spark, sf, "region").join(read(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    down = read(spark, sf, "customer").filter("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("int").alias("customers"), F.min("c_name").alias("first_name"))
    both = up.join(down, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return both.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.coalesce("customers", F.lit(0)).alias("customers"), "first_name")


@query("continuation_merge", """
WITH n AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS entry FROM (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations))
SELECT conv_id, CAST(entry AS BIGINT) AS entry, min(turn) AS first, coalesce(string_agg(CASE WHEN text <> '' THEN text END, ' | ' ORDER BY turn, text), '') AS notes, count(*) AS rows FROM n GROUP BY conv_id, entry""")
def continuation_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    c = c.withColumn("at", F.struct("turn", "role", "text"))
    out = rows.merge_continuations(c, ["conv_id"], "at", F.col("role") == "user", "text")
    return out.withColumn("first", F.col("first.turn"))


@query("stage_order", """
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS from_first, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS from_last FROM events""")
def stage_order(spark: SparkSession, sf: str) -> DataFrame:
    return rows.stages(read(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("event_id", "user_id", "from_first", "from_last")


@query("stable_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders")
def stable_row_id(spark: SparkSession, sf: str) -> DataFrame:
    return rows.stable_row_number(read(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "row_id").select("o_orderkey", "row_id")


@query("typed_projection", """
SELECT o_orderkey AS orderkey, CAST(CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS INTEGER) AS customer, CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS open,
  CAST(o_orderdate AS DATE) AS day FROM orders""")
def typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    raw = o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_custkey").cast("string")).otherwise("1.5").alias("customer"), F.when(F.col("o_orderstatus") == "O", "S").when(F.col("o_orderstatus") == "F", "0").otherwise("?").alias("open"), F.date_format("o_orderdate", "d/M/yyyy").alias("day"))
    return raw.select(F.col("o_orderkey").alias("orderkey"), ty.integer("customer").alias("customer"), ty.flag("open").alias("open"), ty.when_any("day", ["d/M/yyyy HH:mm:ss", "d/M/yyyy"]).cast("date").alias("day"))


@query("date_formats", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN date_trunc('month', ts) END AS at FROM events""")
def date_formats(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id") % 4
    text = F.when(k == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).when(k == 1, F.date_format("ts", "d/M/yyyy")).when(k == 2, F.date_format("ts", "MMyyyy")).otherwise("31/02/2024")
    return read(spark, sf, "events").select("event_id", ty.when_any(text, ["d/M/yyyy HH:mm:ss", "d/M/yyyy", "MMyyyy"]).alias("at"))


@query("flag_decode", "SELECT l_returnflag AS code, CASE WHEN l_returnflag IN ('A') THEN true WHEN l_returnflag = 'N' THEN false END AS flag, CASE WHEN l_returnflag = 'A' THEN 'S' WHEN l_returnflag = 'N' THEN 'N' END AS word, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def flag_decode(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("l_returnflag")
    raw = read(spark, sf, "lineitem").groupBy(c.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    code = F.when(F.col("code") == "A", "S").when(F.col("code") == "N", "N").otherwise("R")
    word = F.when(F.col("code") == "A", " SIM ").when(F.col("code") == "N", "não").otherwise("talvez")
    return raw.select("code", ty.flag(code).alias("flag"), ty.yes_no(word).alias("word"), "n")


@query("money_centavos", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(round(l_extendedprice * 100) AS INTEGER) END AS cents, l_returnflag = 'R' AS marked FROM lineitem""")
def money_centavos(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    # a third decimal is cut; thirty millions are more than an integer of cents holds
    shown = F.when(F.col("l_linenumber") == 7, "30.000.000,00").when(F.col("l_linenumber") == 6, F.concat(shown, F.lit("9"))).otherwise(shown)
    raw = read(spark, sf, "lineitem").withColumn("shown", F.concat(shown, F.when(F.col("l_returnflag") == "R", "*").otherwise("")))
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", ty.cents("shown").alias("cents"), ty.marked(["shown"]).alias("marked"))


@query("placeholder_null", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name END AS name FROM part")
def placeholder_null(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).when(F.col("p_size") % 3 == 1, " - ").otherwise("  ")
    return read(spark, sf, "part").select("p_partkey", ty.placeholder_null(raw).alias("name"))


@query("digits_prefix", "SELECT c_custkey, '1' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS code, substr('1' || lpad(CAST(c_custkey AS VARCHAR), 12, '0'), 1, 9) AS prefix FROM customer")
def digits_prefix(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.concat(F.lit("1."), F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    return read(spark, sf, "customer").select("c_custkey", tx.digits(shown).alias("code"), ty.prefix_key(shown).alias("prefix"))


@query("wide_prices", """
SELECT l_orderkey, l_linenumber, l_partkey, rate, CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 + rate) / 100) AS BIGINT) AS price FROM lineitem, (SELECT unnest([0, 12, 17, 18, 20])  AS rate)""")
def wide_prices(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    rates = (0, 12, 17, 18, 20)
    wide = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *(F.floor(cents * (100 + r) / 100).cast("long").alias(f"pf_{r}") for r in rates))
    return wide.unpivot(["l_orderkey", "l_linenumber", "l_partkey"], [f"pf_{r}" for r in rates], "rate", "price").withColumn("rate", F.expr("cast(substr(rate, 4) as int)"))


@query("epoch_ms", "SELECT event_id, date_trunc('milliseconds', ts) AS at, date_trunc('milliseconds', ts) - INTERVAL 3 HOUR AS local FROM events")
def epoch_ms(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    at = ty.epoch_ms(ms)
    return read(spark, sf, "events").select("event_id", at.cast("timestamp_ntz").alias("at"), F.from_utc_timestamp(at, "America/Sao_Paulo").cast("timestamp_ntz").alias("local"))


@query("component_timestamp", "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN date_trunc('second', ts) END AS at FROM events")
def component_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.array(*(F.date_part(F.lit(p), "ts").cast("int") for p in ("year", "month", "day", "hour", "minute", "second")))
    short = F.when(F.col("event_id") % 3 > 0, parts).otherwise(F.slice(parts, 1, 3))
    return read(spark, sf, "events").select("event_id", ty.from_components(short).alias("at"))


@query("fold_key", "SELECT doc_id, regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g') AS key FROM documents")
def fold_key(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", tx.key("text").alias("key"))


@query("search_contains", "SELECT doc_id FROM documents WHERE lang = 'fr' AND contains(lower(strip_accents(coalesce(text, ''))), 'ement')")
def search_contains(spark: SparkSession, sf: str) -> DataFrame:
    return merges.search(read(spark, sf, "documents"), equals={"lang": "fr", "source": None}, contains={"text": "ÉMENT"}).select("doc_id")


@query("search_page", """
WITH f AS (SELECT *, count(*) OVER () AS total FROM part WHERE contains(lower(p_name), 'ring'))
SELECT p_partkey, p_name, total, CAST(ceil(total / 20) AS BIGINT) AS pages, total <= 40 AS last FROM f ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 20""")
def search_page(spark: SparkSession, sf: str) -> DataFrame:
    found = merges.search(read(spark, sf, "part"), contains={"p_name": "RING"})
    return rows.numbered_page(found, 2, 20, [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_partkey", "p_name", "total", "pages", "last")


@query("string_functions", """
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, strpos(c_name, '#') AS at, c_name[1:8] AS head, right(c_name, 3) AS tail, replace(c_name, '0', '') AS without,
  list_sort(string_split(c_mktsegment, 'U')) AS parts, regexp_matches(c_name, '1[0-9]$') AS teen, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment FROM customer WHERE c_name <> ''""")
def string_functions(spark: SparkSession, sf: str) -> DataFrame:
    n, s = F.col("c_name"), F.col("c_mktsegment")
    return read(spark, sf, "customer").filter(n != "").select(
        "c_custkey", F.upper(s).alias("up"), F.lower(n).alias("low"), F.instr(n, "#").cast("long").alias("at"), F.substring(n, 1, 8).alias("head"), F.expr("right(c_name, 3)").alias("tail"), F.replace(n, F.lit("0"), F.lit("")).alias("without"),
        F.sort_array(F.split(s, "U", -1)).alias("parts"), n.rlike("1[0-9]$").alias("teen"), F.coalesce(F.nullif(s, F.lit("BUILDING")), F.lit("none")).alias("segment"),
    )


@query("exact_copies", "SELECT md5(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def exact_copies(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return d.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).filter("copies > 1")


@query("set_operations", "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    a, b = read(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")), read(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return a.distinct().unionByName(b.distinct()).distinct()


WORDS_SQL = """
WITH f AS (SELECT doc_id, lower(strip_accents(translate(text, '''’‘`´', ''))) AS t FROM documents),
s AS (SELECT DISTINCT doc_id, w AS word FROM (
  SELECT doc_id, w FROM (SELECT doc_id, unnest(string_split_regex(t, '[^a-z0-9]+')) AS w FROM f) WHERE length(w) > 1 AND w NOT IN ('de', 'da', 'do', 'das', 'dos', 'para', 'com', 'em', 'e', 'a', 'o')
  UNION ALL SELECT doc_id, w FROM (SELECT doc_id, replace(unnest(regexp_extract_all(t, '[a-z0-9]+(?:-[a-z0-9]+)+')), '-', '') AS w FROM f) WHERE length(w) > 1 AND w NOT IN ('de', 'da', 'do', 'das', 'dos', 'para', 'com', 'em', 'e', 'a', 'o'))) """


def _posted(spark: SparkSession, sf: str) -> DataFrame:
    return index.postings(read(spark, sf, "documents"), "text", ["doc_id"])


@query("inverted_index", WORDS_SQL + "SELECT * FROM s")
def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return _posted(spark, sf)


@query("vocabulary", WORDS_SQL + "SELECT word, count(*) AS n FROM s GROUP BY word")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return index.vocabulary(_posted(spark, sf))


PACK_SQL = WORDS_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + """,
o AS (SELECT word, n, CAST(sum(n) OVER (ORDER BY word) AS BIGINT) AS s, row_number() OVER (ORDER BY word) AS i FROM (SELECT word, count(*) AS n FROM s GROUP BY word)),
p(b, start) AS (SELECT 0, min(i) FROM o UNION ALL
  SELECT p.b + 1, min(y.i) FROM p JOIN o x ON x.i = p.start JOIN o y ON y.i > x.i AND y.s - (x.s - x.n) > 3000 GROUP BY p.b),
k AS (SELECT word, n, CAST(count(*) - 1 AS INTEGER) AS bucket FROM o JOIN p ON p.start <= o.i GROUP BY word, n) """


@query("packed_buckets", PACK_SQL + "SELECT * FROM k")
def packed_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return index.packed(index.vocabulary(_posted(spark, sf)), "word", 3000)


@query("index_table", PACK_SQL + "SELECT 'word' AS kind, min(word) AS first_key, max(word) AS last_key, CAST(sum(n) AS BIGINT) AS rows, bucket FROM k GROUP BY bucket")
def index_table(spark: SparkSession, sf: str) -> DataFrame:
    return index.index_table(index.packed(index.vocabulary(_posted(spark, sf)), "word", 3000), "word", "word")


@query("range_buckets", WORDS_SQL.rstrip() + ", c AS (SELECT word, count(*) AS n FROM s GROUP BY word), r AS (SELECT word, n, sum(n) OVER (ORDER BY word) - n AS before FROM c) SELECT word, n, CAST(floor(before / 3000) AS INTEGER) AS bucket FROM r")
def range_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return index.buckets(index.vocabulary(_posted(spark, sf)), "word", 3000)


@query("company_buckets", """
WITH RECURSIVE c AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS company, count(*) AS n FROM orders GROUP BY 1),
o AS (SELECT company, n, CAST(sum(n) OVER (ORDER BY company) AS BIGINT) AS s, row_number() OVER (ORDER BY company) AS i FROM c),
p(b, start) AS (SELECT 0, min(i) FROM o UNION ALL SELECT p.b + 1, min(y.i) FROM p JOIN o x ON x.i = p.start JOIN o y ON y.i > x.i AND y.s - (x.s - x.n) > 3000 GROUP BY p.b)
SELECT company, n, CAST(count(*) - 1 AS INTEGER) AS bucket FROM o JOIN p ON p.start <= o.i GROUP BY company, n""")
def company_buckets(spark: SparkSession, sf: str) -> DataFrame:
    counts = read(spark, sf, "orders").groupBy(F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("company")).agg(F.count(F.lit(1)).alias("n"))
    return index.packed(counts, "company", 3000)


@query("company_names", "SELECT c_nationkey, min(c_name) AS c_name FROM customer GROUP BY 1")
def company_names(spark: SparkSession, sf: str) -> DataFrame:
    return index.company_names(read(spark, sf, "customer"), "c_nationkey", "c_name")


@query("number_buckets", "SELECT CAST(k AS VARCHAR) AS number, right(CAST(k AS VARCHAR), 3) AS bucket FROM (SELECT o_orderkey AS k FROM orders UNION ALL SELECT o_custkey FROM orders)")
def number_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return index.number_buckets(read(spark, sf, "orders"), ["o_orderkey", "o_custkey"])


def _part_index(spark: SparkSession, sf: str) -> str:
    p = read(spark, sf, "part").withColumn("company", F.lpad((F.col("p_partkey") % 40).cast("string"), 14, "0"))
    folder = shared_folder(spark, "index")
    index.write_index(p, folder, "p_name", "company", "p_brand", ["p_partkey"], ["p_partkey"])
    return folder


@query("index_lookup", """
SELECT 'words' AS route, p_partkey FROM part WHERE regexp_matches(lower(p_name), '(^| )wid') AND regexp_matches(lower(p_name), '(^| )re')
UNION ALL SELECT 'company', p_partkey FROM part WHERE p_partkey % 40 = 7 UNION ALL SELECT 'number', p_partkey FROM part WHERE p_partkey = 123""")
def index_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The index is written, then asked by each of its routes."""
    asked = spark.createDataFrame([("words", "Wid, ré"), ("company", "7".zfill(14)), ("number", "123")], "query string, text string")
    return index.look_up_all(spark, _part_index(spark, sf), asked, "p_partkey", "company").withColumnRenamed("query", "route")


@query("bulk_lookup", """
WITH w AS (SELECT p_partkey, lower(p_name) AS name FROM part),
q AS (SELECT DISTINCT name AS query, left(split_part(name, ' ', 1), 4) AS a, left(split_part(name, ' ', 2), 3) AS b FROM w)
SELECT query, w.p_partkey FROM q JOIN w ON (starts_with(name, a) OR contains(name, ' ' || a)) AND (starts_with(name, b) OR contains(name, ' ' || b))
UNION ALL SELECT 'c' || a.p_partkey, b.p_partkey FROM part a JOIN part b ON a.p_partkey < 40 AND b.p_partkey % 40 = a.p_partkey
UNION ALL SELECT 'k' || p_partkey, p_partkey FROM part""")
def bulk_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Each name, each number and some companies are asked at once."""
    p, k = read(spark, sf, "part"), F.col("p_partkey").cast("string")
    w = F.split("p_name", " ")
    asked = p.select(F.lower("p_name").alias("query"), F.concat_ws(" ", F.left(w[0], F.lit(4)), F.left(w[1], F.lit(3))).alias("text"))
    asked = asked.unionByName(p.filter("p_partkey < 40").select(F.concat(F.lit("c"), k).alias("query"), F.lpad(k, 14, "0").alias("text"))).unionByName(p.select(F.concat(F.lit("k"), k).alias("query"), k.alias("text")))
    return index.look_up_all(spark, _part_index(spark, sf), asked, "p_partkey", "company")
