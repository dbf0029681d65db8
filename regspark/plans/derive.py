"""Derived tables, as functions of their sources; each is a plan that Spark runs as one, but for maker_keys, which needs what it joined twice."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digits, fold, key
from ..operators import lists, merges
from ..operators.store import cut


def label_summary(df: DataFrame, product: str, labels: str, notes: str) -> DataFrame:
    """Per product: contains, may_contain, free_of (what is contained leaves the others, what may be
    contained leaves free_of), gluten and lactose in one word, varies, declared. All lists are null if
    nothing is declared. Labels that are not known count as contained."""
    parsed = lists.label_lists(labels, {"pode conter": "may", "não contém": "free"}, "contains")["groups"]
    # texts repeat from row to row: each different one of a product is read once
    each = df.select(product, labels, notes).distinct().withColumn("_groups", parsed).withColumn("_text", fold(F.coalesce(F.col(notes), F.lit(""))))
    text = F.col("_text")
    flags = {w: lists.tri_state(text.contains(f"{w} - sim"), text.contains(f"{w} - nao")) for w in ("gluten", "lactose")}
    filled = F.nullif(F.trim(labels), F.lit(""))
    declared = F.coalesce(F.bool_or(filled.isNotNull() | F.col(notes).isNotNull()), F.lit(False))
    differ = lambda c: F.coalesce(F.min(c) < F.max(c), F.lit(False))
    varies = differ(filled) | differ(F.col(notes))

    def of_kind(k: str) -> Column:
        own = F.flatten(F.transform(F.filter("_groups", lambda g: g["kind"] == k), lambda g: g["items"]))
        return F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.coalesce(own, F.array().cast("array<string>"))))))

    kinds = ("contains", "may", "free")
    out = each.groupBy(product).agg(declared.alias("declared"), varies.alias("varies"), *(v.alias(k) for k, v in flags.items()), *(of_kind(k).alias(f"_{k}") for k in kinds))
    contains, may, free = (F.col(f"_{k}") for k in kinds)
    shown = lambda c: F.when(F.col("declared"), c)
    return out.select(
        product, "declared", shown(F.col("varies")).alias("varies"), "gluten", "lactose",
        shown(contains).alias("contains"), shown(F.array_except(may, contains)).alias("may_contain"), shown(F.array_except(F.array_except(free, contains), may)).alias("free_of"),
    )


def in_force(validity: str | Column, stamp: str | Column, literal: str = "VIGENTE", fmt: str = "d/M/yyyy") -> Column:
    """Valid by the literal word or by a date not before the file's own date; never by today's."""
    v = F.col(validity) if isinstance(validity, str) else validity
    s = F.col(stamp) if isinstance(stamp, str) else stamp
    return (v == literal) | (F.try_to_timestamp(v, F.lit(fmt)).cast("date") >= s.cast("date"))


def roll_up(keys: DataFrame, key_name: str, parts: dict[str, DataFrame], names: DataFrame) -> DataFrame:
    """One row per key: for each part its rows and active rows (0 where none), totals, and a name."""
    counts = [c for p in parts for c in (p, f"{p}_active")]
    out = merges.star(keys, key_name, [*parts.values(), names], counts)
    total = sum((F.col(p) for p in parts), F.lit(0))
    active = sum((F.col(f"{p}_active") for p in parts), F.lit(0))
    return out.select(key_name, "name", *(F.col(c).cast("int").alias(c) for c in counts), total.cast("int").alias("total"), active.cast("int").alias("active"))


def part_count(df: DataFrame, key_name: str, name: str, active: Column) -> DataFrame:
    return df.groupBy(key_name).agg(F.count(F.lit(1)).alias(name), F.count_if(active).alias(f"{name}_active"))


def maker_links(holders: DataFrame, items: str, root: int = 8) -> DataFrame:
    """(holder, product, active and a text of makers split on |) to one row per holder and maker: the maker read from
    the right, the link by ids (a letter and six digits are abroad), distinct products. Without an id the
    name is the key."""
    # rows of one product repeat their text: it is taken apart once
    once = holders.groupBy("holder", "product", items).agg(F.bool_or("active").alias("active"), F.count(F.lit(1)).alias("n"))
    each = once.select("holder", "product", "active", "n", F.explode(F.filter(F.transform(F.split(items, r"\|"), lambda x: F.trim(x)), lambda x: x != "")).alias("item"))
    parts = lists.from_right("item")
    each = each.select("holder", "product", "active", "n", *(v.alias(k) for k, v in parts.items()))
    named = F.when(F.col("code").isNull(), F.col("name"))
    least = [F.min(c).alias(c) for c in ("name", "city", "country")]
    by_product = each.groupBy("holder", "code", named.alias("by_name"), "product").agg(*least, F.bool_or("active").alias("active"), F.sum("n").alias("n"))
    link = F.when(F.col("code") == F.col("holder"), "own").when(F.col("code").rlike(r"\A[A-Z][0-9]{6}\z"), "abroad").when(F.substring("code", 1, root) == F.substring("holder", 1, root), "group").when(F.col("code").isNotNull(), "other").otherwise("unknown")
    out = by_product.groupBy("holder", "code", "by_name").agg(
        F.min("name").alias("maker"), F.min("city").alias("city"), F.min("country").alias("country"), F.count("product").cast("int").alias("products"),
        F.count(F.when(F.col("active"), F.col("product"))).cast("int").alias("active_products"), F.sum("n").cast("int").alias("rows"),
    )
    return out.withColumn("link", link).drop("by_name")


def maker_keys(rows: DataFrame, products: DataFrame, makers: DataFrame, home: str) -> DataFrame:
    """rows (product, maker_id, active), products (product, holder, holder_name) and makers (maker_id, maker, country) to one
    row per holder, maker key and country, with the commonest spelling; a maker without country is left out. Names are
    folded once a product or maker, never once a row; rows take part as numbers and are joined once."""
    known = makers.filter(F.col("maker").isNotNull() & F.col("country").isNotNull()).withColumn("key", key("maker"))
    groups = cut(known.select("key", "country").distinct().withColumn("group", F.monotonically_increasing_id()))
    known = cut(known.join(groups, ["key", "country"]).select("maker_id", "maker", "group"))
    holders = products.select("product", "holder", key("holder_name").alias("own_key"))
    told = cut(rows.join(holders, "product").join(known.select("maker_id", "group").distinct(), "maker_id").select("holder", "own_key", "product", "group", "maker_id", "active"))
    spelled = told.groupBy("group", "maker_id").agg(F.count(F.lit(1)).alias("n")).join(known, ["group", "maker_id"]).groupBy("group", "maker").agg(F.sum("n").alias("n"))
    spelling = spelled.groupBy("group").agg(F.min_by("maker", F.struct(-F.col("n"), "maker")).alias("maker"))
    by_product = told.groupBy("holder", "group", "product").agg(F.bool_or("active").alias("active"), F.min("own_key").alias("own_key"))
    out = by_product.groupBy("holder", "group").agg(F.count("product").cast("int").alias("products"), F.count(F.when(F.col("active"), F.col("product"))).cast("int").alias("active_products"), F.min("own_key").alias("_own"))
    link = F.when(F.col("country") != home, "abroad").when(F.col("key") == F.col("_own"), "own").otherwise("other")
    out = out.join(groups.join(spelling, "group"), "group")
    return out.withColumn("link", link).select("holder", "key", "country", "maker", "products", "active_products", "link")


def measures(df: DataFrame, group: Sequence[str], target: str, name: str, sets: Sequence[str] = (), numbers: Sequence[str] = (), day: str | None = None) -> DataFrame:
    """Per group: company id (14 digits, not all zeros), company name, person, sorted lists of the different
    values of sets and of the digits of numbers, first and last day. A person's id and name never leave:
    targets of 11 digits make person true and the name null."""
    t = F.col(target)
    company = F.min(F.when(t.rlike(r"\A[0-9]{14}\z") & (t != "0" * 14), t))
    person = F.coalesce(F.bool_or(t.rlike(r"\A[0-9]{11}\z")), F.lit(False))
    more = [lists.sorted_set(c).alias(c) for c in sets] + [lists.sorted_set(F.nullif(digits(c), F.lit(""))).alias(c) for c in numbers]
    if day:
        more += [F.min(day).cast("date").alias("first_day"), F.max(day).cast("date").alias("last_day")]
    return df.groupBy(*group).agg(*more, company.alias("company_id"), person.alias("person"), F.when(person, F.lit(None).cast("string")).otherwise(F.min(F.nullif(F.trim(name), F.lit("")))).alias("company"), F.count(F.lit(1)).alias("rows"))


def area_of(subject: str | Column) -> Column:
    """The area that a folded subject names."""
    s = F.upper(fold(F.col(subject) if isinstance(subject, str) else subject))
    out = F.lit("other")
    for text, name in reversed((("HOUSEHOLD", "home"), ("MACHINE", "industry"), ("AUTO", "vehicles"), ("FURNI", "home"))):
        out = F.when(s.contains(text), name).otherwise(out)
    return F.when(s.isNotNull(), out).otherwise("other")


def companies(areas: dict[str, DataFrame], measured: DataFrame, links: DataFrame) -> DataFrame:
    """One row per company that holds a product in an area (company, name, active: one row a product), was the
    target of a measure (company, dossier, day, name), or packs for another (holder, maker, maker_name, link).
    Counts are zero where there is none; the name is the commonest in the areas, or else that of a
    measure, or else that of the packer's text."""
    named = reduce(DataFrame.unionByName, (a.select("company", "name") for a in areas.values()))
    names = lists.commonest(named.filter("company is not null"), ["company"], "name")
    parts = [part_count(a.filter("company is not null"), "company", n, F.col("active")) for n, a in areas.items()]
    target = F.col("company").rlike(r"\A[0-9]{14}\z") & (F.col("company") != "0" * 14)
    own = measured.filter(target).groupBy("company", "dossier").agg(F.max("day").alias("day"), F.min(F.nullif(F.trim("name"), F.lit(""))).alias("name"))
    measure = own.groupBy("company").agg(F.count("dossier").alias("measures"), F.max("day").cast("date").alias("last_measure"), F.min("name").alias("measure_name"))
    pairs = links.filter(F.col("link").isin("group", "other")).groupBy("holder", "maker").agg(F.min("maker_name").alias("maker_name"))
    packs = pairs.groupBy(F.col("maker").alias("company")).agg(F.count(F.lit(1)).alias("packs_for"), F.min("maker_name").alias("packer_name"))
    packed = pairs.groupBy(F.col("holder").alias("company")).agg(F.count(F.lit(1)).alias("packed_by"))
    keys = reduce(DataFrame.unionByName, (x.select("company") for x in (*parts, measure, packs))).distinct()
    counts = [c for n in areas for c in (n, f"{n}_active")] + ["measures", "packs_for", "packed_by"]
    out = merges.star(keys, "company", [*parts, measure, names, packs, packed], counts)
    total, active = (reduce(lambda a, b: a + b, (F.col(f"{n}{end}") for n in areas)) for end in ("", "_active"))
    shown = [F.col(c).cast("int").alias(c) for c in counts]
    return out.select("company", F.coalesce("name", "measure_name", "packer_name").alias("name"), *shown, total.cast("int").alias("products"), active.cast("int").alias("active"), "last_measure")


def certificates(rows: DataFrame, decided: Sequence[str], root: int = 8) -> DataFrame:
    """One row per id of (id, company, site_company, site_code, subject, state, cancelled, validity, line, data_of): copies
    and lines of one id become one, lines a sorted list. In force: decided, not cancelled and valid on the
    file's own date. The link tells whose the inspected site is."""
    same = ("company", "site_company", "site_code", "subject", "state", "validity", "data_of")
    one = rows.groupBy("id").agg(*(F.min(c).alias(c) for c in same), F.coalesce(F.bool_or("cancelled"), F.lit(False)).alias("cancelled"), lists.sorted_set("line").alias("lines"))
    site, holder = F.col("site_company"), F.col("company")
    link = F.when(site == holder, "own").when(F.substring(site, 1, root) == F.substring(holder, 1, root), "group").when(site.isNotNull(), "other").when(F.col("site_code").isNotNull(), "abroad").otherwise("unknown")
    force = F.col("state").isin(*decided) & ~F.col("cancelled") & F.coalesce(F.col("validity") >= F.col("data_of"), F.lit(False))
    return one.withColumns({"area": area_of("subject"), "in_force": F.coalesce(force, F.lit(False)), "link": link})
