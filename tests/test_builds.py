"""A build is published whole or not at all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regspark.operators.quality import QualityError
from regspark.sources.builds import BuildError, Builds, Limits, Source, quoted_source
from regspark.sources.spec import Catalogue, Derived, SchemaDrift, TableSpec

SALES = TableSpec("sales", {"ID": "int", "DAY": "date", "SHOP": "string"}, sort=("SHOP", "ID"), loaded="DAY", descriptions={"ID": "the number"})
SHOPS = TableSpec("shops", {"SHOP": "string", "TOWN": "string"})
BY_TOWN = Derived("by_town", ("sales", "shops"), lambda have: have["sales"].join(have["shops"], "shop").groupBy("town").agg(F.count(F.lit(1)).alias("n")), ("town",))
CATALOGUE = Catalogue(SALES, SHOPS, BY_TOWN)
DAY = dt.datetime(2024, 1, 1)


def source(spark, rows, stamp):
    df = spark.createDataFrame([(r,) for r in rows], "fields array<string>")
    return lambda: Source(df, stamp)


def closed():
    raise OSError("403")


@pytest.fixture
def world(spark, tmp_path):
    sales = [[str(k), "3/2/2020" if k else "4/3/2021", "ab"[k % 2]] for k in range(20)]
    shops = [["a", "X"], ["b", "Y"]]
    builds = Builds(spark, f"file://{tmp_path}/site")
    builds.publish(CATALOGUE, {"sales": source(spark, sales, "s1"), "shops": source(spark, shops, "h1")}, DAY)
    return builds, sales, shops


def towns(builds):
    return {r["town"]: r["n"] for r in builds.live().read("by_town").collect()}


def rows(builds):
    return {r["name"]: r for r in builds.live().manifest().collect()}


def test_first_build(world):
    builds, *_ = world
    assert builds.live().build == "20240101T000000Z" and towns(builds) == {"X": 10, "Y": 10}
    own = rows(builds)["sales"]
    assert (own["rows"], own["action"], own["rejected"], own["nulls_added"]["day"], own["loaded"], own["sort"]) == (20, "built", 0, 0, dt.datetime(2021, 3, 4), ["shop", "id"])
    assert [tuple(c) for c in own["columns"]][0] == ("id", "int", "ID", "the number")
    derived = rows(builds)["by_town"]
    assert derived["sources"] == ["sales", "shops"] and derived["loaded"] == own["loaded"]


def test_unchanged_carried_and_kept(spark, world):
    builds, sales, shops = world
    same = {"sales": source(spark, sales, "s1"), "shops": source(spark, shops, "h1")}
    assert builds.publish(CATALOGUE, same, DAY + dt.timedelta(1)).build is None
    assert builds.publish(CATALOGUE, {**same, "shops": closed}, DAY + dt.timedelta(1)).kept == {"shops": "OSError: 403"}
    assert builds.live().build == "20240101T000000Z"
    # one source changed: the other is carried by reference, what is derived from both is made anew
    out = builds.publish(CATALOGUE, {**same, "sales": source(spark, sales[:19], "s2")}, DAY + dt.timedelta(2))
    assert out.build == "20240103T000000Z" and towns(builds) == {"X": 10, "Y": 9}
    assert {n: (r["action"], r["build"]) for n, r in rows(builds).items()} == {"sales": ("built", out.build), "shops": ("carried", "20240101T000000Z"), "by_town": ("built", out.build)}
    # a source that cannot be opened keeps the former table, with the error
    out = builds.publish(CATALOGUE, {"sales": closed, "shops": source(spark, [["a", "Z"], ["b", "Z"]], "h2")}, DAY + dt.timedelta(3))
    assert towns(builds) == {"Z": 19} and (rows(builds)["sales"]["action"], rows(builds)["sales"]["error"]) == ("kept", "OSError: 403")
    # other code makes everything anew, and descriptions of today are told with tables of yesterday
    told = Catalogue(SALES, TableSpec("shops", dict(SHOPS.columns), descriptions={"TOWN": "where"}), BY_TOWN)
    builds.publish(told, {"sales": source(spark, sales, "s3"), "shops": closed}, DAY + dt.timedelta(4))
    assert [c["description"] for c in rows(builds)["shops"]["columns"]] == ["", "where"]
    builds.publish(CATALOGUE, same, DAY + dt.timedelta(5), code="2")
    assert {r["action"] for r in rows(builds).values()} == {"built"}


def test_nothing_is_seen_of_a_build_that_stops(spark, world):
    builds, sales, shops = world
    now = {"sales": source(spark, sales[:19], "s2"), "shops": source(spark, shops, "h1")}

    def stop(build, manifest):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        builds.publish(CATALOGUE, now, DAY + dt.timedelta(1), flip=stop)
    assert builds.live().build == "20240101T000000Z" and towns(builds) == {"X": 10, "Y": 10}
    reader = builds.live()
    builds.publish(CATALOGUE, now, DAY + dt.timedelta(2))
    assert reader.read("sales").count() == 20 and builds.live().read("sales").count() == 19  # a reader stays with its build


def test_checks_publish_nothing(spark, world):
    builds, sales, shops = world
    later, shop = DAY + dt.timedelta(1), {"shops": source(spark, shops, "h1")}
    for bad, error, limits in (
        ([[k, "31/02/2020", s] for k, _, s in sales], "sales: day: 20 of 20 values do not parse", Limits()),
        (sales[:17], "17 rows, 20 in the live build", Limits()),
        ([*sales, ["1", "2"]], "1 records of another width", Limits()),
    ):
        with pytest.raises(QualityError, match=error):
            builds.publish(CATALOGUE, {**shop, "sales": source(spark, bad, "x")}, later, limits=limits)
    with pytest.raises(BuildError, match="never published"):
        builds.publish(Catalogue(*CATALOGUE.tables.values(), TableSpec("new", {"A": "string"})), {**shop, "sales": source(spark, sales, "s1"), "new": closed}, later)
    with pytest.raises(BuildError, match="not after"):
        builds.publish(CATALOGUE, {**shop, "sales": source(spark, sales, "s2")}, DAY)
    assert towns(builds) == {"X": 10, "Y": 10} and rows(builds).keys() == {"sales", "shops", "by_town"}


def test_quoted_files(spark, tmp_path):
    (tmp_path / "sales.csv").write_text('"ID";"DAY";"SHOP"\n"1";"3/2/2020";"a\nb"\n2;"4/2/2020";"c"\n' + '"3";"4/2/2020";"d"\n' * 2000 + '"short"\n')
    builds = Builds(spark, f"file://{tmp_path}/site")
    catalogue = Catalogue(SALES)
    builds.publish(catalogue, {"sales": lambda: quoted_source(spark, SALES, str(tmp_path / "sales.csv"))}, DAY)
    row = rows(builds)["sales"]
    assert (row["rows"], row["rejected"]) == (2002, 1) and {r["shop"] for r in builds.live().read("sales").collect()} == {"a\nb", "c", "d"}
    other = TableSpec("sales", {"ID": "int", "SHOP": "string", "DAY": "date"})
    with pytest.raises(SchemaDrift):
        builds.publish(Catalogue(other), {"sales": lambda: quoted_source(spark, other, str(tmp_path / "sales.csv"))}, DAY + dt.timedelta(1))


def test_a_source_is_read_once(spark, tmp_path):
    """Rows, rejects, lost values, stamp and fingerprint come with the pass that writes."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("array(cast(id as string), '3/2/2020', 'a') AS fields").mapInArrow(count, "fields array<string>")
    builds = Builds(spark, f"file://{tmp_path}/site")
    builds.publish(Catalogue(SALES), {"sales": lambda: Source(df, "1")}, DAY)
    assert seen.value == 500 and rows(builds)["sales"]["rows"] == 500
