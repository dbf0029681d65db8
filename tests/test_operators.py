import random

import pytest
from pyspark.sql import functions as F

from regspark.functions import text as tx
from regspark.functions import typing as ty
from regspark.operators import index, lists, merges, quality, refresh, rows
from regspark.operators.fingerprint import fingerprint
from regspark.plans import derive


def test_money_dates_and_flags(spark):
    df = spark.createDataFrame([("1.234,56*", "S", "SIM"), ("0,109", "0", "nao"), ("x", "?", None), ("30.000.000,00", "?", None)], "m string, f string, y string")
    got = df.select(ty.cents("m"), ty.marked(["m"]), ty.flag("f"), ty.yes_no("y")).collect()
    assert [tuple(r) for r in got] == [(123456, True, True, "S"), (10, False, False, "N"), (None, False, None, None), (None, False, None, None)]
    d = spark.createDataFrame([("122029",), ("2029",), ("1/2/2020",)], "d string").select(ty.when_any("d", ["d/M/yyyy", "MMyyyy"]).cast("date").cast("string"))
    assert [r[0] for r in d.collect()] == ["2029-12-01", None, "2020-02-01"]


def test_keep_one_and_top_k(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    assert sorted(tuple(r) for r in rows.keep_one(df, ["k"], [F.col("v").asc_nulls_last()]).collect()) == [(1, "a"), (2, "z")]
    assert rows.top_k(df, ["k"], [F.desc("v")], 1).count() == 2


def test_lists(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "a", 2), (1, "a", 1)], "k int, a string, n int")
    made = lists.aligned_lists(["a", "n"], ["a", "n"])
    r = df.groupBy("k").agg(made["a"].alias("a"), made["n"].alias("n"), lists.sorted_set("n", F.col("a") == "q").alias("none"), lists.first_by("a", ["n"]).alias("first")).head()
    assert (r["a"], r["n"], r["none"], r["first"]) == (["a", "a", "x"], [1, 2, None], [], "a")
    assert lists.commonest(df, ["k"], "a").head()["a"] == "a"
    parts = lists.from_right("i")
    got = spark.createDataFrame([("CASTRO - COOPERATIVA - CASTRO - BRASIL ; 22222222000122",), ("X - PERU ;",), ("Y",)], "i string").select(*(v.alias(k) for k, v in parts.items()))
    assert [tuple(r) for r in got.collect()] == [("CASTRO - COOPERATIVA", "CASTRO", "BRASIL", "22222222000122"), ("X", None, "PERU", None), ("Y", None, None, None)]


def test_merge_keeps_both_sides(spark):
    left = spark.createDataFrame([("a", None, 1), ("b", "l", 2)], "k string, s string, x int")
    right = spark.createDataFrame([("a", "r", 8), ("c", "q", 9)], "k string, s string, y int")
    got = sorted(tuple(r) for r in merges.merge_by_precedence(left, right, "k", ["s"], ["x"], ["y"]).collect())
    assert got == [("a", "r", 1, 8, "both"), ("b", "l", 2, None, "left"), ("c", "q", None, 9, "right")]
    assert tuple(merges.coverage(merges.merge_by_precedence(left, right, "k", ["s"])).head()) == (1, 1, 1)
    for a, b in ((left.union(left), right), (left, right.union(right))):
        with pytest.raises(Exception, match="k comes twice"):
            merges.merge_by_precedence(a, b, "k", ["s"], ["x"], ["y"]).collect()


def test_list_to_dictionary(spark):
    names = spark.createDataFrame([("Áb", 5), ("ab", 3), ("c d", 9), (" ", 1)], "name string, number int")
    df = spark.createDataFrame([(1, " AB ;x;; C-D "), (2, " ; "), (3, None), (4, "cd")], "k int, t string")
    got = {r["k"]: tuple(r)[1:] for r in merges.match_list(df, ["k"], F.split("t", ";"), names, tx.key).collect()}
    assert got == {1: (["AB", "x", "C-D"], [3, None, 9], ["ab", None, "c d"], False), 2: ([], [], [], False), 3: ([], [], [], False), 4: (["cd"], [9], ["c d"], True)}


def test_search_needs_a_filter(spark):
    df = spark.createDataFrame([("Éa",)], "t string")
    with pytest.raises(ValueError):
        merges.search(df, equals={"t": None})
    assert merges.search(df, contains={"t": "EA"}).count() == 1
    with pytest.raises(ValueError):
        rows.numbered_page(df, 0, 5, [F.asc("t")])


def test_label_summary(spark):
    df = spark.createDataFrame(
        [(1, "Contém - Trigo | Pode conter - Soja#Trigo |", "Glúten - Sim"), (1, "Não contém - Soja#Ovos", None), (2, None, None), (3, "solto", "GLUTEN - NAO")], "p int, a string, n string"
    )
    got = {r["p"]: r for r in derive.label_summary(df, "p", "a", "n").collect()}
    assert (got[1]["contains"], got[1]["may_contain"], got[1]["free_of"], got[1]["gluten"], got[1]["varies"]) == (["Trigo"], ["Soja"], ["Ovos"], "Sim", True)
    assert got[2]["contains"] is None and not got[2]["declared"] and got[3]["contains"] == ["solto"] and got[3]["gluten"] == "Não"


def test_people_stay_out_of_measures(spark):
    df = spark.createDataFrame([(1, "12345678901", "Ana"), (1, "12345678000199", "Firma"), (2, "0" * 14, " B "), (3, None, None)], "g int, t string, n string")
    got = {r["g"]: (r["company_id"], r["person"], r["company"]) for r in derive.measures(df, ["g"], "t", "n").collect()}
    assert got == {1: ("12345678000199", True, None), 2: (None, False, "B"), 3: (None, False, None)}


def test_guards(spark):
    p = quality.over_limit(spark.createDataFrame([("a", 10, 3), ("b", 0, 0)], "name string, present long, lost long"))
    with pytest.raises(quality.QualityError, match="'a'"):
        quality.guard(p)
    quality.guard(p.filter("name = 'b'"))
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    assert fingerprint(a).collect() == fingerprint(a.orderBy(F.desc("i"))).collect() != fingerprint(a.limit(1)).collect()


def test_refresh_keeps_going_after_a_failure():
    done = []
    out = refresh.build_each({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: 2}, lambda n, df: done.append(n))
    assert done == ["a", "c"] and out["a"] == "" and out["b"].startswith("missing: ZeroDivisionError")
    assert refresh.build_each({"b": lambda: 1 / 0}, lambda n, df: None, lambda n: True)["b"].startswith("kept: ")


def test_refresh_decisions_and_texts(spark):
    prints = lambda rows: spark.createDataFrame(rows, "name string, print int")
    derived = spark.createDataFrame([("d", "a"), ("e", "b"), ("f", "gone")], "name string, source string")
    decide = lambda now, before, **k: dict(tuple(r) for r in refresh.decide(prints(now), prints(before), derived, **k).collect())
    assert decide([("a", 1), ("b", 2)], [("a", 1), ("b", 3)]) == {"a": "carry", "b": "build", "d": "build", "e": "build", "f": "skip"}
    assert decide([("a", 1), ("b", 2)], [("a", 1), ("b", 2)]) == {"a": "carry", "b": "carry", "d": "carry", "e": "carry", "f": "skip"}
    assert decide([("a", 1)], [("a", 1)], same_code=False)["d"] == "build"
    assert refresh.failures(spark, {"a": "", "b": "kept: x"}).collect()[0]["name"] == "b"
    old = spark.createDataFrame([("t", [("x", "int", "old"), ("y", "int", "own")])], "name string, columns array<struct<name:string,type:string,description:string>>")
    new = refresh.refresh_texts(old, spark.createDataFrame([("t", "x", "new"), ("u", "y", "z")], "name string, column string, description string")).head()
    assert [tuple(c) for c in new["columns"]] == [("x", "int", "new"), ("y", "int", "own")]


def test_http_dates(spark):
    day, moment = ty.http_date("s")
    got = spark.createDataFrame([("Fri, 09 Oct 2026 01:30:00 GMT",), ("tomorrow",), (None,)], "s string").select(day, moment).collect()
    assert [tuple(r) for r in got] == [("20261008", "08/10/2026 22:30:00"), (None, None), (None, None)]


def test_packing_and_lookup(spark):
    rng = random.Random(3)
    for sizes, target in (([2, 2, 9, 1, 1], 4), ([rng.choice((1, 1, 2, 3, 11)) for _ in range(90)], 7), ([20, 20], 3), ([], 3)):
        rows, want, room, bucket = [(f"w{k:03}", n) for k, n in enumerate(sizes)], [], 0, -1
        for n in sizes:
            if bucket < 0 or n > room:
                bucket, room = bucket + 1, max(0, target - n)
            else:
                room -= n
            want.append(bucket)
        got = index.packed(spark.createDataFrame(rows, "w string, n long"), "w", target).orderBy("w").collect()
        assert [r["bucket"] for r in got] == want


def test_index_files_and_lookup(spark, tmp_path):
    rows = [(1, "Loção Facial", "00000000000001", "A", "555123"), (2, "Loja", "00000000000002", "B", "777"), (3, None, None, None, "x1"), (4, "Fácil loc", "00000000000001", "A", None)]
    df = spark.createDataFrame(rows, "id long, name string, company string, company_name string, number string")
    folder = str(tmp_path / "index")
    index.write_index(df, folder, "name", "company", "company_name", ["number"], ["id"], target=2)
    find = lambda q: sorted(r["id"] for r in index.look_up(spark, folder, q, "id", "company").collect())
    assert find("loc fac") == [1, 4] and find("lo") == [1, 2, 4] and find("de") == [] and find("locx") == []
    assert find("00000000000001") == [1, 4] and find("777") == [2] and find("123") == [] and find("555123") == [1]
    with pytest.raises(ValueError, match="nothing"):
        index.write_index(df, folder, "name", "company", "company_name", ["nothing"], ["id"])


def test_maker_keys(spark, sf_dir):
    """Spellings by their rows, products once, own by the least of a holder's keys; copies of makers and products count as in a join."""
    from regspark.plans import derive, registry

    makers = spark.createDataFrame([(1, "Acme", "X"), (2, "ACME", "X"), (3, "ácme", "Y"), (4, "Hold", "Y"), (5, None, "Y"), (6, "No", None), (7, "Two", "Y"), (7, "two", "Y")], "maker_id long, maker string, country string")
    products = spark.createDataFrame([(10, "h", "HOLD"), (11, "h", "HOLD"), (12, "i", "other"), (12, "i", "Acme")], "product long, holder string, holder_name string")
    rows = spark.createDataFrame([(10, 1, True), (10, 2, False), (11, 2, False), (10, 3, None), (11, 4, True), (10, 5, True), (10, 6, True), (12, 3, True), (99, 1, True), (10, 7, False), (12, None, True), (None, 1, True)], "product long, maker_id long, active boolean")
    got = sorted(tuple(r) for r in derive.maker_keys(rows, products, makers, "Y").collect())
    assert got == [("h", "acme", "X", "ACME", 2, 1, "abroad"), ("h", "acme", "Y", "ácme", 1, 0, "other"), ("h", "hold", "Y", "Hold", 1, 1, "own"), ("h", "two", "Y", "Two", 1, 0, "other"), ("i", "acme", "Y", "ácme", 1, 1, "own")]
    read = registry.queries()["maker_key_links"](spark, sf_dir).inputFiles()
    assert not any("lineitem" in f for f in read)  # joined once; both counts are made from that
