import datetime as dt
import random

import pytest

from regspark.sources import dialect, sinks
from regspark.sources.spec import Catalogue, Derived, SchemaDrift, TableSpec


def test_odd_records():
    read = lambda t: list(dialect.records(t, 3))
    # a quoted word and an empty line inside a value
    assert read('"the "long"\n\nway";"k";"9"\n"next";"k";"8"\n') == [['the "long"\n\nway', "k", "9"], ["next", "k", "8"]]
    # a record cut short before one in quotes, and before one without
    assert read('"half";"k"\n"whole";"m";"3"\n') == [["half", "k"], ["whole", "m", "3"]]
    assert read('"half";"k"\n15;"m";"3"\n') == [["half", "k"], ["15", "m", "3"]]
    # a quote that ends the last value of a file
    assert read('"p";"q";"he said "no""') == [["p", "q", 'he said "no"']]


def test_round_trip_of_random_values():
    rng = random.Random(6)
    for _ in range(200):
        rows = [["".join(rng.choices('ab"\n é,', k=rng.randrange(0, 8))) for _ in range(3)] for _ in range(5)]
        if any('"\n' in v or v.endswith('"') for r in rows for v in r):
            continue
        assert list(dialect.records("".join(";".join(f'"{v}"' for v in r) + "\n" for r in rows), 3)) == rows


def test_reading_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿\"h1\";\"h2\"\n\"x\ny\";\"é\"\n".encode())
    (tmp_path / "b.cp").write_bytes(b"\x93a\x81;b\n")
    assert dialect.read_quoted(spark, str(tmp_path / "*.cp"), 2, encoding="cp1252").head()["fields"] == ["“a\x81", "b"]
    rows = dialect.read_quoted(spark, str(tmp_path / "*.csv"), 2).orderBy("record").collect()
    assert [(r["record"], r["fields"]) for r in rows] == [(1, ["h1", "h2"]), (2, ["x\ny", "é"])]


def test_header_drift_and_catalogue(spark):
    spec = TableSpec("t", {"ID": "int", "DAY": "date", "OK": "boolean"}, group="g")
    spec.check_header(["#ID", "DAY", "OK"])
    with pytest.raises(SchemaDrift, match="from column 2 on"):
        spec.check_header(["ID", "OK", "DAY"])
    raw = spark.createDataFrame([("1", "3/2/2020", "S"), ("1.5", "31/02/2020", "x")], spec.raw_schema())
    assert [tuple(r) for r in spec.select(raw).collect()] == [(1, dt.date(2020, 2, 3), True), (None, None, None)]
    both = Catalogue(spec, Derived("d", ("t",), lambda have: have["t"].select("ID")))
    assert [t.name for t in both.select("g")] == ["t"] and len(both.select()) == 2
    with pytest.raises(KeyError):
        both.select("nope")
    with pytest.raises(KeyError):
        both.derive("d", {})
    assert [tuple(r) for r in both.listing(spark).collect()] == [("t", "g", "source", []), ("d", "", "derived", ["t"])]
    assert both.derive("d", {}, partial=True) is None and both.derive("d", {"t": raw}).columns == ["ID"]


def test_sorted_parquet_has_small_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    sinks.write_sorted(spark.range(20_000).selectExpr("id", "cast(id % 7 as int) k").coalesce(1), str(tmp_path / "p"), ["k", "id"], 4096)
    for f in (tmp_path / "p").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        assert all(meta.row_group(g).num_rows <= 4096 for g in range(meta.num_row_groups))
    assert sinks.build_path("r", "t", dt.datetime(2026, 1, 2, 3, 4, 5)) == "r/data/20260102T030405Z/t"
