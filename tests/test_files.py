import pytest
from pyspark.sql import functions as F

from regspark.sources import prices, substances
from regspark.sources.spec import SchemaDrift

FIXED, PRICE = {"CÓDIGO": "code", "PRODUTO": "name"}, r"PF ([0-9,]+)%( ALC)?"


def test_headers_are_mapped_and_drift_is_an_error():
    got = prices.map_headers(["﻿Código", " produto ", "PF 17,5 %", "PF 17,5% ALC", "obs"], FIXED, PRICE, "pf", {"OBS"})
    assert list(got.values()) == ["code", "name", "pf_17_5", "pf_17_5_alc"]
    with pytest.raises(SchemaDrift):
        prices.map_headers(["new"], FIXED, PRICE, "pf")
    assert prices.price_columns("pf", ["12"]) == ["pf_sem_impostos", "pf_0", "pf_12", "pf_12_alc"]


def test_price_files_are_read_and_merged(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Código;Produto;PF 12%\n1;"A ""x""";1.234,50*\n2;B;\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Código;Produto;PF 12%\n2;ignored;7,00\n3;C;x\n", encoding="utf-8")
    a, b = (prices.priced(prices.read_wide(spark, str(tmp_path / f"{n}.csv"), FIXED, PRICE, n), [f"{n}_12"], f"{n}_marked") for n in "ab")
    got = sorted(tuple(r) for r in prices.merged(a, b, "code", ["name"], ["a_12", "a_marked"], ["b_12"]).collect())
    assert got == [("1", 'A "x"', 123450, True, None, "left"), ("2", "B", None, False, 700, "both"), ("3", "C", None, None, None, "right")]


def test_ragged_price_file(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Código;Produto;PF 12%\n1;A\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        prices.read_wide(spark, str(tmp_path / "r.csv"), FIXED, PRICE, "pf").collect()


def test_cell_grid(spark):
    grid = [("s", 0, [("Title", False)]), ("s", 1, [("No", False), ("Name", False), ("Note", False)]), ("s", 2, [("1.0", False), ("One  x", False), ("n1", False)]), ("s", 3, [(None, False), (None, False), ("n2", False)]), ("s", 4, [(None, False)] * 3), ("s", 5, [("2", False), ("Two", False), (None, False)])]
    df = spark.createDataFrame(grid, "sheet string, row_no int, cells array<struct<text:string,is_date:boolean>>")
    rows = substances.after_header(df, "sheet", 3)
    got = substances.named_entries(rows, "sheet", ["number", "name"], 2).select(substances.whole_number(F.col("number")), "name", "notes").collect()
    assert sorted(tuple(r) for r in got) == [(1, "One x", "n1 | n2"), (2, "Two", "")]
    with pytest.raises(SchemaDrift):
        substances.after_header(df, "sheet", 2)
    cells = [("7758-11-04", True), ("1972-08-03", True), ("50–00–0", False), ("[Ref. 7]", False), (" Ref.  11", False), ("see Ref. 2", False), (None, False)]
    one = spark.createDataFrame(cells, "c string, d boolean")
    number, reference = substances.registry_number(F.col("c"), F.col("d"))
    assert [tuple(r) for r in one.select(number, reference).collect()] == [("7758-11-4", None), ("1972-08-3", None), ("50-00-0", None), (None, 7), (None, 11), ("see Ref. 2", None), (None, None)]


def test_headers_of_a_layout():
    layout = prices.WideLayout({"CÓDIGO": "code"}, ("PF", "PMC"), ("0", "12", "17,5"), yearly={"COMERCIALIZAÇÃO": "sold"}, ignored=("OBS",))
    assert layout.price_columns("PF") == ["pf_sem_impostos", "pf_0", "pf_12", "pf_12_alc", "pf_17_5", "pf_17_5_alc"]
    got, years = layout.columns(["﻿Código", "PF Sem  Impostos", "pf 0%", "PMC 17,5 %  ALC", "Comercialização 2024", "Observação"])
    assert list(got.values()) == ["code", "pf_sem_impostos", "pf_0", "pmc_17_5_alc", "sold"] and years == {"sold": "2024"}
    for bad in (["PF 23 %"], ["PF 0 % ALC"], ["PF 12"], ["PF"], ["PMX 12 %"], ["Comercialização"], ["Comercialização 24"], ["Código", "código "], ["PF 12 %", "PF  12%"]):
        with pytest.raises(SchemaDrift):
            layout.columns(bad)
