"""Every registered query against its SQL, on the smallest tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest

from regspark.operators.determinism import OTHER_WAYS, dealt
from regspark.plans import registry


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, tables, name):
    def rows():
        df = registry.queries()[name](spark, sf_dir)
        return df, sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())

    df, got = rows()
    if name in registry.oracle_sql():
        cur = tables.execute(registry.oracle_sql()[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)]) for r in cur.fetchall())
        assert got == want
    with dealt(spark, OTHER_WAYS[0]):  # the same rows, however the work is dealt out
        assert rows()[1] == got
    assert got or name in ("exact_copies", "search_page")  # too few rows for a second page here


def test_plans_have_no_cross_product(spark, sf_dir):
    for name in ("company_rollup", "maker_links", "label_summary", "top_orders_per_customer"):
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "Python" not in plan


def test_top_k_is_pruned_before_the_shuffle(spark, sf_dir):
    plan = registry.queries()["top_orders_per_customer"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
