"""Packing and look-ups against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from regspark.operators import index


def greedy(sizes, target):
    out, fill, bucket = [], None, -1
    for n in sizes:
        if fill is None or fill + n > target:
            fill, bucket = 0, bucket + 1
        fill += n
        out.append(bucket)
    return out


def in_ranges(sizes, cuts, target):
    parts = [np.array(sizes[a:b], np.int64) for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True)]
    maps = [(int(p.sum()), *index.fill_map(p, target)) for p in parts]
    return [b for p, (fill, begun) in zip(parts, index.fills(maps, target), strict=True) for b in index.bucket_numbers(p, target, fill, begun).tolist()]


def test_packing_by_ranges():
    rng = random.Random(1)
    for _ in range(2000):
        target = rng.choice([1, 2, 5, 10, 50])
        sizes = [rng.choice([1, 1, 2, 3, 7, 60]) for _ in range(rng.randint(1, 40))]
        cuts = sorted(rng.sample(range(1, len(sizes)), min(len(sizes) - 1, rng.randint(0, 6))))
        assert in_ranges(sizes, cuts, target) == greedy(sizes, target), (sizes, cuts, target)


def test_what_a_range_tells_is_short():
    rng = random.Random(2)
    most, _, _ = index.fill_map(np.array([rng.randint(1, 5) for _ in range(100_000)]), 3000)
    assert len(most) < 400


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index") / "own")
    names = ["Água de rosas", "agua-marinha azul", "Rosa azul", "o azul", "rosário", "Sabão", None, "azulejo de rosa"]
    rows = [(k, names[k % len(names)], f"{k % 5:014d}" if k % 7 else None, f"C{k % 5}", str(k)) for k in range(80)]
    df = spark.createDataFrame(rows, "id int, name string, company string, company_name string, number string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # parts this small would be put together
    index.write_index(df, folder, "name", "company", "company_name", ["number"], ["id"], target=12, part_rows=7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return folder, rows


def test_look_ups_in_bulk(spark, folder):
    folder, rows = folder
    import unicodedata

    plain = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))
    own = {k: set(plain(name or "").replace("-", " ").split()) - {"de", "o"} | ({"aguamarinha"} if name and "-" in name else set()) for k, name, *_ in rows}
    asked = {"azul": ["azul"], "ROS az": ["ros", "az"], "água": ["agua"], "aguamar": ["aguamar"], "nichts": ["nichts"], "azul nichts": ["azul", "nichts"], "de o": [], "azul azul ro": ["azul", "ro"], "  ": []}
    want = {(q, k) for q, ws in asked.items() for k in own if ws and all(any(w.startswith(x) for w in own[k]) for x in ws)}
    want |= {("1".zfill(14), r[0]) for r in rows if r[2] == "1".zfill(14)} | {("17", 17), (" 7", 7)}
    df = spark.createDataFrame([(q,) for q in [*asked, "1".zfill(14), "9".zfill(14), "17", " 7", "12345"]] + [(None,), ("azul",)], "text string")
    got = index.look_up_all(spark, folder, df.select(F.col("text").alias("query"), "text"), "id", "company").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want


def test_a_key_with_many_rows_is_several_files(spark, folder):
    folder, _ = folder
    files = spark.read.parquet(f"{folder}/words").filter("word = 'azul'").select("bucket", F.input_file_name().alias("f")).distinct().collect()
    assert len({r["bucket"] for r in files}) == 1 and len(files) > 1


def test_only_asked_buckets_are_read(spark, folder):
    folder, _ = folder
    found = index.look_up_all(spark, folder, spark.createDataFrame([(1, "sab")], "query int, text string"), "id", "company")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
