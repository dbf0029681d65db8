import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from regspark.llm import additive_ann as ann
from regspark.llm.common import bounded_sample
from regspark.llm.language import grams, language_id, op4_language_id, only_known
from regspark.llm.quality import Model, features, fit, op6_quality_ranking, quality_scores


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[700:720] = v[0]  # ties
    rows = [(k, [float(x) for x in r], "t") for k, r in enumerate(v)]
    rows += [(2000, None, "t"), (2100, [], "t"), (2200, [0.0] * 16, "t"), (2300, [float("nan")] + [1.0] * 15, "t"), (2400, [None] + [1.0] * 15, "t"), (2500, [1.0] * 3, "t"), (2600, [float("inf")] * 16, "t"), (None, [1.0] * 16, "t")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0, books=6, words=64, query_block=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    for q, found in got.items():
        found.sort()
        d = np.sqrt(((v.astype(np.float64) - v[q].astype(np.float64)) ** 2).sum(1))
        order = [k for k in np.lexsort((np.arange(len(v)), d)) if k != q][:10]
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(d[k] - s) < 1e-9 for _, k, s in found)
        assert [(s, k) for _, k, s in found] == sorted((s, k) for _, k, s in found)
        hits += len({k for _, k, _ in found} & set(order))
    assert hits >= 0.9 * 10 * len(got)
    assert [k for _, k, _ in sorted(got[0])][:5] == [701, 702, 703, 704, 705] or [k for _, k, _ in sorted(got[0])][:2] == [700, 701]


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")

    assert {r["vec_id"] for r in ann.nearest(df, F.col("vec_id") == 100).collect()} == {1, 2}
    assert ann.nearest(df.limit(0), F.col("vec_id") == 100).collect() == []


def test_repeated_rows_and_queries(spark):
    """A repeated query is one query; repeated candidates are candidates each."""
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (200, [0.0, 1.0]), (7, [1.0, 0.1]), (7, [1.0, 0.1]), (8, [0.2, 1.0])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, query_id int, score int, codes string")
    got = [tuple(r)[:3] for r in ann.nearest(df, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(100, 1, 7), (100, 2, 7), (100, 3, 8), (200, 1, 8), (200, 2, 7), (200, 3, 7)]


def test_recall_on_the_given_table(spark):
    """Production parameters against brute force."""
    sf_dir = "/root/testdata/sf0.1"
    own = {r["vec_id"]: r["embedding"] for r in pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()}
    good = {k: v for k, v in own.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids, x = np.array(sorted(good)), np.array([good[k] for k in sorted(good)], np.float64)
    got = {}
    for r in ann.op1_additive_ann(spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(got) == [k for k in ids.tolist() if k % 100 == 0]
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - np.array(good[q], np.float64)) ** 2).sum(1))
        hits += len(found & set([k for k in ids[np.lexsort((ids, d))].tolist() if k != q][:10]))
    assert hits >= 0.97 * 10 * len(got)


def test_rows_outside_the_sample(spark):
    """Books that are fitted to a tenth of the rows: the others are found as well, by few candidates."""
    vectors = ann.materialise(ann.valid_vectors(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")), "vectors")
    queries = vectors.filter("vec_id % 40 = 3")
    pairs = ann.candidate_pairs(vectors, queries, 10, 48, 256, 4, 200, 1024)
    held = {r["vec_id"]: np.array(r["v"]) for r in vectors.collect()}
    ids, x = np.array(list(held)), np.stack(list(held.values()))
    found = {}
    for r in pairs.collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, own in found.items():
        d = ((x - held[q]) ** 2).sum(1)
        hits += len(own & set([k for k in ids[np.lexsort((ids, d))].tolist() if k != q][:10]))
    assert len(found) == 50 and hits >= 0.97 * 500
    assert sum(map(len, found.values())) < 0.15 * 2000 * len(found)


def test_books_do_not_learn_the_sample_by_heart():
    x = np.random.default_rng(3).normal(size=(2000, 32)).astype(np.float32)
    books, _ = ann.fit(x[:150], 12, 256, 4)
    left = [((x - sum(b[ann.encode(x, books, 4)[0][:, k]] for k, b in enumerate(books))) ** 2).sum(1)]
    assert left[0][150:].mean() < 3 * left[0][:150].mean() and left[0][150:].mean() < 0.15 * 32


def test_bounded_samples(spark):
    df = spark.range(5000).selectExpr("id", "'x' as c")
    for claimed in (5000, 50_000, 10**7, 10**12):  # as if the table were larger: a tiny share of the hashes
        n = bounded_sample(df, claimed, 40, "id").count()
        assert n == 40 if claimed <= 5000 else 0 < n <= 40
    assert bounded_sample(df, 10**30, 40, "id").count() == 40 and bounded_sample(df, 5000, 40, "c").count() == 40
    assert bounded_sample(df.limit(0), 0, 40, "id").count() == 0


def test_beam_is_never_worse_than_one_path():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    books, _ = ann.fit(x, 3, 16, 4)
    error = lambda beam: ((x - sum(b[ann.encode(x, books, beam)[0][:, k]] for k, b in enumerate(books))) ** 2).sum()
    assert error(8) <= error(1)


def test_language_held_out_and_odd_rows(spark, sf_dir):
    langs = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    rows = op4_language_id(spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)
    a, b, c = [k for k in range(10, 60) if zlib.crc32(str(k).encode()) % 3 != 1][:3]
    texts = [(a, "the cat and the dog", "en"), (b, "der Hund und die Katze", "de"), (3, None, "en"), (4, "12 34", None), (None, "und die", None), (c, "the " * 9000, "en"), (c, "the", None)]
    df = spark.createDataFrame([(*t, 0.5, "s") for t in texts], "doc_id long, text string, lang string, score double, lang_pred string")
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id(df).collect()}
    assert {(3, "und"), (4, "und"), (a, "en"), (b, "de"), (c, "en"), (None, "de")} <= got
    assert only_known(df).columns == df.columns and only_known(df).count() == 5
    clash = df.withColumns({"_language": F.lit(1), "_nearness": F.lit(2)})
    assert only_known(clash).columns == clash.columns and only_known(clash).count() == 5
    assert language_id(df.limit(0)).collect() == []
    assert {r["lang_pred"] for r in language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_brute_force(spark, sf_dir):
    """Profiles and distances by plain counting of strings."""
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()

    def count(text):
        out = Counter()
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            padded = f" {word} "
            out.update(padded[k : k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1) if padded[k : k + n] != " ")
        return out

    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    leaders = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:300]]
    totals = {}
    for d in docs:
        if d["lang"] is not None and d["text"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 != 1:
            totals.setdefault(d["lang"], Counter()).update(count(d["text"]))
    ranks = {lang: {g: k for k, g in enumerate(leaders(c))} for lang, c in totals.items()}
    want = {}
    for d in docs:
        own = leaders(count(d["text"]))
        away = {lang: sum(abs(r[g] - k) if g in r else 300 for k, g in enumerate(own)) for lang, r in ranks.items()}
        lang = min(sorted(away), key=away.get) if own else "und"
        want[d["doc_id"]] = (lang, round(1 - min(away[lang] / (300 * len(own)), 1.0), 9) if own else 0.0)
    assert {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in op4_language_id(spark, sf_dir).collect()} == want


def test_grams_stay_inside_words():
    own = {"".join(chr(c) for c in (g >> 42 & 0x1FFFFF, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if c) for g in grams("Ab, c").tolist()}
    assert own == {"a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c "}


def test_quality_held_out(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    rows = op6_quality_ranking(spark, sf_dir).collect()
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["doc_id"] in labels]
    good, bad = ([r["score"] for r in held if labels[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good]) > 0.95


def test_quality_brute_force(spark, sf_dir):
    """The same model from plain lists."""
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    labels = {}
    for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist():
        if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            labels.setdefault(r["doc_id"], []).append(r["quality"])
    known = sorted((d["doc_id"], features(d["text"] or "")) for d in docs if d["doc_id"] in labels)
    model = Model(np.array([x for _, x in known], np.float64), np.array([np.mean(labels[k]) for k, _ in known]), 200_000)
    want = {d["doc_id"]: float(model.score(np.array([features(d["text"] or "")], np.float64))[0]) for d in docs}
    got = {r["doc_id"]: r["score"] for r in op6_quality_ranking(spark, sf_dir).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_quality_of_odd_label_tables(spark):
    docs = spark.createDataFrame([(k, "a b c " * (k % 7 + 1)) for k in range(1, 40)] + [(1, "two"), (None, "x")], "doc_id long, text string")
    for rows in ([], [(k, 1) for k in range(1, 40)], [(k, None) for k in range(1, 40)], [(None, 1), (None, 0)]):
        model = fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {r["score"] for r in quality_scores(docs, model).collect()} == {0.5}
    both = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] * 2, "doc_id long, quality int")
    assert fit(docs, both, most_labelled=6).fitted


def test_quality_without_labels_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None, 3.0), (2, "", 3.0), (None, "a b", 3.0), (2, "x" * 100_000, 3.0)], "doc_id long, text string, score double")
    got = quality_scores(df, Model(np.empty((0, 18)), np.empty(0), 10)).collect()
    assert [r["score"] for r in got] == [0.5] * 4
    assert quality_scores(df.limit(0), Model(np.empty((0, 18)), np.empty(0), 10)).collect() == []
    assert len(features("")) == 18
