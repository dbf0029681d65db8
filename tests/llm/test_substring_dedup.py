import os
import random
import re

import numpy as np

from regspark.llm import substring_dedup
from regspark.llm.substring_dedup import cuts, repeated_passages, without_repeats, word_chunks


def test_chunks_run_from_cut_to_cut():
    """Cuts are the least hashes of any neighbours; chunks tile the text between them and are short."""
    rng = np.random.default_rng(1)
    for k, reach in ((1, 3), (2, 7), (4, 5)):
        gear = rng.integers(0, 2**63, 400).astype(np.uint64)
        gear[100:200] = gear[100]  # one word again and again
        h = [sum(int(gear[p + k - 1 - t]) << (64 // k * t) for t in range(k)) % 2**64 for p in range(400 - k + 1)]
        want = {max(range(p, p + reach), key=lambda q: (-h[q], q)) for p in range(len(h) - reach + 1)}
        at, which = cuts(gear, k, reach)
        assert at.tolist() == sorted(want) and np.diff(at).max() <= reach
        assert at[which].tolist() == [max(range(p, p + reach), key=lambda q: (-h[q], q)) for p in range(len(h) - reach + 1)]


def test_an_insertion_moves_no_other_cut():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    before = word_chunks(" ".join(words).encode(), 15)[3].tolist()
    after = word_chunks(" ".join([*words[:150], "one", "two", *words[150:]]).encode(), 15)[3].tolist()
    assert len(set(before) - set(after)) <= 6 and len(before) > 60
    assert len({len(w) for w in (before, after)}) <= 2


def text_of(rng, words):
    return lambda n: " ".join(rng.choices(words, k=n) + [str(rng.random())])


def test_copies_keep_the_first(spark):
    rng = random.Random(4)
    text = text_of(rng, [f"{a}{b}" for a in "kltr" for b in ("ab", "éno", "iru", "osta", "u", "ytter")])
    passage = text(60)
    docs = [(k, f"{text(rng.randrange(5, 80))} {passage} {text(rng.randrange(5, 80))}") for k in range(12)]
    docs += [(k, text(100)) for k in range(20, 40)] + [(50, docs[0][1]), (51, docs[0][1]), (51, docs[0][1]), (60, text(400) * 2), (None, docs[0][1]), (61, None), (62, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, key string")
    rows = repeated_passages(df).collect()
    own = dict(d for d in docs if d[0] is not None)
    for k in [*range(12), 50, 51]:
        at = own[k].index(passage)
        assert any(r["doc_id"] == k and r["start"] <= at and at + len(passage) <= r["end"] and r["first_doc_id"] == 0 for r in rows)
    kept = {r["doc_id"]: r["text"] for r in without_repeats(df).collect() if r["doc_id"] is not None}
    assert kept[0] == docs[0][1] and kept[50] == "" and kept[61] is None and kept[25] == docs[17][1]
    assert all(passage not in kept[k] and len(kept[k]) < len(own[k]) - len(passage) + 1 for k in range(1, 12))


def test_a_very_long_text(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(400_000)]
    docs = [(1, " ".join(words)), (2, "before " + " ".join(words[200_000:200_040]) + " after"), (3, "x" * 1_000_000)]
    rows = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["first_doc_id"]) for r in rows) == [(1, 40, 1), (2, 40, 1)]


def brute_passages(docs, least):
    """Every window of least words, as plain text; the spans that repeated ones cover."""
    where, own = {}, {}
    for doc_id, text in docs:
        places = [m.span() for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
        own[doc_id, text] = [(j, places[j][0], places[j + least - 1][1]) for j in range(len(places) - least + 1)]
        for _, a, b in own[doc_id, text]:
            where.setdefault(text[a:b], set()).add(doc_id)
    out = set()
    for (doc_id, text), windows in own.items():
        run = []
        for j, a, b in [*windows, (10**9, 0, 0)]:
            if run and j > run[-1][0] + least and (j == 10**9 or len(where[text[a:b]]) > 1):
                out.add((doc_id, run[0][1], run[-1][2], run[-1][0] - run[0][0] + least, min(min(where[text[x:y]]) for _, x, y in run)))
                run = []
            if j < 10**9 and len(where[text[a:b]]) > 1:
                run.append((j, a, b))
    return out


def test_every_shared_passage_is_found_whole(spark):
    rng = random.Random(9)
    many = ["".join(rng.choices("abcdefghéß", k=rng.randrange(1, 10))) for _ in range(5000)]
    text = lambda n, own=many: " ".join(rng.choices(own, k=n))
    docs, planted = [], []
    for k in range(300):
        words = (many, many[:3], ["a", "b"], ["line of", "the same"])[k % 4] if k % 2 else many
        passage = ("x " * 26 + text(25, words)) if k % 5 == 0 else text((51, 15, 60, 100)[k % 4], words)
        mark = f"q{k} " + passage + f" z{k}"
        docs += [(2 * k, f"{text(rng.randrange(0, 60))} l{k} {mark} r{k}"), (2 * k + 1, f"{text(30)}\n{mark} {text(rng.randrange(0, 60))}")]
        planted.append(mark)
    docs += [(2000, docs[7][1]), (2001, docs[9][1] + " \n"), (2001, text(40) + " " + planted[3]), (2002, text(14)), (2003, text(14)), (2004, planted[5].replace(" ", "  "))]
    rows = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start"], r["end"], r["n_words"], r["first_doc_id"]) for r in rows} == brute_passages(docs, 15)
    for k, mark in enumerate(planted):
        for doc_id in (2 * k, 2 * k + 1):
            at = dict(docs)[doc_id].index(mark)
            assert any(r["doc_id"] == doc_id and r["start"] <= at and at + len(mark) <= r["end"] for r in rows)


def test_passages_of_no_documents(spark):
    assert repeated_passages(spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, "x " * 40), (4, "x " * 40)], "doc_id long, text string")).collect() == []
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def stages(spark):
    sc, jvm = spark.sparkContext._jsc.sc(), spark._jvm
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return [found.apply(k) for k in range(found.size())]


def shuffled(spark, run):
    """Bytes that the stages of run() write for shuffles."""
    before = max((s.stageId() for s in stages(spark)), default=-1)
    run()
    return sum(s.shuffleWriteBytes() for s in stages(spark) if s.stageId() > before)


def test_shuffles_stay_under_five_times_the_input(spark):
    """With no table small enough for a broadcast, as it is at size."""
    path, name = "/root/testdata/sf0.01/documents.parquet", "spark.sql.autoBroadcastJoinThreshold"
    before, docs = spark.conf.get(name), spark.read.parquet(path)
    try:
        spark.conf.set(name, "-1")
        moved = shuffled(spark, lambda: repeated_passages(docs).write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set(name, before)
    assert 0 < moved < 5 * os.path.getsize(path)


def test_batches_change_nothing(spark):
    """Documents share passages within batches and between them; a doc_id has several texts."""
    rng = random.Random(12)
    many = ["".join(rng.choices("abcdé", k=rng.randrange(1, 8))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(many, k=n))
    common, some = text(40), [text(30) for _ in range(8)]
    docs = [(rng.randrange(-40, 60), f"{text(20)} {common} {text(9)} {some[k % 8]} {text(rng.randrange(30))}") for k in range(90)]
    docs += [docs[3], docs[3], (docs[4][0], docs[3][1]), (7_000_000_000, docs[5][1]), (-7_000_000_000, docs[6][1] + " end")]
    docs += [(docs[0][0], "short"), (docs[1][0], text(14)), (docs[2][0], text(60)), (docs[3][0], " \n")]
    want = brute_passages(set(docs), 15)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for parts, rows in ((1, 2000), (1, 4), (7, 1), (5, 3)):
            spark.conf.set(name, rows)
            rows = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)).collect()
            assert sorted((r["doc_id"], r["start"], r["end"], r["n_words"], r["first_doc_id"]) for r in rows) == sorted(want)
    finally:
        spark.conf.set(name, before)


def test_a_batch_asks_for_a_common_passage_twice(spark, monkeypatch):
    passage = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(k, f"own{k} {passage}") for k in range(300)], "doc_id long, text string").coalesce(1)
    asked, repeated = [], substring_dedup.repeated
    monkeypatch.setattr(substring_dedup, "repeated", lambda table: asked.append(table.groupBy("digest").count().agg({"count": "max"}).first()[0]) or repeated(table))
    assert repeated_passages(docs).count() == 300
    assert asked == [2, 2]
