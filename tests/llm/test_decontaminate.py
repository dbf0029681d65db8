import hashlib
import random
import re
from collections import Counter

import pyarrow.parquet as pq

from regspark.llm.decontaminate import contamination, op10_decontamination, proximity_matches, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def near(docs, items, window, slop):
    """Per document: how many items have a window whose two rarest words are about as far apart in it."""
    counts, pairs = Counter(w for _, t in docs for w in words(t)), set()
    for item_id, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            a, b = (sorted(range(s, s + n), key=lambda j: (counts[w[j]], j)) * 2)[:2] if n > 1 else (s, s)
            if counts[w[a]]:
                pairs.add((item_id, w[a], w[b], b - a))
    out = []
    for _, text in docs:
        at = {}
        for k, w in enumerate(words(text)):
            at.setdefault(w, []).append(k)
        out.append(len({i for i, a, b, d in pairs if any(abs(y - x - d) <= slop and (x != y or d == 0) for x in at.get(a, ()) for y in at.get(b, ()))}))
    return out


def brute(docs, items, window=13, slop=3):
    wanted, close = {}, near(docs, items, window, slop)
    for item_id, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(n, {}).setdefault(tuple(w[k : k + n]), set()).add(str(item_id))
    out = []
    for (doc_id, text), n_near in zip(docs, close, strict=True):
        w, hit, found = words(text), set(), set()
        for n, windows in wanted.items():
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= own
        named = sorted(f for f in found if f != "None")
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), n_near))
    return out


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    want = brute(docs, items)
    assert any(w[5] for w in want)
    assert rows(op10_decontamination(spark, sf_dir)) == sorted(want, key=repr)


def test_random_texts_and_odd_rows(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choices("abcé", k=n))
    docs = [(k % 50, text(rng.randrange(0, 60))) for k in range(120)] + [(None, "A b c"), (None, None), (7, None), (8, ""), (8, ""), (9, "a-b c " * 2000)]
    items = [(k, text(rng.randrange(0, 9))) for k in range(25)] + [(77, None), (78, "zzz"), (79, "A, B! c"), (None, "a b a c a"), (3, "c c b")]
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, term int, block int")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n int")
    for most_words in (500_000, 20):
        got = rows(contamination(d, b, window=5, most_words=most_words).drop("text_hash"))
        assert got == sorted(brute(docs, items, 5), key=repr)
    bad = [x for x, r in zip(docs, brute(docs, items, 5), strict=True) if not r[5]]
    assert rows(without_contaminated(d, b, 5).select("doc_id", "text")) == sorted(bad, key=repr)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(d.limit(0), b).collect() == []
    assert [r["contaminated"] for r in contamination(d, b.limit(0)).collect()] == [False]


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x alpha y z beta"), (2, "alpha beta"), (3, "alpha " + "x " * 30 + "beta")], "doc_id long, text string")
    items = spark.createDataFrame([("a5", "alpha beta"), ("b", "x x")], "item_id string, text string")
    for most_words in (500_000, 1):
        got = {(r["doc_id"], r["item_id"], r["distance"]) for r in proximity_matches(d, items, 4, most_words=most_words).collect()}
        assert got == {(1, "a5", 2), (2, "a5", 0), (3, "b", 0)}
