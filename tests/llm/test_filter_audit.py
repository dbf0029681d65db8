"""Operator 11 against its definition, document by document and order by order."""

import re
from itertools import permutations

import pyarrow.parquet as pq

from regspark.llm.filter_audit import audit, masks, op11_filter_audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)"""
    parts = {}
    for doc_id, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, x, _ in docs),
        }
        own = [] if doc_id is None else [x for x in labels if x[0] == doc_id]
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part, held in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in map("".join, permutations("ABCDE")):
            left = held
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(removed)
                failing = sum(f in x[0] for x in held)
                rows.append((f, (part, order, step, len(left), len(removed), failing - len(removed), sum(x[0] == {f} for x in held), sum(x[1] for x in removed), sum(x[2] for x in removed))))
        out += [(*r, shapley[f]) for f, r in rows]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_odd_rows(spark):
    long = " ".join(f"word{k}" for k in range(250))
    docs = [
        (1, None, None), (2, "", "en"), (3, "a b", "en"), (3, "a b", "en"), (3, "a b", None), (4, "a b", "de"), (5, "a b", ""), (None, "a b", "en"), (None, "x", "en"), (None, "x", "en"), (6, "x", "en"),
        (7, long, "en"), (8, long, "en"), (9, long + " #", "en"), (10, "Aa " * 90_000, "en"), (11, long.upper(), "de"), (12, "\t\n same " * 300, "de"), (13, "É" * 10 + " |", "de"), (0, "x", "fr"), (5, long, "en"),
    ]
    labels = [(7, 1, 0), (8, 0, 1), (8, 1, None), (3, 1, 1), (None, 1, 1), (99, 1, 1), (12, None, None), (10, 1, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, lang string, part string, n int")
    told = spark.createDataFrame([(*r, 2) for r in labels], "doc_id long, quality int, toxic int, mask int")
    assert got(audit(masks(df, told), "ABCDE")) == brute(docs, labels)
    assert audit(masks(df.limit(0), told), "ABCDE").collect() == []


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()]
    assert got(op11_filter_audit(spark, sf_dir)) == brute(docs, labels)
