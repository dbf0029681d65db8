"""Operator 12 against its definition, pair by pair."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from regspark.llm.spelling import WIDTH, Spelled, Trie, near, op12_spelling_variants, spelling_variants, vocabulary

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def count(docs):
    """docs: (doc_id, text)"""
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 2}


def differ_by_one(a, b):
    """By all ways to make a from b."""
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b))) or any(a[:k] + a[k + 1 :] == b for k in range(len(a))) or (len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1)


def variants(n, times=10):
    by = defaultdict(set)  # what words are without one letter
    for w in n:
        by[w].add(w)
        for k in range(len(w)):
            by[w[:k] + w[k + 1 :]].add(w)
    close = {w: set() for w in n}
    for group in by.values():
        for a in group:
            close[a] |= {b for b in group if b not in close[a] and differ_by_one(a, b)}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_near():
    rng = random.Random(3)
    words = ["".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(60)]
    for a in words:
        for b in words:
            assert near(a, b) == (a != b and differ_by_one(a, b)), (a, b)
    long = "x" * (WIDTH - 2)
    words += [long, long + "x", long + "xa", long + "xb", long + "xxa", long + "xxb", long + "xxab", long + "yxab"]
    i, j = (x.ravel() for x in np.mgrid[: len(words), : len(words)])
    assert Spelled(words, "ab", 3).near(i, j).tolist() == [near(words[a], words[b]) for a, b in zip(i, j, strict=True)]


def test_trie_search_finds_exactly_what_the_budget_allows():
    rng = np.random.default_rng(5)
    own = np.unique(rng.integers(0, 3, (150, 4)).astype(np.uint8), axis=0)
    own = np.concatenate([own, np.array([[255, 0, 0, 0], [254, 0, 0, 0], [255, 0, 1, 0]], np.uint8)])
    own = np.unique(own, axis=0)
    query, path, spent = Trie([r.tobytes() for r in own]).search(own)
    gap = own[:, None].astype(int) - own[None]  # of query and path
    within = (np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)
    found = list(zip(query.tolist(), path.tolist(), strict=True))
    assert len(found) == len(set(found)) == int(np.triu(within).sum())  # one of each two finds the other
    assert {tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in np.argwhere(within).tolist()}
    assert spent.tolist() == np.abs(gap).sum(2)[query, path].tolist()
    assert Trie([b""]).search(own)[1].tolist() == [0] * len(own)
    assert Spelled(["abba", "", "xé"], "ab", 3).vectors.tolist() == [[2, 2, 0], [0, 0, 0], [0, 0, 2]]


def test_words_of_odd_texts(spark):
    texts = [None, "", "short", "Straße STRASSEN Àrbitro àrbitro ×÷abcdefg KKelvinwords", "naïveté-hyphen_underscore9nineteen " * 50, "x" * 5000 + " " + "y" * 3000, "Elsewhere ELSEWHERE elsewhere ÉLSEWHERE"]
    docs = [(k, t) for k, t in enumerate(texts * 3)] + [(None, "nameless nameless " + texts[3]), (7, texts[4]), (7, texts[4])]
    df = spark.createDataFrame([(*r, "w", 5) for r in docs], "doc_id long, text string, word string, n int")
    assert {r["word"]: r["n"] for r in vocabulary(df).collect()} == count(docs)
    assert got(spelling_variants(vocabulary(df))) == variants(count(docs))
    assert spelling_variants(vocabulary(df.limit(0))).collect() == []


@pytest.mark.parametrize("limits", [{}, {"cell": 3}, {"cell": 1, "groups": 3}, {"cell": 2, "groups": 1}, {"cell": 40, "groups": 4, "most_split": 5}])
def test_families_anagrams_and_chains(spark, limits):
    """Also leaves of words with the same counts throughout, which are dealt by halves."""
    rng = random.Random(11)
    n = {}
    for base in ("".join(rng.choices("aeinrst", k=rng.randint(7, 10))) for _ in range(60)):
        n[base] = rng.choice([3, 50, 2000])
        for _ in range(6):
            k = rng.randrange(len(base) + 1)
            n.setdefault(rng.choice([base[:k] + rng.choice("aeéz") + base[k:], base[:k] + base[k + 1 :], base[:k] + "q" + base[k + 1 :]]), rng.choice([2, 3, 40]))
    for _ in range(80):
        n["".join(rng.sample("abcdefg", 7))] = rng.choice([2, 30])
    n |= {"chained" + "o" * k: 2 * 10**k for k in range(5)}  # each the next one's variant
    n |= {"tiedword": 100, "tiedwort": 2, "tiedwore": 100, "aaaaaaa": 5, "aaaaaaaa": 50, "l" * 300: 2, "l" * 301: 20}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(spelling_variants(df, **limits)) == variants(n)


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    want = variants(count(docs))
    assert got(op12_spelling_variants(spark, sf_dir)) == want
    assert any(r[1] for r in want)
