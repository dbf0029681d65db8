import random
import re

import pyarrow.parquet as pq
import pytest

from regspark.llm.components import connected_components
from regspark.llm.similarity_join import near_duplicates, one_of_each, op9_ngram_jaccard_join
from regspark.llm.similarity_join import shingles as tokens_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k, percent):
    sets, parent = [shingles(t, k) for _, t in docs], list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for t in s:
            where.setdefault(t, []).append(i)
    for i, a in enumerate(sets):
        for j in {j for t in a for j in where[t] if j < i}:
            b = sets[j]
            both = len(a & b)
            if docs[i][0] is not None and docs[j][0] is not None and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    same = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            parent[root(i)] = root(same.setdefault(doc_id, i))
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), None if d is None else least[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def test_shingles_of_few_words():
    """As many tokens as different shingles, and common tokens for common shingles, however few words there are."""
    texts = ["", " ", "a", "A b", "b", "a b c d", "a b c d e", "x a b c d e", "a a a a a a", "é \t b c d e"]
    for k in (1, 3, 5):
        for some in (texts, *([t] for t in texts), texts[:4], []):
            got = [set(own.tolist()) for own in tokens_of(some, k)]
            want = [shingles(t, k) for t in some]
            assert list(map(len, got)) == list(map(len, want))
            for a, x in zip(got, want, strict=True):
                for b, y in zip(got, want, strict=True):
                    assert len(a & b) == len(x & y)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    assert rows(op9_ngram_jaccard_join(spark, sf_dir)) == brute(docs, 3, 90)


@pytest.mark.parametrize(("hot", "group_tokens", "percent", "most_broadcast"), [(1, 150, 90, 1000), (3, 300, 80, 0), (48, 16384, 80, 1000)])
def test_families_passages_and_odd_rows(spark, hot, group_tokens, percent, most_broadcast):
    rng = random.Random(hot)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: rng.choices(vocabulary, k=n)
    passage, docs = text(40), []
    for _ in range(25):  # unrelated texts with one passage
        docs.append([*text(rng.randrange(5, 60)), *passage, *text(rng.randrange(5, 60))])
    for _ in range(8):  # families with edits, around the threshold
        base = text(rng.randrange(20, 90))
        for _ in range(6):
            own = base.copy()
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs.append(own)
    chain = text(80)  # each links with the next, the ends do not
    for k in range(8):
        chain = chain.copy()
        chain[k * 9] = f"x{k}"
        docs.append(chain)
    docs += [passage, passage[:-1], passage[1:], text(2), ["a"], ["A"]]
    order = list(range(len(docs)))
    rng.shuffle(order)
    table = [(order[k], " ".join(d)) for k, d in enumerate(docs)]
    table += [(None, "a"), (None, None), (500, None), (501, ""), (502, " \n "), (1, table[0][1]), (900, "l " * 3000), (901, "l " * 3000), table[3], table[3]]
    df = spark.createDataFrame([(*x, 1, "c") for x in table], "doc_id long, text string, n int, class string")
    k = 3 if percent == 90 else 2
    assert rows(near_duplicates(df, k, percent, hot, group_tokens, most_broadcast)) == brute(table, k, percent)


def test_empty_table_and_choice(spark):
    df = spark.createDataFrame([(3, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (None, "a b c d e f g", "z"), (4, "q", "w")], "doc_id long, text string, source string")
    assert near_duplicates(df.limit(0)).collect() == []
    assert sorted(r["source"] for r in one_of_each(df).collect()) == ["w", "y", "z"]


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 120)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000 + rng.randrange(60), 5000 + rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_two_texts_of_one_doc_id_with_copies_of_smaller_ids(spark):
    one, two = "a b c d e f g h", "p q r s t u v w"
    docs = [(1, one), (5, one), (2, two), (5, two), (7, "x y z x y"), (None, one)]
    got = rows(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=90))
    assert got == brute(docs, 3, 90)
    assert {r[2] for r in got if r[0] in (1, 2, 5)} == {1}
