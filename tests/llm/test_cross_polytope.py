"""Operator 13 against all pairs."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from regspark.llm.cross_polytope import Hashes, chance, hadamard, meet, near_embeddings, op13_embedding_near_dedup, tables_for

COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def brute(rows, cosine=0.93):
    """rows: (vec_id, embedding, label)"""
    ids = [r[0] for r in rows]
    assert len(set(ids)) == len(ids)
    links = {i: set() for i in ids}
    groups = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            groups.setdefault((label, len(v)), []).append((i, x / np.abs(x).max()))
    for held in groups.values():
        x = np.stack([v for _, v in held])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(x @ x.T >= cosine):
            if a != b:
                links[held[a][0]].add(held[b][0])
    out, seen = [], {}
    for i in sorted(ids):
        if i not in seen:
            todo, seen[i] = [i], i
            while todo:
                for b in links[todo.pop()]:
                    if b not in seen:
                        seen[b] = i
                        todo.append(b)
        out.append((i, len(links[i]), seen[i], seen[i] == i))
    return out


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_hadamard_and_buckets():
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(2).normal(size=(5, 8))
    assert np.allclose(hadamard(x), x @ h)
    for width in (1, 2, 3):
        hashes = Hashes(6, 2, width, 5)
        u = x[:, :6] / np.linalg.norm(x[:, :6], axis=1, keepdims=True)
        b = hashes.buckets(u)
        assert b.shape == (5, 2, 5) and (b == np.stack([hashes.buckets(u[k : k + 1])[0] for k in range(5)])).all()
        for t in range(2):  # the own bucket is the nearest signed axis of each turn
            own = np.zeros(5, np.int64)
            for rounds in hashes.signs[t]:
                y = np.pad(u, ((0, 0), (0, 2)))
                for s in rounds:
                    y = (y * s) @ h / math.sqrt(8)
                axis = np.abs(y).argmax(1)
                own = own * 16 + axis * 2 + (y[np.arange(5), axis] < 0)
            assert (b[:, t, 0] == own).all() and all(len(set(r)) == 5 for r in b[:, t].tolist())


@pytest.mark.parametrize("width", [1, 2])
def test_pairs_at_the_threshold_are_missed_as_seldom_as_promised(width):
    tables = tables_for(64, width, 4 * width, 0.93, 0.001)
    rng = np.random.default_rng(99)
    a, c = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    c -= (c * a).sum(1, keepdims=True) * a
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * c / np.linalg.norm(c, axis=1, keepdims=True)
    buckets = Hashes(64, tables, width, 4 * width).buckets(np.concatenate([a, b]))
    one, two = np.arange(3000), np.arange(3000, 6000)
    met = np.any([meet(buckets, one, two, t) | meet(buckets, two, one, t) for t in range(tables)], 0)
    assert met.mean() >= 0.995 and tables < 60


@pytest.mark.parametrize("limits", [{}, {"bucket": 2, "block": 7}, {"block": 16, "most_broadcast": 0}])
def test_groups_copies_and_odd_rows(spark, limits):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for centre in rng.normal(size=(12, 24)):
        for _ in range(int(rng.integers(1, 25))):  # some links at either side of the threshold
            rows.append((k, (centre + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.27])).tolist(), k % 2))
            k += 1
    rows += [(k + n, r.tolist(), 0) for n, r in enumerate(rng.normal(size=(150, 24)))]
    own = rows[3][1]
    odd = [None, [], [0.0] * 24, [None, *own[1:]], [float("nan"), *own[1:]], [float("inf"), *own[1:]], own[:23], [x * 1e200 for x in own], [x * 1e-200 for x in own], own, own]
    rows += [(1000 + n, v, 1) for n, v in enumerate(odd)] + [(2000, own, None), (2001, own, None), (-5, own, 1), (3000, [2.0], 7), (3001, [0.5], 7), (3002, [-1.0], 7)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, bucket int")
    want = brute(rows)
    assert got(near_embeddings(df.repartition(3), **limits)) == want
    again = df.union(df.filter("vec_id in (3, 1009)"))
    assert got(near_embeddings(again, **limits)) == want
    nameless = spark.createDataFrame([(None, own, 1, "x", 1)] * 2, df.schema)
    found = near_embeddings(df.union(nameless), **limits).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found if r["vec_id"] is None] == [(None, 0, None, False)] and len(found) == len(want) + 1
    assert near_embeddings(df.limit(0)).collect() == []


def test_chance_falls_with_the_angle():
    assert chance(64, 1, 4, 0.99) > chance(64, 1, 4, 0.93) > chance(64, 1, 4, 0.5)


@pytest.mark.parametrize("name", ["sf0.001", "check_h"])
def test_query(spark, name):
    folder = f"/root/testdata/{name}"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{folder}/embeddings.parquet").to_pylist()]
    assert got(op13_embedding_near_dedup(spark, folder)) == brute(rows)
