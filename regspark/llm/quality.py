"""Operator 6. Quality by Bradley-Terry ranking.

Preference pairs (a document labelled 1 before one labelled 0) give a logistic loss on feature
differences; the weights so learned score every document. Features are simple shares of a
text, cut into bins at the sample's quantiles, so that too much and too little can both count
against a text. The raw score at the quantile of label 0's share is the threshold; the published
score is a logistic curve that passes 0.3 there.

The labelled sample is bounded (the ``most_labelled`` documents with the smallest hashes of doc_id), and so
are the pairs (``most_pairs``); both are on the driver. Scores cover all rows and whole texts.

Defined cases: null text is empty, and empty texts get a score like others; a document with several
labels counts by their mean, one with several texts teaches by that with the least features; rows with null
labels or doc_id teach nothing; without both labels every score is 0.5; a very long text is one row;
repeated rows get equal scores; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, crc_mod, small, small_batches
from .words import slices

FEATURES = ("log_words", "upper", "digit", "exclaim", "bar", "symbol", "comma", "period", "short", "long", "repeated", "different", "mean_word", "sentence", "line", "accent", "odd_case", "longest_run")
THRESHOLD = 0.3
SYMBOL = re.compile(r"[#$%&*@^~<>{}\[\]\\/=_+]")
UPPER, DIGIT, ACCENT, ODD = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]"), re.compile(r"[^\x00-\x7f]"), re.compile(r"[a-z][A-Z]")


def features(text: str) -> list[float]:
    chars, words = max(len(text), 1), text.split()
    n = max(len(words), 1)
    lower = [w.lower() for w in words]
    same = [a == b for a, b in zip(lower, lower[1:], strict=False)]
    run = most = 0
    for s in same:
        run = run + 1 if s else 0
        most = max(most, run)
    share = lambda pattern: sum(1 for _ in pattern.finditer(text)) / chars
    sizes = list(map(len, words))
    return [
        np.log1p(len(words)), share(UPPER), share(DIGIT), text.count("!") / chars, text.count("|") / n, share(SYMBOL), text.count(",") / n, text.count(".") / n,
        sum(s <= 3 for s in sizes) / n, sum(s >= 10 for s in sizes) / n, sum(same) / n, len(set(lower)) / n**0.8, sum(sizes) / n, n / (text.count(".") + 1), n / (text.count("\n") + 1), share(ACCENT), share(ODD), most,
    ]


def feature_rows(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[tuple[list, np.ndarray]]:
    for batch in slices(batches):
        found = [features(t) for t in batch["text"].to_pylist()]
        yield [batch[c] for c in keep], np.array(found, np.float64).reshape(-1, len(FEATURES))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The column of each feature's bin."""
    start, out = 0, []
    for k, e in enumerate(edges):
        out.append(start + np.searchsorted(e, x[:, k]))
        start += len(e) + 1
    return np.stack(out, 1) if len(x) else np.empty((0, len(edges)), np.int64)


def bradley_terry(better: np.ndarray, worse: np.ndarray, size: int, steps: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights by gradient steps (with per-weight scaling) on the mean logistic loss of w.(better - worse)."""
    w, scale = np.zeros(size), np.full(size, 1e-8)
    for _ in range(steps):
        margin = w[better].sum(1) - w[worse].sum(1)
        push = 1 / (1 + np.exp(np.clip(margin, -50, 50))) / len(margin)
        grad = np.bincount(better.ravel(), np.repeat(push, better.shape[1]), size) - np.bincount(worse.ravel(), np.repeat(push, worse.shape[1]), size) - decay * w
        scale += grad**2
        w += rate * grad / np.sqrt(scale)
    return w


class Model:
    """Bins, weights and threshold; a few hundred numbers."""

    def __init__(self, x: np.ndarray, y: np.ndarray, most_pairs: int, bins: int = 12, seed: int = 1) -> None:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for k in range(len(FEATURES))]
        size = sum(len(e) + 1 for e in self.edges)
        self.weights, self.limit = np.zeros(size), 0.0
        good, bad = np.flatnonzero(y > 0.5), np.flatnonzero(y <= 0.5)
        self.fitted = bool(len(good) and len(bad))
        if self.fitted:
            b, rng = binned(x, self.edges), np.random.default_rng(seed)
            n = min(most_pairs, 50 * max(len(good), len(bad)))
            self.weights = bradley_terry(b[rng.choice(good, n)], b[rng.choice(bad, n)], size)
            self.limit = float(np.quantile(self.raw(x), len(bad) / len(y)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[binned(x, self.edges)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        z = self.raw(x) - self.limit + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, most_pairs: int = 200_000) -> Model:
    own = labels.filter(F.col("quality").isNotNull() & (crc_mod("doc_id", 5) != 0)).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    chosen = bounded_sample(own, own.count(), most_labelled, "doc_id")
    texts = small_batches(docs).select(F.col("doc_id").alias("own_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(small(chosen, 2 * most_labelled), F.col("own_id") == F.col("doc_id")).select("doc_id", "label", "text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, x in feature_rows(batches, ["doc_id", "label"]):
            yield pa.RecordBatch.from_arrays([*kept, pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    each = joined.mapInArrow(compute, "doc_id long, label double, x array<double>")
    rows = each.groupBy("doc_id", "label").agg(F.min("x").alias("x")).collect()  # at most most_labelled
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return Model(x, np.array([r["label"] for r in rows]), most_pairs)


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, x in feature_rows(batches, ["doc_id", "held_out"]):
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(compute, "doc_id long, held_out boolean, score double, predicted int")


def op6_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_scores(docs, fit(docs, labels))
