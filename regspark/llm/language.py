"""Operator 4. Language by rank-order profiles of character n-grams.

A profile is the ``depth`` most frequent n-grams (one to three characters, words padded by a space) of
all training texts of a language, by rank. A document's own most frequent n-grams are compared with
each profile by the out-of-place distance: the sum over its n-grams of how far the ranks differ,
``depth`` where the profile lacks the n-gram. The nearest language wins, ties to the smaller name.

Counts cover all training rows. Each task sends one row per language and n-gram it has seen; the
driver gets at most languages x 16 x depth rows, the leaders of 16 parts of each language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without lang or
doc_id teach nothing and are predicted; without any training row all are ``und``; repeated rows
count each; a very long text counts whole; n-grams of equal counts go by code; an empty table gives no
rows; other columns are ignored, or kept by only_known, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, private, small_batches
from .words import slices

UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> np.ndarray:
    """All n-grams of one to three characters, as integers of 21 bits a character; none across words."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one space after each word
    if not is_letter.any():
        return np.empty(0, np.int64)
    keep[np.argmax(is_letter) - 1] = True  # and one before the first
    own, is_letter = np.where(is_letter, points, 32)[keep], is_letter[keep]
    pairs = own[:-1] << 21 | own[1:]
    triples = (pairs[:-1] << 21 | own[2:])[is_letter[1:-1]]
    return np.concatenate([own[is_letter], pairs, triples])


def most_frequent(text: str | None, depth: int) -> np.ndarray:
    """A document's n-grams by falling frequency, ties by code."""
    codes, counts = np.unique(grams(text), return_counts=True)
    return codes[np.lexsort((codes, -counts))[:depth]]


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of training (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(parts: list) -> list:
            codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return [(codes, np.bincount(where, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64))]

        for batch in slices(batches):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(grams(text), return_counts=True))
                if len(parts) >= 200:
                    held[lang] = merged(parts)
        for lang, parts in held.items():
            [(codes, n)] = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    return training.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(training: DataFrame, depth: int = 300) -> dict[str, np.ndarray]:
    """language -> its n-grams by rank."""
    part = F.pmod(F.xxhash64("gram"), F.lit(16))
    leaders = Window.partitionBy("lang", "part").orderBy(F.desc("n"), "gram")
    rows = gram_counts(training).withColumn("part", part).withColumn("rank", F.row_number().over(leaders)).filter(F.col("rank") <= depth).collect()
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r["lang"], []).append((-r["n"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(own)[:depth]], np.int64) for lang, own in sorted(found.items())}


def training_rows(docs: DataFrame) -> DataFrame:
    """lang and text of the rows that may teach."""
    return small_batches(docs).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 3) != 1)).select("lang", "text")


def with_language(docs: DataFrame, learned: dict[str, np.ndarray], depth: int = 300, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs and two more columns: the language, the score."""
    tables = []
    for lang, codes in learned.items():
        order = np.argsort(codes)
        tables.append((lang, codes[order], order))
    names = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = [], []
            for text in batch.column(batch.schema.names.index("text")).to_pylist():
                own = most_frequent(text, depth)
                lang, score = UNKNOWN, 0.0
                if len(own):
                    ranks = np.arange(len(own))
                    best = None
                    for name, codes, order in tables:
                        if not len(codes):
                            continue
                        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                        distance = int(np.where(codes[at] == own, np.abs(order[at] - ranks), depth).sum())
                        if best is None or distance < best:
                            best, lang = distance, name
                            score = 1 - min(distance / (depth * len(own)), 1.0)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, *added])

    schema = T.StructType([*docs.schema.fields, T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType())])
    return docs.mapInArrow(predict, schema)


def language_id(docs: DataFrame, depth: int = 300) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    return with_language(own, profiles(training_rows(docs), depth), depth).select("doc_id", "held_out", "lang_pred", "score")


def only_known(docs: DataFrame, least_score: float = 0.05, depth: int = 300) -> DataFrame:
    """docs whose language is known with at least least_score; the columns stay as they are."""
    language, nearness = private("language"), private("nearness")
    found = with_language(docs, profiles(training_rows(docs), depth), depth, (language, nearness))
    return found.filter((F.col(language) != UNKNOWN) & (F.col(nearness) >= least_score)).select(*docs.columns)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
