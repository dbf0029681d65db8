"""Operator 10. Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by documents: each block of documents has its own sorted posting lists, one
for each word (as a 64-bit hash) that the test items use, with the positions of all its documents on one
scale (a free place between two documents, so that no phrase crosses). It is a table in the shared folder; its
size follows the corpus. For each window of consecutive item words, the lists of the two rarest
words (by occurrences in the whole corpus) are intersected after subtracting their offsets, block by
block; what is left is intersected with the lists of all other words of the item, which gives exact
matches. A block looks items up by their windows' rarest words, so items that it lacks cost it nothing.
Proximity matches allow the two rarest words a distance that differs by up to ``slop`` words from
that in the item. Nothing is shuffled but the counts of words.

Test items come to the driver and to the tasks in parts of at most ``most_words`` words (one item at
least); each part has its own index pass, and only one part is held at a time.

Defined cases: null and empty texts have no words; an item without words matches nothing, one
shorter than the window is one window; an item without item_id counts as one item that has no name;
items that share an item_id are one; of equally rare words the earlier counts as rarer; a very long text is a
block of its own; repeated rows each get their own result; an empty corpus gives no rows, an empty
benchmark leaves every document clean; other columns are ignored, or kept by without_contaminated,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, private, prose, small
from .words import HashTable, alphanumeric, slices, word_hashes

BLOCK = "block string, doc_ids array<bigint>, hashes array<bigint>, n_words array<int>, words array<bigint>, counts array<int>, positions array<int>"
RESULT = "block string, place int, doc_id long, text_hash long, n_words long, hits array<int>, items array<string>, near array<string>"


def item_parts(items: DataFrame, most_words: int) -> Iterator[list[tuple]]:
    """The items (id as text, hashes of the words) in parts of bounded size; those without words are left out."""
    part, size = [], 0
    for r in items.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        found = word_hashes([r["text"]], alphanumeric)[0].view(np.int64).tolist()
        if found:
            if size + len(found) > most_words and part:
                yield part
                part, size = [], 0
            part.append((r["item_id"], found))
            size += len(found)
    yield part


def vocabulary_of(part: list[tuple]) -> np.ndarray:
    return np.unique(np.array([w for _, words in part for w in words], np.int64))


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """The posting lists of the words in vocabulary, a row per block of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, task = shared.value, TaskContext.get().partitionId()
        table = HashTable()
        table.add(names.view(np.uint64))
        for number, batch in enumerate(slices(batches)):
            codes, _, sizes = word_hashes(batch["text"].to_pylist(), alphanumeric)
            word = table.find(codes)
            there = np.flatnonzero(word >= 0)
            order = there[np.argsort(word[there], kind="stable")]
            own, counts = np.unique(word[there], return_counts=True)
            positions = (np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes))[order]
            row = [f"{task}-{number}", batch["doc_id"], batch["text_hash"], sizes, names[own], counts, positions]
            types = (pa.string(), *map(pa.list_, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32())))
            yield pa.RecordBatch.from_arrays([pa.array([v.to_pylist() if isinstance(v, pa.Array) else v], t) for v, t in zip(row, types, strict=True)], ["block", "doc_ids", "hashes", "n_words", "words", "counts", "positions"])

    return prose(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(build, BLOCK)


def word_counts(index: DataFrame) -> dict[int, int]:
    """Occurrences in the corpus of the index's words; as many rows as the vocabulary has."""
    each = index.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("x.words").agg(F.sum("x.counts").alias("n"))
    return {w: n for w, n in each.collect()}


def rarest_pairs(words: list[int], counts: dict[int, int], window: int) -> set[tuple[int, int]]:
    """The places of the two rarest words of each window; a window with a word that the corpus lacks
    occurs nowhere. A window of one word has its place twice."""
    w, found = min(window, len(words)), set()
    for s in range(len(words) - w + 1):
        order = sorted(range(s, s + w), key=lambda j: (counts.get(words[j], 0), j))
        if counts.get(words[order[0]], 0):
            found.add((order[0], order[1] if w > 1 else order[0]))
    return found


class Block:
    """One block's lists, read from its row."""

    def __init__(self, row: dict) -> None:
        self.row = row
        positions, ends = np.asarray(row["positions"], np.int64), np.cumsum(row["counts"])
        self.lists = dict(zip(row["words"], np.split(positions, ends[:-1]) if len(ends) else [], strict=True))
        self.bases = np.cumsum([0, *(n + 1 for n in row["n_words"])])
        self.none = np.empty(0, np.int64)

    def list(self, word: int) -> np.ndarray:
        return self.lists.get(word, self.none)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, positions, "right") - 1


def has(sorted_list: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, values), max(len(sorted_list) - 1, 0))
    return sorted_list[at] == values if len(sorted_list) else np.zeros(len(values), bool)


def phrases(block: Block, words: list[int], pairs: set[tuple[int, int]], window: int) -> np.ndarray:
    """Positions hit by any occurrence of a window of the item."""
    starts = [np.intersect1d(block.list(words[a]) - a, block.list(words[b]) - b, assume_unique=True) for a, b in pairs]
    starts = np.unique(np.concatenate([block.none, *starts]))
    if not len(starts):
        return starts
    there = np.stack([has(block.list(w), starts + j) for j, w in enumerate(words)])
    w = min(window, len(words))
    ends = np.cumsum(np.vstack([np.zeros((1, len(starts)), np.int64), there]), 0)
    first, which = np.nonzero(ends[w:] - ends[:-w] == w)
    return np.unique((starts[which] + first)[:, None] + np.arange(w)) if len(first) else block.none


def near_docs(block: Block, words: list[int], pairs: set[tuple[int, int]], slop: int) -> dict[int, int]:
    """place of a document -> the least difference from the item's distance between two rarest words."""
    found: dict[int, int] = {}
    for a, b in pairs:
        first, second = block.list(words[a]), block.list(words[b])
        docs = block.doc_of(first)
        wanted = first + (b - a)
        low, high = np.maximum(wanted - slop, block.bases[docs]), np.minimum(wanted + slop, block.bases[docs + 1] - 2)
        at = np.searchsorted(second, low)
        for k in np.flatnonzero(at < np.searchsorted(second, high, "right")).tolist():
            own = second[at[k] : np.searchsorted(second, high[k], "right")]
            own = own[own != first[k]] if a != b else own  # one word does not stand for both
            if len(own):
                d = int(docs[k])
                found[d] = min(found.get(d, slop), int(np.abs(own - wanted[k]).min()))
    return found


def planned(part: list[tuple], counts: dict[int, int], window: int) -> tuple[list[tuple], dict[int, list[int]]]:
    """Items with windows that the corpus may hold, and their numbers by rarest words."""
    items = [(k, w, pairs) for k, w in part if (pairs := rarest_pairs(w, counts, window))]
    by_word: dict[int, set[int]] = {}
    for n, (_, words, pairs) in enumerate(items):
        for a, _ in pairs:
            by_word.setdefault(words[a], set()).add(n)
    return items, {w: sorted(own) for w, own in by_word.items()}


def items_in(block: Block, plan: tuple[list[tuple], dict[int, list[int]]]) -> Iterator[tuple]:
    items, by_word = plan
    for n in sorted({n for w in block.lists if w in by_word for n in by_word[w]}):
        yield items[n]


def search(index: DataFrame, part: list[tuple], window: int, slop: int) -> DataFrame:
    """RESULT: a row per document of the index."""
    plan = index.sparkSession.sparkContext.broadcast(planned(part, word_counts(index), window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                [row] = batch.slice(k, 1).to_pylist()
                block, n = Block(row), len(row["doc_ids"])
                hits, items, near = [], [set() for _ in range(n)], [set() for _ in range(n)]
                for item_id, words, pairs in items_in(block, plan.value):
                    found = phrases(block, words, pairs, window)
                    if len(found):
                        hits.append(found)
                        for d in np.unique(block.doc_of(found)):
                            items[d].add(item_id)
                    for d in near_docs(block, words, pairs, slop):
                        near[d].add(item_id)
                every = np.unique(np.concatenate([block.none, *hits]))
                cuts = np.searchsorted(every, block.bases[1:-1])
                own = [h - base for h, base in zip(np.split(every, cuts), block.bases, strict=False)]
                columns = [[row["block"]] * n, list(range(n)), row["doc_ids"], row["hashes"], row["n_words"], own, list(map(list, items)), list(map(list, near))]
                types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["block", "place", "doc_id", "text_hash", "n_words", "hits", "items", "near"])

    return index.mapInArrow(run, RESULT)


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 3, window: int = 13, most_words: int = 500_000) -> DataFrame:
    """doc_id, item_id, distance: documents where the two rarest words of a window of the item are at most
    slop words from their distance in the item, with the least such difference (0: as in the item)."""
    found = []
    for part in item_parts(items, most_words):
        index = materialise(build_index(docs, vocabulary_of(part)), "positional-index")
        plan = planned(part, word_counts(index), window)

        def run(batches: Iterator[pa.RecordBatch], plan: tuple = plan) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    [row] = batch.slice(k, 1).to_pylist()
                    block = Block(row)
                    rows = [(row["doc_ids"][d], item, n) for item, words, pairs in items_in(block, plan) for d, n in near_docs(block, words, pairs, slop).items()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.string(), pa.int32()))], ["doc_id", "item_id", "distance"])

        found.append(materialise(index.mapInArrow(run, "doc_id long, item_id string, distance int"), "near"))
        discard(index)
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, most_words: int = 500_000, slop: int = 3) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated (at
    least one word in one_in is hit), n_near (items with a proximity match)."""
    parts = []
    for part in item_parts(benchmark, most_words):
        index = materialise(build_index(docs, vocabulary_of(part)), "positional-index")
        parts.append(materialise(search(index, part, window, slop), "hits"))
        discard(index)
    result = parts[0]
    if len(parts) > 1:
        once = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "n_words")]
        every = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hits", "items", "near")]
        result = reduce(DataFrame.unionByName, parts).groupBy("block", "place").agg(*once, *every)
    n_hit = F.size("hits").cast("long")
    return result.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"), F.size("near").cast("long").alias("n_near"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """docs less the contaminated rows, other columns as they are."""
    bad_id, bad_hash = private("id"), private("hash")
    found = contamination(docs, benchmark, window).filter("contaminated")
    bad = materialise(found.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct(), "contaminated")
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(small(bad, 500_000), (own == bad[bad_hash]) & docs["doc_id"].cast("long").eqNullSafe(bad[bad_id]), "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, items).drop("text_hash")
