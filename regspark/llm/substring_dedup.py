"""Operator 8. Repeated passages by content-defined chunks of a gear rolling hash, then exact comparison.

``repeated_passages`` finds every passage of ``least_words`` (15) whole words or more that two documents
share, letter by letter with the white space between its words, whole.

1. A gear hash over words, h = 2^s h + G[word] in 64 bits, depends on the last k words only. Where it is the least
   (the last of equals) of ``reach`` neighbouring places, the text is cut. A chunk runs from one cut to the
   next, ``reach`` words at most; an insertion moves the cuts within its reach only, all others stay on
   their words. A chunk's digest is of its words and of the k words before, which made the cut.
2. Chunks are deduplicated by digest: each digest has a first document. Of any ``least_words`` words,
   wherever they stand, two cuts and the chunk between them depend on these words alone (2 reach + k - 1
   <= least_words), and so two documents that share them share that chunk.
3. Digests that more than one document has go back to their documents. There a repeated chunk is extended word by
   word: of the windows of ``least_words`` words whose chunk it is, those that are repeated letter by letter are told
   by a digest of their own text; those that overlap or adjoin form a span, which thus ends at the exact word.

Digests are dealt once each time. A batch of documents asks for a digest that several of them have with the
smallest and the greatest of their doc_ids only, so that a passage of all documents is two rows a batch. Windows go
out and come back by batch: their places stay behind, as gaps.

The first document (smallest doc_id) that has a window keeps it. Digests of windows have 64 bits; two different
windows of the corpus share one with a chance of 2^-64. Digests of chunks have 48: one that is shared by
chance costs a comparison.

Defined cases: null and empty texts have no chunks; a row without doc_id takes no part; equal rows
of one doc_id are one document; repeats inside one document do not count; of documents with one passage
the smallest doc_id keeps it; a very long text is one row; an empty table gives no rows; other columns are
ignored, or kept by without_repeats, whatever their names. Positions are code points, ends exclusive. Words are what white
space of ASCII separates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, private, prose, small
from .words import slices

#: White space of ASCII, as bytes.split() has it.
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def cuts(gear: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a text of words is cut, given a random number for each word: (the first of the k words that made each cut, and
    for each ``reach`` places in a row which of these it is). The cut is after the k-th word."""
    h = gear[k - 1 :].copy()  # of the k words from each word on
    for t in range(1, k):
        h += gear[k - 1 - t : len(gear) - t] << np.uint64(64 // k * t)
    least = np.arange(reach - 1, len(h)) - np.lib.stride_tricks.sliding_window_view(h, reach)[:, ::-1].argmin(1)
    return np.unique(least, return_inverse=True)


def word_chunks(raw: bytes, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Starts and ends (bytes) of the words, for each window of least_words words which chunk is its first whole
    one, and the chunks' digests. None if there is no window."""
    words = raw.split()
    if len(words) < least_words:
        return None
    space = SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    k = max(1, min(2, (least_words + 1) // 3))
    reach = (least_words - k + 1) // 2
    at, which = cuts(np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64), k, reach)
    digests = [xxhash.xxh3_64_intdigest(raw[a:b]) >> 16 for a, b in zip(starts[at[:-1]].tolist(), ends[at[1:] + k - 1].tolist(), strict=True)]
    return starts, ends, which[: len(words) - least_words + 1], np.array(digests, np.int64)


def groups(digests: np.ndarray, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal digests side by side, by doc_id: their order, the first and last place of each group in it, and whether
    several documents have the digest."""
    order = np.lexsort((doc_ids, digests))
    own = digests[order]
    first, last = np.flatnonzero(np.diff(own, prepend=~own[:1])), np.flatnonzero(np.diff(own, append=~own[-1:]))
    return order, first, last, doc_ids[order[first]] < doc_ids[order[last]]


def repeated(asked: DataFrame) -> DataFrame:
    """The rows of asked (digest, doc_id and others) whose digest more than one document has, with the first of these."""
    same = Window.partitionBy("digest")
    return asked.withColumns({"first": F.min("doc_id").over(same), "last": F.max("doc_id").over(same)}).filter("first < last").drop("last")


def joined(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """First and last of the runs in at (ascending first words of windows) that overlap or adjoin."""
    breaks = np.flatnonzero(np.diff(at) > length)
    return list(zip([0, *(breaks + 1).tolist()], [*breaks.tolist(), len(at) - 1], strict=True))


def repeated_passages(docs: DataFrame, least_words: int = 15) -> DataFrame:
    """doc_id, key, start, end, n_words, first_doc_id, removed: the passages of least_words words or more that
    other documents have as well; removed lists the parts that an earlier document has."""
    if least_words < 2:
        raise ValueError("a passage has two words at least")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [word_chunks(text.encode("utf-8", "replace"), least_words) for text in batch["text"].to_pylist()]
            lists = [np.unique(x[3]) if x else np.empty(0, np.int64) for x in found]
            edges, digests = np.cumsum([0, *map(len, lists)]), np.concatenate(lists)
            order, first, last, several = groups(digests, np.repeat(batch["doc_id"].to_numpy(), np.diff(edges)))
            known = np.empty(len(digests), bool)
            known[order] = np.repeat(several, last - first + 1)
            asked = ~known
            asked[order[first]] = asked[order[last]] = True
            dealt = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(x))[edges], pa.int32()), pa.array(digests[x], pa.int64())) for x in (asked, known)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *dealt], ["doc_id", "asked", "known"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500_000):
            lists: tuple[list, ...] = ([], [], [], [])
            for text, hits in zip(batch["text"].to_pylist(), batch["hits"], strict=True):
                raw = text.encode("utf-8", "replace")
                # another text of the same doc_id may be the one with hits
                starts, ends, which, digests = word_chunks(raw, least_words) or [np.empty(0, np.int64)] * 4
                at = np.flatnonzero(np.isin(digests, hits.values.to_numpy())[which])
                a, b = starts[at], ends[at + least_words - 1]
                own = np.array([xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.uint64)
                points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                for held, x in zip(lists, (own.view(np.int64), at, points[a] - 1, points[b - 1]), strict=True):
                    held.append(x)
            n = np.array([len(x) for x in lists[0]])
            digests, at, starts, ends = (np.concatenate(x) for x in lists)
            doc_ids = np.repeat(batch["doc_id"].to_numpy(), n)
            order, first, last, several = groups(digests, doc_ids)
            by = np.argsort(order[first])
            number = np.empty(len(digests), np.int64)
            number[order] = np.repeat(np.argsort(by), last - first + 1)
            ask = order[np.concatenate([first[by], last[several]])]
            windows = pa.StructArray.from_arrays([pa.array(x[ask], pa.int64()) for x in (digests, doc_ids)], ["digest", "doc_id"])
            gaps = [np.diff(x, prepend=0) for x in (at, starts, number)]
            arrays = [pa.array(x, t) for x, t in zip((n, *gaps, ends - starts), [pa.int32()] * 5, strict=True)]
            arrays = [batch["doc_id"], batch["key"], *arrays, windows]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in arrays], ["doc_ids", "keys", "n", "at", "starts", "number", "lengths", "windows"])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows)):
            own = {c: row[c][0].values for c in row.schema.names}
            doc_ids, keys, n, at, starts, number, lengths = (own[c].to_numpy() for c in ("doc_ids", "keys", "n", "at", "starts", "number", "lengths"))
            at, starts, number = (np.cumsum(x, dtype=np.int64) for x in (at, starts, number))
            ends = starts + lengths
            i, first = own["marks"].field("i").to_numpy(), own["marks"].field("first").to_numpy()
            firsts, marked = np.zeros(max(i.max(), number.max()) + 1, np.int64), np.zeros(max(i.max(), number.max()) + 1, bool)
            firsts[i], marked[i] = first, True
            rows = []
            for doc_id, key, end, m in zip(doc_ids.tolist(), keys.tolist(), np.cumsum(n).tolist(), n.tolist(), strict=True):
                held = np.flatnonzero(marked[number[end - m : end]]) + end - m
                rows += passages(doc_id, key, at[held], starts[held], ends[held], firsts[number[held]])
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], ["doc_id", "key", "start", "end", "n_words", "first_doc_id", "removed"])

    def passages(doc_id: int, key: int, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        for x, y in joined(at, least_words) if len(at) else []:
            own = slice(x, y + 1)
            gone = np.flatnonzero(first[own] < doc_id) + x
            removed = [{"start": int(starts[gone[a]]), "end": int(ends[gone[b]])} for a, b in joined(at[gone], least_words)] if len(gone) else []
            yield doc_id, key, int(starts[x]), int(ends[y]), int(at[y] - at[x]) + least_words, int(first[own].min()), removed

    own = prose(docs).filter("doc_id is not null and text <> ''")
    sampled = materialise(own.mapInArrow(sample, "doc_id long, asked array<bigint>, known array<bigint>"), "chunks")
    told = repeated(sampled.select(F.explode("asked").alias("digest"), "doc_id")).select("doc_id", "digest")
    both = told.union(sampled.select("doc_id", F.explode("known")))
    hits = materialise(both.groupBy("doc_id").agg(F.collect_set("digest").alias("hits")), "hits")
    discard(sampled)
    # equal rows of a document are one row from here on
    texts = own.join(hits, "doc_id").withColumn("key", F.xxhash64("doc_id", "text")).dropDuplicates(["doc_id", "key"])
    schema = "doc_ids array<bigint>, keys array<bigint>, n array<int>, at array<int>, starts array<int>, number array<int>, lengths array<int>, windows array<struct<digest:bigint,doc_id:bigint>>"
    batches = texts.select("doc_id", "key", "text", "hits").mapInArrow(compare, schema).withColumn("batch", F.monotonically_increasing_id())
    windows = materialise(batches, "windows")
    discard(hits)
    asked = windows.select("batch", F.posexplode("windows").alias("i", "w")).select("batch", "i", "w.digest", "w.doc_id")
    marks = repeated(asked).groupBy("batch").agg(F.collect_list(F.struct("i", "first")).alias("marks"))
    schema = "doc_id long, key long, start int, end int, n_words int, first_doc_id long, removed array<struct<start:int,end:int>>"
    return marks.join(windows.drop("windows"), "batch").drop("batch").mapInArrow(spans, schema)


def without_repeats(docs: DataFrame, least_words: int = 15) -> DataFrame:
    """docs with each repeated passage left in the first document that has it alone."""
    gone = repeated_passages(docs, least_words).groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("removed"))).alias("removed")).filter(F.size("removed") > 0)
    own, removed = private("key"), private("removed")
    gone = gone.select(F.col("key").alias(own), F.col("removed").alias(removed))
    key = F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    both = docs.join(small(gone, 100_000), key == gone[own], "left")
    text = docs["text"]
    kept = F.aggregate(
        removed,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return both.withColumn("text", F.when(F.col(removed).isNotNull(), kept).otherwise(text)).select(*docs.columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return spans.select("doc_id", "start", "end", "n_words", "first_doc_id", (F.size("removed") == 0).alias("kept"))
