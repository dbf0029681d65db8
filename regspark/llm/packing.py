"""Operator 5. Best-fit packing planned over the histogram of lengths, not over documents.

1. Every document becomes pieces of at most ``capacity`` ids (the remainder first).
2. Piece lengths are counted: at most ``capacity`` counts, which is all that the driver sees.
3. Best fit, longest first, runs over the counts: equal sequences are one entry of the plan, so
   the plan's size depends on the capacity, not on the number of pieces.
4. Each piece finds its planned place by its length and its rank among the pieces of that length.
   Ranks are made in salted groups whose sizes are then summed, so a length that a third of all
   pieces share is spread over many tasks; the salts grow with the pieces.

Defined cases: null text is empty (only the end id); rows with the same doc_id are kept all; a
null doc_id is packed like another; pieces of one length and salt are ranked by doc_id, piece and
digest, and equal ones are alike; a very long text is cut like others; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_vocabulary, encoder, portions
from .common import materialise, prose
from .words import slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of total ids; only the first may be shorter than capacity."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def token_pieces(docs: DataFrame, capacity: int = 1024, vocabulary: str | None = None, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, ids."""
    path = vocabulary or default_vocabulary()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, end_id)
        for batch in slices(batches):
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for a, b in portions(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], enc.encode(texts[a:b]), strict=True):
                    ids = ids.astype("<u4", copy=False)
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        own = ids[s : s + n]
                        rows.append((doc_id, k, s, n, zlib.crc32(own.tobytes()), own.astype(np.int32) if with_ids else None))
                columns = list(zip(*rows, strict=True))[: 5 + with_ids]
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=False)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return prose(docs).mapInArrow(pieces, PIECES + ", ids array<int>" * with_ids)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts of lengths, longest first.

    Rows (length, first rank, end rank, first sequence, pieces to a sequence, offset): pieces
    of that length with ranks in [first rank, end rank) go, in order, into consecutive
    sequences, so many to each, from that offset on."""
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, number of sequences)
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, after = counts[length], 0, []

        def put(first: int, n: int, room: int, each: int, length: int = length, after: list = after) -> None:
            nonlocal rank
            rows.append((length, rank, rank + n * each, first, each, capacity - room))
            rank += n * each
            after.append((room - each * length, first, n))

        for room in sorted(r for r in free if r >= length):
            each = room // length  # the fullest sequence that fits takes more while it fits
            while left and free[room]:
                first, n = free[room].pop()
                use = min(n, left // each)
                if use:
                    put(first, use, room, each)
                    left -= use * each
                if use < n and 0 < left < each:
                    put(first + use, 1, room, left)
                    use, left = use + 1, 0
                if use < n:
                    free[room].append((first + use, n - use))
                    break
            if not left:
                break
        each = capacity // length
        for n, k in ((left // each, each), (1 if left % each else 0, left % each)):
            if n:
                put(sequences, n, capacity, k)
                sequences += n
        for room, first, n in after:
            if room:
                free.setdefault(room, []).append((first, n))
    return rows


def pack(pieces: DataFrame, capacity: int = 1024, least_salts: int = 64, salt_pieces: int = 50_000, most_broadcast: int = 200_000) -> DataFrame:
    """pieces (with doc_id, piece, length, ids_crc32 and any others) and their sequence_id, offset. A salt
    holds some salt_pieces pieces, so that their number follows the input."""
    spark = pieces.sparkSession
    salts = max(least_salts, -(-pieces.count() // salt_pieces))
    keyed = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = keyed.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    sums = materialise(counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))), "packing-counts")
    histogram = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    slots = plan(histogram, capacity)
    table = spark.createDataFrame(slots, "length long, from_rank long, to_rank long, first_sequence long, each long, at long")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        keyed.withColumn("own_rank", F.row_number().over(own) - 1)
        .join(sums.select("length", "salt", "before"), ["length", "salt"])
        .withColumn("rank", F.col("own_rank") + F.coalesce("before", F.lit(0)))
    )
    within = (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    # the plan's rows depend on the capacity alone; should they ever be many, Spark picks the join
    table = F.broadcast(table) if len(slots) <= most_broadcast else table
    placed = ranked.join(table.withColumnRenamed("length", "slot_length"), (F.col("length") == F.col("slot_length")) & within)
    nth = F.col("rank") - F.col("from_rank")
    return placed.withColumns({
        "sequence_id": F.col("first_sequence") + F.floor(nth / F.col("each")).cast("long"),
        "offset": F.col("at") + nth % F.col("each") * F.col("length"),
    }).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = 1024, vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack; the pieces are written once, since counts and places both need them."""
    return pack(materialise(token_pieces(docs, capacity, vocabulary, with_ids=with_ids), "pieces"), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
