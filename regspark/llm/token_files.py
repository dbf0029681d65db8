"""Operator 2. Token ids in files: frequency-ranked ids in a byte-aligned variable-length code.

File format (a folder):

* ``blocks``: Parquet rows, one per block of whole documents: ``shard``, ``block``, ``offset``
  (ids before the block in its shard), ``doc_ids``, ``doc_lengths``, ``control``, ``data``.
  An id is stored as its frequency rank (0: the most frequent) in one to four little-endian
  bytes in ``data``; ``control`` has two bits per id, the number of its bytes less one, four ids
  to a byte, low bits first.
* ``ranks``: ``rank``, ``id`` (at most the vocabulary's size).
* ``shards``: ``shard``, ``start`` (ids before the shard).

Shards ascend in doc_id, and so do documents in a shard. Parquet is only the container: it puts
the blocks into any store that Spark reaches, with Spark's commit of finished tasks, so a lost
executor costs its unfinished tasks. Blocks are large rows, which Parquet would hold a task's worth of at
once, on either side; so row groups end after some 2 M ids. Nothing but ranks (bounded by the vocabulary) and shard
totals (one per partition) comes to the driver.

Defined cases: null text is empty (only the end id); rows with the same doc_id are kept all,
ordered by a digest of their texts; null doc_ids come first; a very long text is one block, whatever
its size; an empty table gives empty files; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_vocabulary, encoder, forget, portions
from .common import discard, fresh_path, materialise, prose
from .words import slices

BLOCKS = "shard int, block int, offset long, n_tokens long, doc_ids array<bigint>, doc_lengths array<int>"

#: Bytes of the four ids that a control byte describes.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack_ints(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    four = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), four[np.arange(4) < size[:, None]].tobytes()


def unpack_ints(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def narrow(ids: np.ndarray) -> bytes:
    """The ids (at least one) with two bytes each if all fit, else with four."""
    return ids.astype("<u2" if ids.max() <= 0xFFFF else "<u4").tobytes()


def widths(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """What narrow() was given, for each row of a batch with n_tokens and ids."""
    for n, ids in zip(batch["n_tokens"].to_pylist(), batch["ids"], strict=True):
        yield np.frombuffer(ids.as_buffer(), f"<u{len(ids.as_buffer()) // n}")


def row_groups(block_tokens: int, most_tokens: int = 2_000_000) -> dict[str, str]:
    """Writer options for tables of blocks: Parquet looks at a row group's size after a hundred rows at first, which
    are all that a task has, so rows are counted. Blocks differ; dictionaries would only cost memory."""
    return {"parquet.block.row.count.limit": str(max(1, most_tokens // block_tokens)), "parquet.enable.dictionary": "false"}


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(work: Work) -> Work:
    """work without the word table that an earlier task left in this worker: encoding is over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from work(batches)

    return run


def token_blocks(docs: DataFrame, vocabulary: str, end_id: int, block_tokens: int) -> DataFrame:
    """Documents in ascending order, tokenised, whole documents to a block."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, block, offset, held, names, size, shard = encoder(vocabulary, end_id), 0, 0, [], [], 0, 0

        def full() -> pa.RecordBatch:
            lengths = [len(x) for x in held]
            row = [[shard], [block], [offset], [size], [names], [lengths], [narrow(np.concatenate(held))]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()), strict=True)], ["shard", "block", "offset", "n_tokens", "doc_ids", "doc_lengths", "ids"])

        for batch in slices(batches):
            shard = batch["shard"][0].as_py()
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for a, b in portions(texts):
                for doc_id, ids in zip(doc_ids[a:b], enc.encode(texts[a:b]), strict=True):
                    held.append(ids)
                    names.append(doc_id)
                    size += len(ids)
                    if size >= block_tokens:
                        yield full()
                        block, offset, held, names, size = block + 1, offset + size, [], [], 0
        if held:
            yield full()

    # the text's digest and the reading task part rows of one doc_id, or without any
    rows = prose(docs).withColumns({"tie": F.xxhash64("text"), "task": F.spark_partition_id()})
    ordered = rows.repartitionByRange("doc_id", "tie", "task").sortWithinPartitions("doc_id", "tie", "text")
    return ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text").mapInArrow(encode, BLOCKS + ", ids binary")


def id_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all documents; each partition sends one row per id it has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in widths(batch):
                n = np.bincount(ids)
                total = np.pad(total, (0, max(0, len(n) - len(total))))
                total[: len(n)] += n
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["id", "n"])

    return blocks.select("n_tokens", "ids").mapInArrow(lean(count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, block_tokens: int = 262_144) -> None:
    """Encode every whole text and write the format above to the folder path."""
    spark = docs.sparkSession
    blocks = materialise(token_blocks(docs, vocabulary or default_vocabulary(), end_id, block_tokens), "tokens", options=row_groups(block_tokens))
    ranked = id_counts(blocks).orderBy(F.desc("n"), "id").collect()  # at most one row per id of the vocabulary
    ids = np.array([r["id"] for r in ranked], np.int64)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))
    ranks = spark.sparkContext.broadcast(rank_of)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, ids in enumerate(widths(batch)):
                one = batch.slice(k, 1)
                control, data = pack_ints(ranks.value[ids])
                yield pa.RecordBatch.from_arrays([*(one[c] for c in range(6)), pa.array([control], pa.binary()), pa.array([data], pa.binary())], [*one.schema.names[:6], "control", "data"])

    coded = blocks.mapInArrow(lean(compress), BLOCKS + ", control binary, data binary")
    coded.write.options(compression="zstd", **row_groups(block_tokens)).parquet(f"{path}/blocks")
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    start, starts = 0, []
    for shard, n in sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):
        starts.append((shard, start))
        start += n
    spark.createDataFrame(starts, "shard int, start long").coalesce(1).write.parquet(f"{path}/shards")
    discard(blocks)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    rows = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    table = spark.sparkContext.broadcast(np.array([r["id"] for r in rows], np.uint32))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for r in batch.to_pylist():
                ids = table.value[unpack_ints(r["control"], r["data"], r["n_tokens"])].astype("<u4")
                lengths = np.array(r["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [pa.array(r["doc_ids"], pa.int64()), pa.array(ends - lengths + r["offset"] + r["start"], pa.int64()), pa.array(lengths, pa.int64()), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    blocks = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/shards"), "shard")
    return blocks.mapInArrow(lean(decode), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_token_files(spark, path, with_ids=False)
