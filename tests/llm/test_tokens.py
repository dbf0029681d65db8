import tracemalloc
import zlib
from collections import defaultdict
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regspark.llm import bpe
from regspark.llm.bpe import WORDS, Encoder, default_vocabulary, encoder, kinds, portions, word_starts
from regspark.llm.common import fresh_path
from regspark.llm.packing import cut, op5_best_fit_packing, pack, pack_documents, plan
from regspark.llm.token_files import lean, narrow, op2_token_files, pack_ints, read_token_files, token_blocks, unpack_ints, widths, write_token_files
from regspark.llm.words import HashTable, code_points

ODD = "doc_id long, text string, n_tokens string, start int"


def odd_rows(spark):
    rows = [(5, "b b", None, None), (5, "b b", "x", 1), (5, "a", "x", 1), (None, "zz", None, None), (1, None, None, None), (2, "", None, None), (3, "the " * 3000, None, None), (4, "²½ \x1c x <|endoftext|> é", None, None)]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def brute(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=8))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_the_library(texts):
    enc = Encoder(default_vocabulary(), 2, most_words=20)
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(texts)] == [brute(enc.tokenizer, t) for t in texts]


@given(st.lists(st.text("  '\n\t\rsdmtlvreab1é’-.,$€", max_size=30), max_size=8))
@settings(max_examples=300, deadline=None)
def test_word_starts_equal_the_pattern(texts):
    points = code_points(texts, "\0")
    whole = "".join(t + "\0" for t in texts)
    start = np.flatnonzero(word_starts(points, kinds()[np.minimum(points, 0x2100)])).tolist()
    assert [w for w in (whole[a:b] for a, b in pairwise([*start, len(whole)])) if w != "\0"] == [w for t in texts for w in WORDS.findall(t)]


@given(st.lists(st.integers(1, 200).map(lambda k: k << 56), unique=True, max_size=30))
def test_hash_table(keys):
    table, keys = HashTable(), np.array(keys, np.uint64)
    assert table.find(keys).tolist() == [-1] * len(keys)
    table.add(keys[:20])
    table.add(keys[20:])
    assert table.find(keys).tolist() == list(range(len(keys)))


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))))
def test_codes_round_trip(values):
    control, data = pack_ints(np.array(values, np.uint64))
    assert len(control) == -(-len(values) // 4)
    assert unpack_ints(control, data, len(values)).tolist() == values


def test_token_files_brute_force(spark, sf_dir, tokenizer):
    got = {r["doc_id"]: r for r in op2_token_files(spark, sf_dir).collect()}
    start = 0
    docs = sorted(pq.read_table(f"{sf_dir}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    assert len(got) == len(docs)
    for d in docs:
        ids = brute(tokenizer, d["text"])
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_odd_rows(spark, tokenizer):
    path = fresh_path(spark, "t")
    write_token_files(odd_rows(spark), path, block_tokens=50)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 5, 5]
    assert got[1]["ids"] == [2] and got[2]["ids"] == [2]
    assert got[4]["ids"] == brute(tokenizer, "²½ \x1c x <|endoftext|> é")
    assert [r["ids"] for r in got[5:]] == [brute(tokenizer, t) for t in ("a", "b b", "b b")]
    assert [r["start"] for r in got] == list(np.cumsum([0, *(r["n_tokens"] for r in got)]))[:-1]


def test_token_files_empty(spark):
    path = fresh_path(spark, "t")
    write_token_files(odd_rows(spark).limit(0), path)
    assert read_token_files(spark, path).collect() == []


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
@settings(max_examples=200, deadline=None)
def test_plan_places_every_rank_once(counts):
    room, ranks = defaultdict(list), defaultdict(set)
    for length, a, b, first, each, at in plan(counts, 64):
        for r in range(a, b):
            assert r not in ranks[length]
            ranks[length].add(r)
            room[first + (r - a) // each].append((at + (r - a) % each * length, length))
    assert {k: len(v) for k, v in ranks.items()} == counts
    for slots in room.values():
        end = 0
        for at, n in sorted(slots):
            assert at == end
            end = at + n
        assert end <= 64
    assert sorted(room) == list(range(len(room)))


def check_pieces(rows, docs, tokenizer, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in docs:
        ids = brute(tokenizer, text)
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == cut(len(ids), capacity)
        assert all(r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]]) for r in own)
    for slots in by_sequence.values():
        end = 0
        for at, n in sorted(slots):
            assert at == end
            end = at + n
        assert end <= capacity
    return len(by_sequence)


def test_packing_brute_force(spark, sf_dir, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    rows = op5_best_fit_packing(spark, sf_dir).collect()
    n = check_pieces(rows, docs, tokenizer, 1024)
    assert n <= 1.01 * sum(r["length"] for r in rows) / 1024 + 1


def test_packing_odd_rows(spark, tokenizer):
    rows = pack_documents(odd_rows(spark), capacity=16).collect()
    assert len([r for r in rows if r["doc_id"] == 5]) == 3
    slots = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == r["length"] <= 16
        slots[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in slots.values():
        assert sum(n for _, n in s) <= 16 and len({a for a, _ in s}) == len(s)
    assert pack_documents(odd_rows(spark).limit(0)).collect() == []


def test_packing_one_hot_length(spark):
    rows = [(k, 0, 0, 3, k) for k in range(1000)] + [(2000, 0, 0, 1, 5)]
    got = pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), 7, least_salts=4, salt_pieces=5).collect()
    assert len(got) == 1001 and len({(r["sequence_id"], r["offset"]) for r in got}) == 1001
    assert len({r["sequence_id"] for r in got}) == 500


def test_encoding_takes_little_memory():
    enc, texts = Encoder(default_vocabulary(), 2), ["one two three four five " * 1000] * 160
    enc.encode(texts[:1])
    tracemalloc.start()
    for a, b in portions(texts):
        enc.encode(texts[a:b])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_ids_are_stored_narrow(spark):
    rows = token_blocks(odd_rows(spark), default_vocabulary(), 2, 50).select("n_tokens", "ids").collect()
    assert all(len(r["ids"]) == 2 * r["n_tokens"] for r in rows)
    for ids in ([0], [65535, 3], [65536, 3], [2**32 - 1]):
        batch = pa.RecordBatch.from_pydict({"n_tokens": [len(ids)] * 2, "ids": [narrow(np.array(ids, np.uint32))] * 2})
        assert [x.tolist() for x in widths(batch)] == [ids, ids]


def test_blocks_go_in_small_row_groups(spark):
    path = fresh_path(spark, "t")
    docs = spark.range(120).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b c d e f g h "), 12_500).alias("text"))
    write_token_files(docs, path)
    sizes = []
    for file in Path(path.removeprefix("file://"), "blocks").glob("*.parquet"):
        found = pq.ParquetFile(file).metadata
        sizes.append([found.row_group(k).total_byte_size for k in range(found.num_row_groups)])
    assert max(map(sum, sizes)) > 8e6 > 6e6 > max(map(max, sizes))


def test_lean_work_begins_without_word_tables():
    encoder(default_vocabulary(), 2)
    assert list(lean(lambda batches: iter([len(bpe._encoders)]))(iter([]))) == [0]
