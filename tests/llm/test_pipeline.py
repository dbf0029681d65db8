"""The pipeline's rows against plain Python, stage by stage."""

import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from regspark.llm.bpe import default_vocabulary

from .test_decontaminate import brute as contaminated
from .test_secrets import brute as secret_spans
from .test_similarity_join import brute as components


def hide(text):
    out, at = "", 0
    for start, _, end, _ in secret_spans(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_stages_and_run(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert len(corpus_pipeline.STAGES) == 5
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    docs = [d for d, c in zip(sorted(docs), sorted(components(docs, 5, 80)), strict=True) if d[0] == c[2]]
    docs = [d for d, c in zip(docs, contaminated(docs, items), strict=True) if not c[5]]
    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = {d: len(tokenizer.encode(hide(t), add_special_tokens=False).ids) + 1 for d, t in docs}
    got = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want
    first = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert first.columns == names


def test_stages_on_odd_and_empty_tables(spark, sf_dir):
    rows = [(1, None, "en", "s", 0, "a"), (2, "", "en", "s", 0, "a"), (3, "the cat sat", "en", "s", 11, "a"), (3, "the cat sat", "en", "s", 11, "a"), (None, "the cat sat down", None, None, None, None), (4, "the " * 5000, "en", "s", 1, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for own in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, own, sf_dir)
            assert out.columns == df.columns and out.schema == df.schema, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, own, sf_dir).collect()
