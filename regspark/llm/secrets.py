"""Operator 7. Secrets by fixed patterns and by character Markov models. Native: DataFrame functions only.

Two first-order character models are compared. The one of random strings learns from the labelled
positives (what the fixed patterns matched, each different string once, over all documents), the
one of ordinary identifiers from the labelled negatives (identifiers outside any match, each once,
in a sample of about ``sample_docs`` documents, by a hash). A run of at least ``least_length`` identifier
characters outside the base spans whose log-likelihood ratio per character is over ``threshold``
is added as kind ``markov``. The models are 2 x 66 x 66 counts, whatever the input's size.

Defined cases: null and empty texts have no spans; without labelled positives the random model
is uniform; rows are handled one by one, so repeated rows give repeated results; spans of one start are
in the order of kinds, and one that overlaps another of another kind stays, but for markov; a very
long text is one row, in some n log n steps for n matches; an empty table gives no rows; other columns
are ignored by scan and kept by redact, whatever their names. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import private, prose, share_by_hash

#: The base patterns, in the order that breaks ties, and the least length of what counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 8, "access": 16, "hex": 32}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
IDENTIFIER = "[A-Za-z0-9+/_-]"
SPANS = "array<struct<start:int,kind:int,end:int>>"


def running(values: Column, of) -> Column:
    """The values combined with all before them, by doubling steps: some n log n operations, where a
    fold that appends would copy its array at each step."""
    size = F.size(values)
    steps = F.slice(F.sequence(F.lit(0), F.lit(30)), F.lit(1), F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int"))

    def step(acc: Column, r: Column) -> Column:
        far = F.call_function("shiftleft", F.lit(1), r)
        moved = F.concat(F.array_repeat(F.lit(None).cast("int"), far), F.slice(acc, F.lit(1), F.size(acc) - far))
        return F.zip_with(acc, moved, lambda a, b: F.when(b.isNull(), a).otherwise(of(a, b)))

    return F.aggregate(steps, values, step)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, hit>> of the leftmost non-overlapping matches (none of them empty).

    What lies between the matches comes from splitting by the same pattern; the starts are
    running sums of the lengths."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    empty = F.array().cast("array<struct<start:int,hit:string>>")
    sums = running(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)), lambda a, b: a + b)
    found = F.zip_with(sums, hits, lambda end, h: F.struct((end - F.length(h)).alias("start"), h.alias("hit")))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_matches(text: Column) -> dict[str, Column]:
    """kind -> its matches. Runs are maximal, so a least length can stand in the pattern itself
    for access and hex; for assign a short match still takes its place before it is dropped."""
    group = lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= LEAST["assign"]
    return {
        "assign": F.filter(matches(text, ASSIGN), group),
        "access": matches(text, f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"),
        "hex": matches(text, f"[0-9a-f]{{{LEAST['hex']},}}"),
    }


def as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (m["start"] + F.length(m["hit"])).cast("int").alias("end")))


def bigrams(strings: DataFrame, label: int) -> DataFrame:
    """(label, a, b, n) of neighbouring characters of the different strings in column s."""
    chars = F.split("s", "")
    n = F.size(chars) - 1
    pairs = strings.distinct().filter(F.length("s") > 1).select(F.explode(F.arrays_zip(F.slice(chars, F.lit(1), n).alias("a"), F.slice(chars, F.lit(2), n).alias("b"))).alias("p"))
    return pairs.groupBy(F.lit(label).alias("label"), "p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def log_ratios(counts: list[tuple[int, str, str, int]], strength: float = 8.0) -> list[float]:
    """For each pair of characters, in the order of ALPHABET: log P(b|a, random) - log P(b|a, ordinary).
    Both models fall back on single characters, those of the random one half on equal chances."""
    size = len(ALPHABET)
    pair = {0: {}, 1: {}}
    first = {0: dict.fromkeys(ALPHABET, 0), 1: dict.fromkeys(ALPHABET, 0)}
    single = {0: dict.fromkeys(ALPHABET, 0), 1: dict.fromkeys(ALPHABET, 0)}
    for label, a, b, n in counts:
        if a in first[label] and b in first[label]:
            pair[label][a, b] = n
            first[label][a] += n
            single[label][b] += n
    total = {k: sum(v.values()) for k, v in single.items()}

    def chance(label: int, a: str, b: str) -> float:
        alone = (single[label][b] + 0.05) / (total[label] + 0.05 * size)
        if label:
            alone = 0.5 * alone + 0.5 / size
        return (pair[label].get((a, b), 0) + strength * alone) / (first[label][a] + strength)

    return [math.log(chance(1, a, b) / chance(0, a, b)) for a in ALPHABET for b in ALPHABET]


def train(docs: DataFrame, sample_docs: int = 4000) -> list[float]:
    """The table of log ratios. The driver gets at most 2 x 66 x 66 counts."""
    texts = prose(docs)
    found = base_matches(F.col("text"))
    values = F.concat(
        F.transform(found["assign"], lambda m: F.regexp_extract(m["hit"], ASSIGN, 2)),
        F.transform(found["access"], lambda m: m["hit"]),
        F.transform(found["hex"], lambda m: m["hit"]),
    )
    positives = texts.select(F.explode(values).alias("s"))
    sample = share_by_hash(texts, texts.count(), sample_docs, "doc_id", "text")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), f"[0-9a-f]{{{LEAST['hex']},}}", " ")
    negatives = sample.select(F.explode(F.regexp_extract_all(rest, F.lit(f"{IDENTIFIER}{{6,}}"), F.lit(0))).alias("s"))
    # a pair seen in one identifier alone may come from a random string that no pattern marks
    counts = bigrams(positives, 1).unionByName(bigrams(negatives, 0).filter("n > 1")).filter(F.col("a").rlike(f"^{IDENTIFIER}$") & F.col("b").rlike(f"^{IDENTIFIER}$"))
    return log_ratios([(r["label"], r["a"], r["b"], r["n"]) for r in counts.collect()])


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token by character, in time linear in its length."""
    lookup = F.split(F.lit(",".join(f"{v:.3f}" for v in table)), ",").cast("array<double>")  # folded to one constant
    chars = F.split(token, "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.size(chars) - 1
    terms = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: F.get(lookup, a * len(ALPHABET) + b))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / F.greatest(n, F.lit(1))


def added(base: Column, runs: Column) -> Column:
    """base and those of the runs that overlap none of them, sorted; runs do not overlap each other."""
    every = F.sort_array(F.concat(base, runs))
    markov = KINDS.index("markov")
    reach = running(F.transform(every, lambda x: F.when(x["kind"] == markov, 0).otherwise(x["end"])), F.greatest)
    starts = F.transform(every, lambda x: F.when(x["kind"] == markov, 2**31 - 1).otherwise(x["start"]))
    ahead = F.reverse(running(F.reverse(starts), F.least))
    rated = F.arrays_zip(every.alias("x"), reach.alias("reach"), ahead.alias("ahead"))
    apart = F.filter(rated, lambda r: (r["x"]["kind"] != markov) | ((r["reach"] <= r["x"]["start"]) & (r["ahead"] >= r["x"]["end"])))
    return F.when(F.size(runs) == 0, base).when(F.size(base) == 0, F.sort_array(runs)).otherwise(F.transform(apart, lambda r: r["x"]))


def with_spans(docs: DataFrame, table: list[float], text: str = "text", least_length: int = 20, threshold: float = 0.7, names: tuple[str, str] = ("base_spans", "spans")) -> DataFrame:
    """docs and two columns: base spans, and spans with those of kind markov, both sorted."""
    own, found = F.coalesce(F.col(text), F.lit("")), private("runs")
    base = F.sort_array(F.concat(*(as_spans(m, k) for k, m in base_matches(own).items())))
    runs = as_spans(F.filter(matches(own, f"{IDENTIFIER}{{{least_length},}}"), lambda m: ratio(m["hit"], table) > threshold), "markov")
    out = docs.withColumns({names[0]: base.cast(SPANS), found: runs.cast(SPANS)})
    return out.withColumn(names[1], added(F.col(names[0]), F.col(found)).cast(SPANS)).drop(found)


def joined(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", sample_docs: int = 4000) -> DataFrame:
    """docs with each secret in column text replaced by mark; overlapping spans become one."""
    base, spans, pieces = (private(x) for x in ("base", "spans", "pieces"))
    found = with_spans(docs, train(docs, sample_docs), names=(base, spans))
    text, n = F.col("text"), F.size(spans)
    # a span that begins inside what earlier ones cover only extends it
    reach = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    before = F.concat(F.array(F.lit(0)), F.slice(reach, F.lit(1), n - 1))
    parts = F.zip_with(F.col(spans), before, lambda s, at: F.when(s["start"] >= at, F.concat(F.substring(text, at + 1, s["start"] - at), F.lit(mark))).otherwise(""))
    done = F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(reach, -1) + 1, F.length(text)))
    return found.withColumn(pieces, F.when(n > 0, done).otherwise(text)).drop("text").withColumnRenamed(pieces, "text").select(*docs.columns)


def scan(docs: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    rows = with_spans(prose(docs), train(docs, sample_docs))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
