"""Operator 9. Jaccard join of shingle sets over a token-group matrix; classes of linked documents.

1. Every text becomes its set of word shingles, as 64-bit tokens: above a hash, 6 bits tell the shingle's
   length, so that the natural order of tokens puts long shingles, which are rare, first. Equal sets
   are one class, known by its smallest doc_id. Of each set a window is kept: its P + P/4 + 2 first
   tokens, P being the prefix length that any linked pair must share a token in.
2. Tokens of more than one class are posted; a class with fewer such tokens in its window than linked
   pairs must share is linked with nothing and goes. Each class that is left has as its centre, of the
   classes whose tokens are posted most, as the unedited text among its copies is, the one that it shares
   most tokens with. Classes with one centre form groups of some ``group_tokens`` tokens, and
   the centre belongs to each of them.
3. Every group is opened: its members' whole sets meet in one task, which names at most one link a
   member. Links make components; copies with small edits are one from here on, without all pairs.
4. The token-group matrix: a group's row is the union of its members' window tokens. Tokens of one component
   need no more work. Tokens of more than ``hot`` groups (passages that many documents share) move to
   the end of the global order; windows shrink by them. Two groups qualify if they hold more than one
   component and share as many tokens as linked members must. Only qualifying groups are opened to each
   other: each member of one, as a query, has its overlap with the other's union bounded
   again, and what passes is compared exactly. Pairs of members exist only inside that task.
5. Documents whose windows hold too many hot tokens are shingled again and take the first P tokens of
   their whole sets in the new order, so nothing is lost to hot tokens.

Links and components stay in tables. Two different shingles share a token with a chance of 2**-57 at most.

Defined cases: null or empty texts, or texts without words, have an empty set and are linked with
nothing; fewer words than a shingle make one shingle; rows that share a doc_id are one document,
so their texts count as linked; a row without doc_id is linked with nothing and has a null
component; a very long text is one set like another, in a group of its own if it is longer than one;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import forget
from .common import discard, materialise, prose, small
from .components import connected_components
from .words import mix, not_space, slices, word_hashes


def shingles(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted different tokens of each text."""
    codes, sizes, counts = word_hashes(texts, not_space)
    joined, length = np.full(len(codes), words, np.uint64), np.zeros(len(codes), np.int64)
    for k in range(min(words, len(codes))):
        joined[: len(codes) - k] = mix(joined[: len(codes) - k] + codes[k:]) * np.uint64(0x9E3779B97F4A7C15)
        length[: len(codes) - k] += sizes[k:]
    rank = np.uint64(63) - np.minimum(length, 63).astype(np.uint64)
    tokens = rank << np.uint64(57) | joined >> np.uint64(7)  # below 2**63: signed order is the same
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(tokens[at : at + n - words + 1]))
        elif n:  # the whole sequence
            own = np.full(1, n, np.uint64)
            for code in codes[at : at + n]:
                own = mix(own + code) * np.uint64(0x9E3779B97F4A7C15)
            out.append(np.uint64(63 - min(63, int(sizes[at : at + n].sum()))) << np.uint64(57) | own >> np.uint64(7))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def needed(n, percent: int):
    """The least number of tokens that a set of n shares with any that it is linked with."""
    return -(-n * percent // 100)


def window(n: int, percent: int) -> int:
    p = n - needed(n, percent) + 1
    return min(n, p + p // 4 + 2)


def prefix_column(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100.0).cast("int") + 1


def window_column(n: Column, percent: int) -> Column:
    p = prefix_column(n, percent)
    return F.least(n, p + F.floor(p / 4).cast("int") + 2)


def shingle_sets(docs: DataFrame, words: int, percent: int, whole: bool = False, last=None) -> DataFrame:
    """doc_id, n, class (128 bits of the set; null if empty), tokens (window or whole set; with last, a
    broadcast sorted array, the prefix after its tokens have moved to the end). A class that a task has met
    before comes without tokens there, but for whole sets and prefixes."""

    def chosen(own: np.ndarray) -> np.ndarray:
        n, signed = len(own), own.view(np.int64)
        if last is not None:
            is_last = np.isin(signed, last.value)
            return np.concatenate([signed[~is_last], signed[is_last]])[: n - needed(n, percent) + 1]
        return signed[: n if whole else window(n, percent)]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        forget()
        for batch in slices(batches, 2_000_000):  # arrays of some 50 times the texts live at once
            sizes, classes, tokens = [], [], []
            for own in shingles(batch["text"].to_pylist(), words):
                n, key = len(own), None
                if n:
                    key = np.array([mix(own).sum(), mix(own * np.uint64(0xD6E8FEB86659FD93)).sum()], np.uint64).tobytes() + n.to_bytes(4, "little")
                sizes.append(n)
                classes.append(key)
                tokens.append(chosen(own) if n and key not in met else None)
                if not whole and last is None:
                    met.add(key)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int32()), pa.array(classes, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))], ["doc_id", "n", "class", "tokens"])

    return prose(docs).mapInArrow(sets, "doc_id long, n int, class binary, tokens array<bigint>")


def links_between(one: pa.Scalar, two: pa.Scalar, percent: int) -> list[tuple[int, int]]:
    """One link at most from each member of one to each component in two (both lists of structs)."""
    flat = two.values
    nodes, components = (flat.field(c).to_numpy() for c in (0, 1))
    lists = flat.field(2)
    tokens, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    owner = np.repeat(np.arange(len(nodes)), np.diff(ends, prepend=0))
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    sizes, found = np.diff(ends, prepend=0), []
    for q in one.as_py():
        own = np.array(q["tokens"], np.int64)
        low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        if np.count_nonzero(high > low) < needed(len(own), percent):  # the bound by the union
            continue
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(nodes))
        good = (common * 100 >= (len(own) + sizes - common) * percent) & (components != q["component"])
        _, first = np.unique(components[good], return_index=True)
        found += [(q["node"], int(b)) for b in nodes[good][first]]
    return found


def links_inside(held: pa.Scalar, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked inside a group; fewer than it has members."""
    nodes, lists = held.values.field(0).to_numpy(), held.values.field(1)
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    tokens, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(nodes)), sizes)
    order = np.argsort(tokens, kind="stable")
    ordered, owner = tokens[order], owner[order]
    ends, label, found = np.cumsum(sizes), np.arange(len(nodes)), []
    for q in range(len(nodes)):
        own = tokens[ends[q] - sizes[q] : ends[q]]
        low, high = np.searchsorted(ordered, own, "left"), np.searchsorted(ordered, own, "right")
        n = high - low
        common = np.bincount(owner[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=len(nodes))
        good = np.flatnonzero((common * 100 >= (len(own) + sizes - common) * percent) & (label != label[q]))
        _, first = np.unique(label[good], return_index=True)
        for k in good[first].tolist():
            found.append((int(nodes[q]), int(nodes[k])))
            label[label == label[k]] = label[q]
    return found


class Join:
    """One similarity join; its tables are in the shared folder."""

    def __init__(self, docs: DataFrame, words: int, percent: int, hot: int, group_tokens: int, most_broadcast: int) -> None:
        self.docs, self.words, self.percent = docs, words, percent
        self.hot, self.group_tokens, self.most_broadcast = hot, group_tokens, most_broadcast

    def whole_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, n, tokens) of the given nodes, from their texts again."""
        wanted = small(nodes.select(F.col("node").alias("doc_id")), self.most_broadcast)
        texts = prose(self.docs).join(wanted, "doc_id", "left_semi")
        sets = shingle_sets(texts, self.words, self.percent, whole=True)
        return materialise(sets.filter("tokens is not null").select(F.col("doc_id").alias("node"), "n", "tokens"), "whole-sets")

    def sizes_fit(self, a: str, b: str) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def least_shared(self, n: Column) -> Column:
        """The least number of window tokens that a set of n shares with any that it is linked with."""
        return window_column(n, self.percent) - prefix_column(n, self.percent) + 1

    def posted(self, windows: DataFrame) -> DataFrame:
        """(token, node, n, weight): window tokens that several classes have, of the classes that have enough
        of them; weight tells how central a class is."""
        each = windows.select(F.explode("tokens").alias("token"), "node")
        often = each.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        shared = materialise(each.join(often, "token"), "shared")  # a class has a token once
        have = shared.groupBy("node").agg(F.count(F.lit(1)).alias("tokens"), F.sum("c").alias("c")).join(windows.select("node", "n"), "node")
        fewest = self.least_shared(F.ceil(F.col("n") * self.percent / 100.0).cast("int"))
        kept = have.filter(F.col("tokens") >= fewest).select("node", "n", (F.col("c") / window_column(F.col("n"), self.percent)).alias("weight"))
        posted = materialise(shared.select("token", "node").join(materialise(kept, "weights"), "node"), "posted")
        discard(shared)
        return posted

    def centres(self, posted: DataFrame) -> DataFrame:
        """(node, n, centre, n_centre): for a class, the central class that it shares most tokens with."""
        best = materialise(posted.groupBy("token").agg(F.max_by("node", "weight").alias("centre"), F.max_by("n", "weight").alias("n_centre")), "centres")
        met = posted.join(best, "token").filter((F.col("node") != F.col("centre")) & self.sizes_fit("n", "n_centre"))
        pairs = met.groupBy("node", "n", "centre", "n_centre").agg(F.count(F.lit(1)).alias("c"))
        enough = pairs.filter(F.col("c") * 2 >= F.least(self.least_shared(F.col("n")), self.least_shared(F.col("n_centre"))))
        return materialise(enough.groupBy("node", "n").agg(F.max_by("centre", "c").alias("centre"), F.max_by("n_centre", "c").alias("n_centre")), "stars")

    def saturated_tokens(self, saturated: DataFrame, hot_tokens: DataFrame) -> DataFrame:
        """(token, node, n): the first P tokens of whole sets, hot ones last. Up to most_broadcast hot
        tokens are looked up in the tasks; beyond that they are joined."""
        if hot_tokens.count() <= self.most_broadcast:
            shared = hot_tokens.sparkSession.sparkContext.broadcast(np.sort(np.array([r["token"] for r in hot_tokens.collect()], np.int64)))
            wanted = small(saturated.select(F.col("node").alias("doc_id")), self.most_broadcast)
            sets = shingle_sets(prose(self.docs).join(wanted, "doc_id", "left_semi"), self.words, self.percent, last=shared)
            return sets.filter("tokens is not null").select(F.explode("tokens").alias("token"), F.col("doc_id").alias("node"), "n")
        each = self.whole_sets(saturated).select("node", "n", F.posexplode("tokens").alias("at", "token"))
        rated = each.join(hot_tokens.select("token", F.lit(True).alias("is_hot")), "token", "left")
        place = F.struct(F.coalesce("is_hot", F.lit(False)).alias("is_hot"), "at", "token")
        first = rated.groupBy("node", "n").agg(F.sort_array(F.collect_list(place)).alias("order"))
        return first.select(F.explode(F.transform(F.slice("order", F.lit(1), prefix_column(F.col("n"), self.percent)), lambda x: x["token"])).alias("token"), "node", "n")

    def groups(self, posted: DataFrame, stars: DataFrame) -> DataFrame:
        """(node, gid, root): classes of one centre, in parts of some group_tokens tokens. Which class is in which
        group decides about speed, never about results."""
        rooted = posted.select("node", "n").distinct().join(stars.select("node", "centre"), "node", "left").select("node", "n", F.coalesce("centre", "node").alias("root"))
        sizes = materialise(rooted.groupBy("root").agg(F.sum("n").alias("tokens")), "group-sizes")
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("tokens") / self.group_tokens))
        return materialise(rooted.join(sizes, "root").select("node", "root", F.xxhash64("root", part).alias("gid")), "groups")

    def inside(self, groups: DataFrame) -> DataFrame:
        """Links inside groups, the centre being a member of each of its groups."""
        percent = self.percent
        members = groups.select("node", "gid").union(groups.filter("node <> root").select("root", "gid")).distinct()
        several = groups.groupBy("gid").agg(F.max(F.col("node") != F.col("root")).alias("several")).filter("several").select("gid")
        members = materialise(members.join(several, "gid", "left_semi"), "members")
        whole = self.whole_sets(members.select("node").distinct())
        boxes = members.join(whole, "node").groupBy("gid").agg(F.collect_list(F.struct("node", "tokens")).alias("held"))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for held in batch["held"]:
                    found = links_inside(held, percent)
                    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], ["a", "b"])

        links = materialise(boxes.select("held").mapInArrow(compare, "a long, b long"), "links")
        discard(whole, members)
        return links

    def matrix(self, rows: DataFrame) -> DataFrame:
        ends = [f(c).alias(f"{c}_{e}") for c in ("n", "component") for e, f in (("low", F.min), ("high", F.max))]
        return rows.groupBy("token", "gid").agg(*ends, F.min("k").alias("k"))

    def across(self, windows: DataFrame, posted: DataFrame, labels: DataFrame, groups: DataFrame) -> DataFrame:
        """Links between components, by the token-group matrix."""
        places = groups.join(labels, "node", "left").select("node", "gid", F.coalesce("component", "node").alias("component"))
        places = materialise(places, "places")
        lab = materialise(posted.drop("weight").join(places, "node").withColumn("k", self.least_shared(F.col("n"))), "labelled")
        spread = lab.groupBy("token", "gid").agg(F.min("component").alias("low"), F.max("component").alias("high")).groupBy("token").agg(F.count(F.lit(1)).alias("groups"), F.min("low").alias("low"), F.max("high").alias("high"))
        spread = materialise(spread.filter("low < high").select("token", "groups"), "spread")
        hot_tokens = spread.filter(F.col("groups") > self.hot).select("token")
        hot_in = lab.join(hot_tokens, "token").groupBy("node", "k").agg(F.count(F.lit(1)).cast("int").alias("hot"))
        short = materialise(hot_in.select("node", (F.col("k") - F.col("hot")).alias("short_k")), "short-windows")
        live = lab.join(spread.filter(F.col("groups") <= self.hot).select("token"), "token", "left_semi")
        live = live.join(short, "node", "left").withColumn("k", F.coalesce("short_k", "k")).drop("short_k")
        full = short.filter("short_k < 1").select("node")
        if not full.isEmpty():
            extra = materialise(self.saturated_tokens(full, hot_tokens), "saturated")
            each = windows.select(F.explode("tokens").alias("token"), "node", "n").join(posted.select("node").distinct(), "node", "left_semi")
            wanted = materialise(extra.select("token").distinct().join(hot_tokens, "token", "left_anti"), "wanted")
            again = each.join(wanted, "token", "left_semi")
            others = again.join(full, "node", "left_anti").join(short, "node", "left").withColumn("k", F.coalesce("short_k", self.least_shared(F.col("n")))).drop("short_k")
            more = others.select("token", "node", "n", "k").unionByName(extra.withColumn("k", F.lit(1))).join(places, "node", "left")
            more = more.withColumn("gid", F.coalesce("gid", F.xxhash64("node", F.lit(0)))).withColumn("component", F.coalesce("component", "node"))
            live = live.filter("k >= 1").unionByName(more.select(*live.columns)).distinct()
        live = materialise(live, "live")
        matrix = materialise(self.matrix(live), "token-group-matrix")
        one, two = (matrix.select("token", *(F.col(c).alias(f"{c}{s}") for c in matrix.columns if c != "token")) for s in "12")
        fit = (F.col("n_high1") * 100 >= F.col("n_low2") * self.percent) & (F.col("n_high2") * 100 >= F.col("n_low1") * self.percent)
        differ = F.least("component_low1", "component_low2") < F.greatest("component_high1", "component_high2")
        met = one.join(two, "token").filter((F.col("gid1") <= F.col("gid2")) & fit & differ)
        qualified = materialise(met.groupBy("gid1", "gid2").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("k1", "k2")).alias("k")).filter("c >= k").select("gid1", "gid2"), "qualified")
        return self.opened(qualified, live.select("gid", "node", "component").distinct())

    def opened(self, qualified: DataFrame, members: DataFrame) -> DataFrame:
        """Links between members of qualifying groups that are not in one component."""
        percent = self.percent
        gids = qualified.select(F.col("gid1").alias("gid")).union(qualified.select("gid2")).distinct()
        members = materialise(members.join(gids, "gid", "left_semi"), "members")
        whole = self.whole_sets(members.select("node").distinct())
        held = F.collect_list(F.struct("node", "component", "tokens")).alias("held")
        boxes = materialise(members.join(whole, "node").groupBy("gid").agg(held), "group-sets")
        discard(whole)

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    found = links_between(row["held1"][0], row["held2"][0], percent)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], ["a", "b"])

        one, two = (boxes.select(F.col("gid").alias(f"gid{s}"), F.col("held").alias(f"held{s}")) for s in "12")
        pairs = qualified.join(one, "gid1").join(two, "gid2").select("held1", "held2")
        links = materialise(pairs.mapInArrow(compare, "a long, b long"), "links")
        discard(boxes)
        return links

    def run(self) -> DataFrame:
        sets = materialise(shingle_sets(self.docs, self.words, self.percent), "shingles")
        rows = materialise(sets.select("doc_id", "n", "class"), "rows")
        named = rows.filter("class is not null and doc_id is not null")
        whole = sets.groupBy("class").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("tokens", ignorenulls=True).alias("tokens"))
        windows = materialise(whole.filter("class is not null and node is not null"), "windows")
        names = windows.select("class", "node", "n")
        discard(sets)
        posted = self.posted(windows)
        # rows of one doc_id are one document: its classes are linked
        own = named.select("class", "doc_id").distinct().join(names.select("class", "node"), "class")
        least = own.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("high")).filter("b < high").select("doc_id", "b")
        named_again = own.join(least, "doc_id").filter("node > b").select(F.col("node").alias("a"), "b").distinct()
        stars = self.centres(posted)
        groups = self.groups(posted, stars)
        links = self.inside(groups).unionByName(named_again.select("a", "b"))
        labels = materialise(connected_components(links), "labels")
        links = links.unionByName(self.across(windows, posted, labels, groups))
        labels = materialise(connected_components(links), "labels")
        discard(posted)
        rows = rows.join(names.select("class", "node"), "class", "left")
        rows = rows.join(labels, "node", "left")
        return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, hot: int = 48, group_tokens: int = 16_384, most_broadcast: int = 500_000) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links lead to)."""
    return Join(docs, words, percent, hot, group_tokens, most_broadcast).run()


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs less all but the smallest doc_id of each component; rows without doc_id stay."""
    other = near_duplicates(docs, words, percent).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(other, "doc_id", "left_anti").select(*docs.columns)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=90)
