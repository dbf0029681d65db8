"""Reading a quoted file in ranges.

Spark's text source deals out lines, in order within each block of a file; some ``range_chars`` characters of a block's
lines are a range. No task knows whether a line begins a record: a value may hold any line. So

1. each range comes with the ``most`` characters after it, which a record that begins in it can reach at most;
2. each range is read from every line that a record of an earlier range can end before. Readings
   meet soon, so what a range says is short: from this line on, this is where the next range is entered;
3. these maps are followed from the start of each file, numbers alone, one step a range;
4. each range is read once more from where it is really entered, and records are numbered by counts of ranges.

The text moves once, to bring the ends of ranges together with what follows. A lost executor costs the unfinished
tasks of a step; ranges, maps and records are in the shared folder.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.store import cut, forget, small_batches
from .dialect import MOST, decoded, step

#: Characters of a range after which its records are handed on: they are held twice until then.
OUT_CHARS = 1 << 20
LINE_START = re.compile("(?<=[\\r\\n])")


def exits(text: str, own: int, width: int, separator: str, most: int) -> tuple[list[int], list[int]]:
    """For the line starts of a range (the first ``own`` characters of text) that an earlier record can end before: where
    the range after it is entered, counted from its start. Of neighbours with the same exit the first is given."""
    known: dict[int, int] = {}
    starts = [0, *(m.start() for m in LINE_START.finditer(text, 1, min(own, most + 1)) if m.start() < own)]
    for start in reversed(starts):
        at, passed = start, []
        while at < own and at not in known:
            passed.append(at)
            at = step(text, at, width, separator, most)[1]
        out = at - own if at >= own else known[at]
        known.update(dict.fromkeys(passed, out))
    kept = [s for k, s in enumerate(starts) if k == 0 or known[s] != known[starts[k - 1]]]
    return kept, [known[s] for s in kept]


def entries(sizes: list[int], maps: list[tuple[list[int], list[int]]]) -> list[int]:
    """Where each range of a file is entered; -1 if a record covers all of it."""
    out, at = [], 0
    for size, (starts, ends) in zip(sizes, maps, strict=True):
        if at >= size:
            out.append(-1)
            at -= size
        else:
            out.append(at)
            at = ends[bisect_right(starts, at) - 1]
    return out


def lines_as_ranges(lines: DataFrame, encoding: str, range_chars: int) -> DataFrame:
    """path, block, part, content: the lines of a block in ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, part, held, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            held.append(b"")
            content = b"\n".join(held)
            held.clear()
            text = decoded(content, encoding, place[1] == 0 and part == 0)
            del content
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in ((place[0], pa.string()), (place[1], pa.int64()), (part, pa.int32()), (text, pa.string()))], ["path", "block", "part", "content"])

        for batch in batches:
            for own, line in zip(zip(batch["path"].to_pylist(), batch["block"].to_pylist(), strict=True), (x.as_py() for x in batch["line"]), strict=True):
                if held and (own != place or size >= range_chars):
                    yield out()
                    size, part = 0, part + 1
                if own != place:
                    place, part = own, 0
                held.append(line)
                size += len(line) + 1
        if held:
            yield out()

    return lines.mapInArrow(run, "path string, block long, part int, content string")


def ahead(ranges: pd.DataFrame, most: int) -> pd.DataFrame:
    """Which ranges of a file (path, block, part, size) the range number ``of`` needs: itself, and those that hold
    the ``most`` characters after it."""
    own = ranges.sort_values(["block", "part"], ignore_index=True)
    rows = []
    for k, size in enumerate(own["size"]):
        rows.append((k, k))
        reach, j = 0, k + 1
        while reach < most and j < len(own):
            rows.append((k, j))
            reach += own["size"][j]
            j += 1
    found = own.iloc[[j for _, j in rows]].assign(of=[k for k, _ in rows], is_own=[j == k for k, j in rows])
    return found[["path", "block", "part", "of", "is_own"]]


def read_ranges(spark: SparkSession, path: str, width: int, separator: str, encoding: str, most: int = MOST, range_chars: int = 4 * MOST, most_broadcast: int = 200_000) -> DataFrame:
    """path, record, fields. ``most`` is part of what a record is; range_chars changes no result."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    ranges = cut(lines_as_ranges(small_batches(lines), encoding, range_chars))
    sizes = ranges.select("path", "block", "part", F.length("content").alias("size"))
    needs = sizes.groupBy("path").applyInPandas(lambda own: ahead(own, most), "path string, block long, part int, of int, is_own boolean")
    text = F.when(F.col("is_own"), F.col("content")).otherwise(F.substring("content", F.lit(1), F.lit(most)))
    near = ranges.join(needs, ["path", "block", "part"]).select("path", "of", F.struct("block", "part", text.alias("text")).alias("own"), F.when(F.col("is_own"), F.length("content")).alias("size"))
    both = near.groupBy("path", "of").agg(F.max("size").alias("size"), F.sort_array(F.collect_list("own")).alias("held"))  # the range and what a record reaches
    units = cut(both.select("path", "of", "size", F.array_join(F.transform("held", lambda x: x["text"]), "").alias("text")))
    forget(ranges)

    def with_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                starts, ends = exits(row["text"][0].as_py(), row["size"][0].as_py(), width, separator, most)
                yield pa.RecordBatch.from_arrays([row["path"], row["of"], row["size"], pa.array([starts], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64()))], ["path", "of", "size", "starts", "ends"])

    def follow(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("of")
        return own[["path", "of"]].assign(entry=entries(own["size"].tolist(), list(zip(own["starts"], own["ends"], strict=True))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch[c][k].as_py() for c in ("path", "of", "size", "text", "entry")}
                at, place, rows, begin = row["entry"], 0, [], row["entry"]
                while at < row["size"]:
                    found, at = step(row["text"], at, width, separator, most)
                    rows += found
                    if len(rows) >= 5000 or at - begin >= OUT_CHARS or at >= row["size"]:
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["path"]] * n, pa.string()), pa.array([row["of"]] * n, pa.int32()), pa.array(range(place + 1, place + n + 1), pa.int64()), pa.array(rows, pa.list_(pa.string()))], ["path", "of", "place", "fields"]
                        )
                        place, rows, begin = place + n, [], at

    maps = units.mapInArrow(with_maps, "path string, of int, size int, starts array<long>, ends array<long>")
    entered = cut(maps.groupBy("path").applyInPandas(follow, "path string, of int, entry int"))
    few = entered.count() <= most_broadcast
    told = units.join(F.broadcast(entered) if few else entered, ["path", "of"]).filter("entry >= 0")
    parsed = cut(told.mapInArrow(emit, "path string, of int, place long, fields array<string>"))
    counts = parsed.groupBy("path", "of").agg(F.max("place").alias("n"))
    before = counts.select("path", "of", (F.sum("n").over(Window.partitionBy("path").orderBy("of")) - F.col("n")).alias("before"))
    return parsed.join(F.broadcast(before) if few else before, ["path", "of"]).select("path", (F.col("before") + F.col("place")).alias("record"), "fields")
