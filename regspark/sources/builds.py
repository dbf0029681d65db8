"""Builds that publish: tables of one build appear together, or not at all.

A build writes its tables to folders of its own, reads their fingerprints back, writes one manifest row a
table, and last of all one row that names the build. Readers take the newest name there and find every
table through that build's manifest, so that they see one build, whole. What did not change is carried
by reference: its row names the folder of the build that made it. A table whose source cannot be opened is
kept from the former build, with the error; if there is none, or a table fails a check, nothing is
published and the former build stays live.

Counts of a table (rows, rejects, values that did not parse, newest stamp, fingerprint) are observed while it is
written: its source is read once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.fingerprint import fingerprint, row_hash, totals
from ..operators.quality import QualityError
from ..operators.store import cut, forget
from .dialect import read_quoted
from .sinks import build_path, write_sorted
from .spec import Catalogue, Derived, TableSpec

MANIFEST = (
    "name string, action string, build string, path string, rows long, columns array<struct<name:string,type:string,source:string,description:string>>, "
    "sort array<string>, sources array<string>, nulls_added map<string,long>, present map<string,long>, rejected long, loaded timestamp, stamp string, bits long, total string, error string"
)


class BuildError(RuntimeError):
    """Nothing was published."""


@dataclass(frozen=True)
class Source:
    """What a table is made of: records as arrays of texts, and a stamp that changes when they do (null: unknown)."""

    records: DataFrame  # a column fields
    stamp: str | None = None
    header: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Limits:
    """Shares beyond which a table fails."""

    lost: float = 0.2  # of a column's values that do not parse
    rejected: float = 0.001  # of records of another width
    kept_rows: float = 0.9  # of the former build's rows, that must be there


@dataclass
class Outcome:
    """What became of a build: its name (null if nothing changed) and the errors of sources that were kept."""

    build: str | None
    kept: dict[str, str] = field(default_factory=dict)


def quoted_source(spark: SparkSession, spec: TableSpec, path: str, stamp: str | None = None, encoding: str = "utf-8", **limits: int) -> Source:
    """A table in quoted files, each with a header."""
    rows = read_quoted(spark, path, len(spec.columns), spec.separator, encoding, **limits)
    header = rows.filter("record = 1").select("fields").head()
    return Source(rows.filter("record > 1").select("fields"), stamp, tuple(header["fields"]) if header else ())


class Snapshot:
    """The tables of one build."""

    def __init__(self, spark: SparkSession, build: str, rows: list) -> None:
        self.spark, self.build, self.rows = spark, build, {r["name"]: r for r in rows}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.rows[name]["path"])

    def manifest(self) -> DataFrame:
        """One row a table."""
        return self.spark.createDataFrame(list(self.rows.values()), MANIFEST)


class Builds:
    """All builds below a folder that readers and writers share. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _rows(self, folder: str, schema: str) -> DataFrame | None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}") if there else None

    def live(self) -> Snapshot | None:
        """The newest published build; a build that has no row here does not exist for readers."""
        published = self._rows("live", "build string, manifest string")
        newest = published.agg(F.max_by(F.struct("build", "manifest"), "build").alias("b")).head()["b"] if published else None
        if newest is None:
            return None
        return Snapshot(self.spark, newest["build"], self._rows(f"manifests/{newest['manifest']}", MANIFEST).collect())  # a row a table

    def publish(
        self,
        catalogue: Catalogue,
        sources: dict[str, Callable[[], Source]],
        now: dt.datetime,
        code: str = "",
        limits: Limits = Limits(),
        flip: Callable[[str, str], None] | None = None,
    ) -> Outcome:
        """Build the tables of a catalogue. ``code`` stands for the makers: another one builds all tables anew. ``flip``
        is how a build is made live (tests stop before it)."""
        before = self.live()
        former = before.rows if before else {}
        build, attempt = f"{now:%Y%m%dT%H%M%SZ}", uuid.uuid4().hex[:8]  # what an attempt that failed has left is in no other's way
        folder = lambda name: build_path(self.root, f"{name}-{attempt}", now)
        if before and build <= before.build:
            raise BuildError(f"build {build} is not after the live build {before.build}")
        specs = [t for t in catalogue.tables.values() if isinstance(t, TableSpec)]
        same_code = bool(former) and all(r["stamp"] is None or r["stamp"].startswith(f"{code}|") for r in former.values())
        opened, kept = {}, {}
        for spec in specs:
            try:
                opened[spec.name] = sources[spec.name]()
            except Exception as e:  # noqa: BLE001 - a source that cannot be opened is data here
                if spec.name not in former:
                    raise BuildError(f"{spec.name} cannot be opened and was never published: {e}") from e
                kept[spec.name] = f"{type(e).__name__}: {e}"[:500]
        stamp = lambda name: f"{code}|{opened[name].stamp}"
        unchanged = {n for n, s in opened.items() if n in former and s.stamp is not None and former[n]["stamp"] == stamp(n)}
        if same_code and not opened.keys() - unchanged:
            return Outcome(None, kept)
        for spec in specs:  # every header first: drift fails before any table is written
            if spec.name in opened and opened[spec.name].header is not None:
                spec.check_header(list(opened[spec.name].header))
        rows: dict[str, dict] = {}
        for spec in specs:
            if spec.name in kept or spec.name in unchanged:
                rows[spec.name] = {**self._former(former, spec), "action": "kept" if spec.name in kept else "carried", "error": kept.get(spec.name)}
            else:
                row = self._source_table(spec, opened[spec.name], stamp(spec.name), folder(spec.name))
                self._check(row, former.get(spec.name), limits)
                rows[spec.name] = {**row, "action": "built", "build": build}
        for t in catalogue.tables.values():
            if isinstance(t, Derived) and all(s in rows for s in t.sources):
                own = t.name in former and same_code and all(rows[s]["action"] != "built" for s in t.sources)
                if own:
                    rows[t.name] = {**self._former(former, t), "action": "carried", "error": None}
                else:
                    rows[t.name] = {**self._derived_table(t, rows, f"{code}|", folder(t.name)), "action": "built", "build": build}
        for row in rows.values():
            if row["action"] == "built":
                self._verify(row)
        self.spark.createDataFrame([tuple(r.get(c) for c in self._columns()) for r in rows.values()], MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifests/{build}-{attempt}")
        (flip or self._flip)(build, f"{build}-{attempt}")
        return Outcome(build, kept)

    def _flip(self, build: str, manifest: str) -> None:
        """One row in one file, which Spark's committer moves into place once it is whole."""
        self.spark.createDataFrame([(build, manifest)], "build string, manifest string").coalesce(1).write.mode("append").parquet(f"{self.root}/live")

    @staticmethod
    def _former(former: dict, t: TableSpec | Derived) -> dict:
        """A table's row of the former build, with today's descriptions."""
        row = former[t.name].asDict(recursive=True)
        told = {c.lower(): text for c, text in t.descriptions.items()}
        return {**row, "columns": [(c["name"], c["type"], c["source"], told.get(c["name"].lower(), c["description"])) for c in row["columns"]]}

    @staticmethod
    def _columns() -> list[str]:
        return ["name", "action", "build", "path", "rows", "columns", "sort", "sources", "nulls_added", "present", "rejected", "loaded", "stamp", "bits", "total", "error"]

    def _write(self, df: DataFrame, path: str, sort: tuple[str, ...], loaded: str | None) -> dict:
        """df in a table's folder, and what was observed meanwhile. The sort draws samples of its input, so that what is
        observed is written once as it comes, in the pass over the source."""
        seen = Observation()
        metrics = [*totals(F.col("_h")), (F.max(loaded) if loaded else F.max(F.lit(None))).cast("timestamp").alias("loaded")]
        staged = cut(df.withColumn("_h", row_hash(df)).observe(seen, *metrics).drop("_h"))
        if sort:
            write_sorted(staged, path, sort)
        else:
            staged.write.option("compression", "zstd").parquet(path)
        forget(staged)
        got = seen.get
        return {"path": path, "rows": got["rows"], "bits": got["bits"], "total": str(got["total"]) if got["total"] is not None else None, "loaded": got["loaded"], "sort": list(sort)}

    def _source_table(self, spec: TableSpec, source: Source, stamp: str, path: str) -> dict:
        read, seen, names = Observation(), Observation(), list(spec.columns)
        whole = F.size("fields") == len(names)
        records = source.records.observe(read, F.count_if(~whole).alias("rejected")).filter(whole)
        raw = records.select(*(F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(names)))
        there = {c: F.nullif(F.col(c), F.lit("")).isNotNull() for c in names}
        counts = [m for c in names for m in (F.count_if(there[c]).alias(f"{c}__present"), F.count_if(there[c] & spec.typed(c).isNull()).alias(f"{c}__lost"))]
        typed = spec.select(raw.observe(seen, *counts))
        loaded = next((c.lower() for c in names if c == spec.loaded), None)
        row = self._write(typed, path, tuple(c.lower() for c in spec.sort), loaded)
        columns = [(n, t, c, spec.descriptions.get(c, "")) for (n, t), c in zip(typed.dtypes, names, strict=True)]
        lost, present = ({c.lower(): seen.get[f"{c}__{what}"] for c in names} for what in ("lost", "present"))
        return {**row, "name": spec.name, "columns": columns, "sources": [], "nulls_added": lost, "present": present, "rejected": read.get["rejected"], "stamp": stamp}

    def _derived_table(self, t: Derived, rows: dict[str, dict], stamp: str, path: str) -> dict:
        made = t.fn({s: self.spark.read.parquet(rows[s]["path"]) for s in t.sources})
        row = self._write(made, path, t.sort, None)
        loaded = [rows[s]["loaded"] for s in t.sources if rows[s]["loaded"]]
        columns = [(n, kind, "", t.descriptions.get(n, "")) for n, kind in made.dtypes]
        return {**row, "name": t.name, "columns": columns, "sources": list(t.sources), "nulls_added": {}, "present": {}, "rejected": 0, "loaded": max(loaded, default=None), "stamp": stamp}

    @staticmethod
    def _check(row: dict, former, limits: Limits) -> None:
        found = [f"{c}: {n} of {row['present'][c]} values do not parse" for c, n in row["nulls_added"].items() if n > row["present"][c] * limits.lost]
        if row["rejected"] > (row["rows"] + row["rejected"]) * limits.rejected:
            found.append(f"{row['rejected']} records of another width")
        if former and row["rows"] < former["rows"] * limits.kept_rows:
            found.append(f"{row['rows']} rows, {former['rows']} in the live build")
        if found:
            raise QualityError(f"{row['name']}: {'; '.join(found)}")

    def _verify(self, row: dict) -> None:
        """What is in the folder is what was written."""
        got = fingerprint(self.spark.read.parquet(row["path"])).head()
        if (got["rows"], got["bits"], None if got["total"] is None else str(got["total"])) != (row["rows"], row["bits"], row["total"]):
            raise BuildError(f"{row['name']} was not written whole")

