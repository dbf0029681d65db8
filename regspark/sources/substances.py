"""A list kept as a grid of cells: find the header, join continuation rows, mend registry numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..operators.rows import merge_continuations
from ..operators.store import cut
from .spec import SchemaDrift

#: Hyphens that look like the ASCII one; how a reference is written, white space squeezed.
HYPHENS = "‐‑‒–—―"
REFERENCE = r"(?i)\A\[? ?Ref\.? ?([0-9]+) ?\.? ?\]?\z"


def cell(k: int) -> Column:
    return F.nullif(squeeze(F.get("cells", F.lit(k))["text"]), F.lit(""))


def whole_number(c: Column) -> Column:
    """Decimal text without a fraction as an integer, else null."""
    d = c.try_cast("decimal(20,6)")
    return F.when(d == F.floor(d), d.try_cast("int"))


def registry_number(c: Column, is_date: Column) -> tuple[Column, Column]:
    """(number, reference): a cell that became a date is written back as the number it was, year, month in
    two digits and day as it is; look-alike hyphens are hyphens; 'Ref. 5', with or without brackets, is a
    reference and no number."""
    text = F.nullif(squeeze(c), F.lit(""))
    reference = F.nullif(F.regexp_extract(text, REFERENCE, 1), F.lit(""))
    day = F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))
    dated = F.concat(F.year(day).cast("string"), F.date_format(day, "-MM-"), F.dayofmonth(day).cast("string"))
    plain = F.when(reference.isNull(), F.translate(text, HYPHENS, "-" * len(HYPHENS)))
    return F.when(is_date & day.isNotNull(), dated).otherwise(plain), F.when(~is_date, reference.try_cast("int"))


def after_header(grid: DataFrame, sheet: str, width: int, least: int = 3) -> DataFrame:
    """The rows below each sheet's header, its first row with at least so many values. A sheet without one, and values
    beyond width columns, are drift."""
    filled = F.size(F.filter("cells", lambda c: F.coalesce(c["text"], F.lit("")) != ""))
    heads = grid.groupBy(sheet).agg(F.min(F.when(filled >= least, F.col("row_no"))).alias("_head"))
    bare = [str(r[sheet]) for r in heads.filter("_head is null").limit(10).collect()]
    if bare:
        raise SchemaDrift(f"no header in {', '.join(bare)}")
    rows = grid.join(heads, sheet).filter(F.col("row_no") > F.col("_head")).drop("_head")
    beyond = F.exists(F.slice("cells", F.lit(width + 1), F.greatest(F.size("cells") - width, F.lit(0))), lambda c: F.coalesce(c["text"], F.lit("")) != "")
    if not rows.filter(beyond).isEmpty():
        raise SchemaDrift(f"values beyond column {width}")
    return rows


def entries(grid: DataFrame, sheet: str, note_column: int, separator: str = " | ") -> DataFrame:
    """sheet, entry, first (row), notes, rows: a row with number (cell 0) or name (cell 1) starts an
    entry; the others add their note to it, and blank rows go."""
    rows = grid.withColumn("note", F.coalesce(cell(note_column), F.lit(""))).withColumn("starts", cell(0).isNotNull() | cell(1).isNotNull())
    return merge_continuations(rows.filter(F.col("starts") | (F.col("note") != "")), [sheet], "row_no", F.col("starts"), "note", separator)


def named_entries(grid: DataFrame, sheet: str, names: Sequence[str], note_column: int) -> DataFrame:
    """Entries with the cells of their first row under names. A row that continues no entry is drift."""
    found = cut(entries(grid, sheet, note_column))
    orphans = [f"row {r['first']} of {r[sheet]}" for r in found.filter("entry = 0").limit(10).collect()]
    if orphans:
        raise SchemaDrift(f"nothing to continue in {', '.join(orphans)}")
    first = grid.select(F.col(sheet), F.col("row_no").alias("first"), *(cell(k).alias(n) for k, n in enumerate(names)))
    return found.join(first, [sheet, "first"])
