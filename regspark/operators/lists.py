"""Aggregates that give lists, the commonest value, or one word for two flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_set(c: str | Column, where: Column | None = None) -> Column:
    """The different values in order; never null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sort_array(F.collect_set(c if where is None else F.when(where, c)))


def aligned_lists(order: Sequence[str], values: Sequence[str]) -> dict[str, Column]:
    """name -> a list of each column, all in one order, null elements kept."""
    names = list(dict.fromkeys([*order, *values]))
    rows = F.sort_array(F.collect_list(F.struct(*names)))
    pick = lambda v: F.transform(rows, lambda r: r[v])
    return {v: pick(v) for v in values}


def commonest(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """The most frequent value of each key, ties to the smallest."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name or value))


def first_by(value: str, order: Sequence[str]) -> Column:
    """The value at the smallest order, over rows where value and order are known."""
    known = F.col(value).isNotNull()
    for c in order:
        known &= F.col(c).isNotNull()
    return F.min_by(F.when(known, F.col(value)), F.when(known, F.struct(*order, value)))


def tri_state(yes: Column, no: Column, words: tuple[str, str, str] = ("Sim", "Não", "Varia")) -> Column:
    y, n = F.coalesce(F.bool_or(yes), F.lit(False)), F.coalesce(F.bool_or(no), F.lit(False))
    return F.when(y & n, words[2]).when(y, words[0]).when(n, words[1])


def label_lists(parts: str | Column, labels: dict[str, str], other: str) -> dict[str, Column]:
    """From 'Label - A#B | Label - C': the label of a group and its items, for explode."""
    c = F.col(parts) if isinstance(parts, str) else parts
    groups = F.filter(F.transform(F.split(c, r"\|"), lambda g: F.trim(g)), lambda g: g != "")

    def one(g: Column) -> Column:
        at = F.instr(g, " - ")
        label = F.when(at > 0, F.trim(F.substring(g, F.lit(1), at - 1))).otherwise("")
        items = F.when(at > 0, F.substring(g, at + 3, F.length(g))).otherwise(g)
        kind = F.lit(other)
        for text, name in labels.items():
            kind = F.when(F.lower(label) == text, name).otherwise(kind)
        return F.struct(kind.alias("kind"), F.filter(F.transform(F.split(items, "#"), lambda i: F.trim(i)), lambda i: i != "").alias("items"))

    return {"groups": F.transform(groups, one)}


def from_right(item: str | Column, separator: str = " - ") -> dict[str, Column]:
    """'NAME - CITY - COUNTRY ; ID' read from the right; the name keeps its own separators."""
    c = F.col(item) if isinstance(item, str) else item
    code = F.regexp_extract(c, r";\s*([A-Za-z0-9]+)\s*$", 1)
    parts = F.split(F.regexp_replace(c, r"\s*;\s*[A-Za-z0-9]*\s*$", ""), separator)
    n = F.size(parts)
    return {
        "name": F.when(n >= 3, F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 2, F.lit(1))), separator)).otherwise(F.get(parts, F.lit(0))),
        "city": F.when(n >= 3, F.try_element_at(parts, F.lit(-2))),
        "country": F.when(n >= 2, F.try_element_at(parts, F.lit(-1))),
        "code": F.nullif(code, F.lit("")),
    }
