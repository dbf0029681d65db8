"""Wide price files: BOM and semicolons, headers in many spellings, blocks of price columns by tax rate, two
files merged into one table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import typing as ty
from ..operators.merges import merge_by_precedence
from .spec import SchemaDrift


def normal_header(header: str) -> str:
    return " ".join(header.lstrip("﻿").upper().split()).replace(" %", "%")


def price_columns(block: str, rates: Sequence[str], exempt: str = "alc") -> list[str]:
    """The columns of a block: before taxes, then each rate without and with the exemption."""
    return [f"{block}_sem_impostos", f"{block}_0", *(f"{block}_{r}{e}" for r in rates for e in ("", f"_{exempt}"))]


def map_headers(headers: Iterable[str], fixed: dict[str, str], price: str, block: str, ignored: Iterable[str] = ()) -> dict[str, str]:
    """header as it stands -> our column; price is a pattern whose group 1 is the rate and whose group 2,
    if it matches, the exemption. A header that nothing knows is drift."""
    out, unknown = {}, []
    for h in headers:
        name = normal_header(h)
        m = re.fullmatch(price, name)
        if name in fixed:
            out[h] = fixed[name]
        elif m:
            out[h] = f"{block}_{m[1].replace(',', '_')}" + ("_alc" if m[2] else "")
        elif name not in ignored:
            unknown.append(h)
    if unknown or len(set(out.values())) < len(out):
        raise SchemaDrift(f"unknown or repeated headers: {unknown or sorted(out)}")
    return out


@dataclass(frozen=True)
class WideLayout:
    """What the headers of wide price files say: columns by name, blocks of prices by rate (written as in the file, such as
    "17,5"; the first one has no exemption), and columns with a year in their header."""

    fixed: dict[str, str]
    blocks: tuple[str, ...]
    rates: tuple[str, ...]
    untaxed: str = "SEM IMPOSTOS"
    exempt: str = "ALC"
    yearly: dict[str, str] = field(default_factory=dict)
    ignored: tuple[str, ...] = ()  # how such headers begin

    def price_columns(self, block: str) -> list[str]:
        return price_columns(block.lower(), [r.replace(",", "_") for r in self.rates[1:]], self.exempt.lower())

    def _price(self, block: str, what: str, header: str) -> str:
        if what == self.untaxed:
            return f"{block.lower()}_sem_impostos"
        exempt = what.endswith(f" {self.exempt}")
        rate = what.removesuffix(f" {self.exempt}").strip()
        name = f"{block.lower()}_{rate.removesuffix('%').replace(',', '_')}" + (f"_{self.exempt.lower()}" if exempt else "")
        if not rate.endswith("%") or name not in self.price_columns(block):
            raise SchemaDrift(f"a price that is not declared: {header!r}")
        return name

    def columns(self, headers: Iterable[str]) -> tuple[dict[str, str], dict[str, str]]:
        """(header -> our column, yearly column -> its year). A header that nothing knows, a rate that is not declared and
        a column that comes twice are drift."""
        out, years, unknown = {}, {}, []
        for header in headers:
            name = normal_header(header)
            first, _, rest = name.partition(" ")
            before, _, year = name.rpartition(" ")
            if name in self.fixed:
                out[header] = self.fixed[name]
            elif first in self.blocks:
                out[header] = self._price(first, rest, header)
            elif before in self.yearly and re.fullmatch("[0-9]{4}", year):
                out[header] = self.yearly[before]
                years[self.yearly[before]] = year
            elif not (self.ignored and name.startswith(self.ignored)):
                unknown.append(header)
        if unknown or len(set(out.values())) < len(out):
            raise SchemaDrift(f"unknown or repeated headers: {unknown or sorted(out.values())}")
        return out, years

    def read(self, spark: SparkSession, path: str, loaded: Column | None = None) -> DataFrame:
        """The file's rows as strings under our names, declared prices that it lacks as nulls, the years of yearly columns
        as <column>_year. A record with another number of fields is an error."""
        rows, years = _rows(spark, path, self.columns)
        lacking = [c for b in self.blocks for c in self.price_columns(b) if c not in rows.columns]
        more = {c: F.lit(None).cast("string") for c in lacking} | {f"{c}_year": F.lit(y) for c, y in years.items()}
        return rows.withColumns(more if loaded is None else more | {"publicado_em": loaded})


def _rows(spark: SparkSession, path: str, read_headers: Callable[[list[str]], tuple[dict[str, str], dict[str, str]]]) -> tuple[DataFrame, dict[str, str]]:
    reader = spark.read.option("sep", ";").option("quote", '"').option("escape", '"').option("multiLine", True).option("mode", "FAILFAST").option("header", True)
    headers = reader.csv(path).columns
    names, years = read_headers(headers)
    schema = ", ".join(f"`c{k}` string" for k in range(len(headers)))
    rows = reader.option("enforceSchema", True).schema(schema).csv(path)
    return rows.select(*(F.col(f"c{k}").alias(names[h]) for k, h in enumerate(headers) if h in names)), years


def read_wide(spark: SparkSession, path: str, fixed: dict[str, str], price: str, block: str, ignored: Iterable[str] = (), loaded: Column | None = None) -> DataFrame:
    """The file's rows as strings under our names; a record with another number of fields is an error."""
    out, _ = _rows(spark, path, lambda headers: (map_headers(headers, fixed, price, block, ignored), {}))
    return out if loaded is None else out.withColumn("publicado_em", loaded)


def priced(df: DataFrame, prices: Sequence[str], mark: str) -> DataFrame:
    """Prices in cents, and whether any price of the row is marked."""
    return df.withColumn(mark, ty.marked(prices)).withColumns({p: ty.cents(p) for p in prices})


def merged(first: DataFrame, second: DataFrame, key: str, shared: Sequence[str], first_only: Sequence[str], second_only: Sequence[str]) -> DataFrame:
    """One table of both: the first file's descriptions win, prices come from their own file."""
    return merge_by_precedence(first, second, key, shared, first_only, second_only)
