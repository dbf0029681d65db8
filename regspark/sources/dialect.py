"""CSV in two odd dialects.

Quoted: values in quotes, quotes inside them not escaped, line ends allowed. A quote closes a value
that is not the record's last only before the separator, and the last only before a line end.
Where that reads over a line end after a quote, the stretch is read again without knowing the width: if
every record in it then is whole or cut short at a line end, that reading wins and the short ones are
rejects; else the first stands. A record that has no end within ``most`` characters, as after a stray quote, is
cut short at its line end too. Unquoted: one record a line, quotes are ordinary.

Where a record ends follows from where it begins and from the ``most`` characters after that alone. So a file is
read in ranges by many tasks (see ranges.py), although its format cannot be entered in the middle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CP1252

WINDOWS = {0x80 + k: c for k, c in enumerate(CP1252)}
#: Characters that a record has at most.
MOST = 4 << 20
LINE_END = re.compile(r"\r?\n|\r")
LAST_CLOSES = re.compile(r'"(?:\r?\n|\r)')
LAST_BARE = re.compile(r'([^"\r\n]*)(?:\r?\n|\r)')
OVER_LINE = re.compile(r'"\r?\n')


@lru_cache
def _patterns(separator: str) -> tuple[re.Pattern, re.Pattern]:
    """A bare value that is not the last; a value of any kind with what ends it."""
    s = re.escape(separator)
    return re.compile(rf'([^"\r\n{s}]*){s}'), re.compile(rf'"((?:[^"]|"(?!{s}|\r?\n|\r))*)"({s}|\r?\n|\r)|([^"\r\n{s}]*)({s}|\r?\n|\r)')


def _one(text: str, at: int, width: int, separator: str, limit: int) -> tuple[list[str], int] | None:
    """The record of the given width that begins at a place, and where it ends, before the limit."""
    bare, _ = _patterns(separator)
    fields = []
    for k in range(width):
        last = k == width - 1
        if text[at : at + 1] == '"' and at < limit:
            if last:
                m = LAST_CLOSES.search(text, at + 1, limit)
                close, end = (m.start(), m.end()) if m else (-1, 0)
            else:
                close = text.find('"' + separator, at + 1, limit)
                end = close + 1 + len(separator)
            if close < 0:
                return None
            fields.append(text[at + 1 : close])
            at = end
        else:
            m = (LAST_BARE if last else bare).match(text, at, limit)
            if not m:
                return None
            fields.append(m[1])
            at = m.end()
    return fields, at


def _blind(text: str, separator: str) -> list[list[str]] | None:
    """The records of a text of whatever width; None if it cannot be read so."""
    pattern = _patterns(separator)[1]
    records, fields, at = [], [], 0
    while at < len(text):
        m = pattern.match(text, at)
        if not m:
            return None
        fields.append(m[1] if m[1] is not None else m[3])
        if (m[2] if m[2] is not None else m[4]) != separator:
            records.append(fields)
            fields = []
        at = m.end()
    return records if not fields else None


def step(text: str, at: int, width: int, separator: str, most: int) -> tuple[list[list[str]], int]:
    """The record that begins at a place (several, where a stretch is read again; none of an empty line) and where
    the next one begins. The text ends with a line end."""
    if text[at] in "\r\n":
        return [], at + 1
    found = _one(text, at, width, separator, min(len(text), at + most))
    if not found:
        end = LINE_END.search(text, at)
        short = _blind(text[at : end.end()], separator)
        return [short[0] if short else text[at : end.start()].split(separator)], end.end()
    if any(OVER_LINE.search(f) for f in found[0]):
        span = _blind(text[at : found[1]], separator)
        if span and len(span) > 1 and all(len(r) <= width for r in span) and len(span[-1]) == width:
            return span, found[1]
    return [found[0]], found[1]


def records(text: str, width: int, separator: str = ";", most: int = MOST) -> Iterator[list[str]]:
    """The records of a text; those of another width are cut short at their line end."""
    at = 0
    text += "" if text.endswith(("\n", "\r")) else "\n"
    while at < len(text):
        found, at = step(text, at, width, separator, most)
        yield from found


def decoded(content: bytes, encoding: str, at_start: bool = True) -> str:
    """The text of a file, at its start without a mark. All bytes of Windows-1252 have a character: the
    five that are undefined there pass through."""
    text = content.decode("latin-1").translate(WINDOWS) if encoding == "cp1252" else content.decode(encoding)
    return text.removeprefix("\ufeff") if at_start else text


def read_quoted(spark: SparkSession, path: str, width: int, separator: str = ";", encoding: str = "utf-8", **limits: int) -> DataFrame:
    """path, record (from 1; the header is 1), fields; each file by as many tasks as it has ranges."""
    from .ranges import read_ranges

    return read_ranges(spark, path, width, separator, encoding, **limits)


def read_unquoted(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    line = F.regexp_replace("value", r"\r\z", "")
    return spark.read.option("lineSep", "\n").text(path).select(F.split(line, re.escape(separator), -1).alias("fields"))


def quoted_line(columns: list[str], separator: str = ";") -> Column:
    """A row in the quoted dialect, without its line end."""
    return F.concat_ws(separator, *(F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in columns))
