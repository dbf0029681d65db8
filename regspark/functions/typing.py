"""From strings to types; what does not parse is null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, digits, fold, trim_blank


def integer(c: str | Column) -> Column:
    """A whole number in digits; anything else is null."""
    return F.when(col(c).rlike(r"\A[+-]?[0-9]+\z"), col(c).try_cast("int"))


def flag(c: str | Column) -> Column:
    """S or 1 true, N or 0 false, all else null."""
    return F.when(col(c).isin("S", "1"), True).when(col(c).isin("N", "0"), False)


def yes_no(c: str | Column) -> Column:
    """Sim or Não in any spelling as S or N, else null."""
    return F.when(fold(trim_blank(c)) == "sim", "S").when(fold(trim_blank(c)) == "nao", "N")


def when_any(c: str | Column, formats: Sequence[str]) -> Column:
    """The first of the formats that parses, as a timestamp without zone."""
    return F.coalesce(*(F.try_to_timestamp(col(c), F.lit(f)) for f in formats)).cast("timestamp_ntz")


def placeholder_null(c: str | Column, mark: str = "-") -> Column:
    return F.nullif(F.nullif(trim_blank(c), F.lit(mark)), F.lit(""))


def cents(c: str | Column) -> Column:
    """'1.234,56*' as 123456; more decimals are cut, what does not fit an integer is null."""
    plain = F.replace(F.replace(F.regexp_replace(trim_blank(c), r"\*+\z", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return (plain.try_cast("decimal(26,6)") * 100).try_cast("int")


def marked(columns: Sequence[str]) -> Column:
    """Whether any of the columns ends with an asterisk."""
    return F.exists(F.array(*columns), lambda x: F.coalesce(x, F.lit("")).endswith("*"))


def prefix_key(c: str | Column, length: int = 13, keep: int = 9) -> Column:
    d = digits(c)
    return F.when(F.length(d) == length, F.substring(d, 1, keep))


def id_and_name(c: str | Column, id_digits: int = 14) -> tuple[Column, Column]:
    """'<digits> - <name>' in two columns; without an id the id is '' and the name is the whole."""
    pattern = rf"^([0-9]{{{id_digits}}}) - "
    return F.regexp_extract(col(c), pattern, 1), F.regexp_replace(col(c), pattern, "")


def surrogate_id(known: Column, prefix: str, *parts: Column) -> Column:
    """The known id, or one made of the parts; a null part leaves the id null."""
    joined = F.concat(*(x for k, p in enumerate(parts) for x in ([F.lit("|")] * (k > 0) + [p])))
    return F.coalesce(known, F.concat(F.lit(prefix), F.substring(F.md5(joined.cast("binary")), 1, 12)))


def epoch_ms(c: str | Column) -> Column:
    return F.timestamp_millis(col(c))


def http_date(c: str | Column, zone: str = "America/Sao_Paulo") -> tuple[Column, Column]:
    """An HTTP date ('Wed, 21 Oct 2015 07:28:00 GMT') as the zone's day, yyyyMMdd, and moment, dd/MM/yyyy HH:mm:ss;
    null if it is none."""
    # the name of the day says nothing that the date does not
    moment = F.try_to_timestamp(F.concat(F.regexp_extract(col(c), r"\A[A-Za-z]{3}, ([0-9]{2} [A-Za-z]{3} [0-9]{4} [0-9:]{8}) GMT\z", 1), F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z"))
    local = F.from_utc_timestamp(moment, zone)
    return F.date_format(local, "yyyyMMdd"), F.date_format(local, "dd/MM/yyyy HH:mm:ss")


def from_components(parts: str | Column) -> Column:
    """[year, month, day, hour, minute, second, nanosecond] as a timestamp; null if short or invalid."""
    p = col(parts)
    g = lambda k: F.get(p, F.lit(k))
    seconds = (g(5) + F.coalesce(g(6), F.lit(0)) / 1e9).cast("decimal(16,6)")
    return F.when(F.size(p) >= 6, F.try_make_timestamp_ntz(g(0), g(1), g(2), g(3), g(4), seconds))
