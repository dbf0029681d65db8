"""Text as columns: accents, join keys, search words, white space, HTML entities. No Python runs on the executors."""

from __future__ import annotations

import html.entities
import json
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that a join key keeps as letters or digits.
KEY_LETTERS = {"º": "o", "ª": "a", "™": "tm", "²": "2", "³": "3"}
#: What search words leave out.
STOPWORDS = ("de", "da", "do", "das", "dos", "para", "com", "em", "e", "a", "o")
APOSTROPHES = "'’‘`´"
#: Windows-1252 in the range where Latin-1 has control characters.
CP1252 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


@cache
def _decomposed(form: str) -> dict[str, str]:
    """What characters are without marks, where that is something else. Syllables that are composed by rule
    have no entry: they consist of letters that no search word has."""
    own = (chr(p) for p in range(0x80, 0x110000) if unicodedata.decomposition(chr(p)) and unicodedata.category(chr(p))[0] != "M")
    bases = ((c, "".join(x for x in unicodedata.normalize(form, c) if unicodedata.category(x)[0] != "M")) for c in own)
    return {c: base for c, base in bases if base != c}


def _bases(form: str) -> tuple[str, str]:
    """Characters that decompose to one base character and marks, and those base characters."""
    pairs = [(c, base) for c, base in _decomposed(form).items() if len(base) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


CANONICAL, COMPATIBLE = _bases("NFD"), _bases("NFKD")


@cache
def _expansions() -> dict[str, str]:
    """Characters that decompose to several, of which some are letters or digits of ASCII (such as ㎏ or Ⅷ)."""
    return {c: base for c, base in _decomposed("NFKD").items() if len(base) > 1 and any(x.isascii() and x.isalnum() for x in base)}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: str | Column, compatible: bool = False) -> Column:
    """Base letters without marks; compatible also takes full-width and superscript forms apart."""
    return F.regexp_replace(F.translate(col(c), *(COMPATIBLE if compatible else CANONICAL)), r"\p{M}+", "")


def fold(c: str | Column) -> Column:
    """For comparisons that ignore accents and case; accents go first, as lower case can add marks."""
    return F.lower(strip_accents(c))


def squeeze(c: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col(c), r"(?U)\s+", " "), r"^ | $", "")


def trim_blank(c: str | Column) -> Column:
    """Without blanks (also the no-break one) at both ends; tabs and line ends stay."""
    return F.regexp_replace(col(c), r"\A\p{Zs}+|\p{Zs}+\z", "")


def strip_or_null(c: str | Column) -> Column:
    """Without white space at both ends; empty is null."""
    return F.nullif(F.regexp_replace(col(c), r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", ""), F.lit(""))


def digits(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def key(c: str | Column) -> Column:
    """A join key for names without an id: letters and digits only, no accents, lower case."""
    out = trim_blank(c)
    for a, b in KEY_LETTERS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(fold(out), "[^a-z0-9]", "")


def _taken_apart(c: Column) -> Column:
    """With characters that stand for several letters or digits spelled out. Most texts have none: ranges tell
    that fast, translate looks closely."""
    several = _expansions()
    low = "".join(c for c in several if ord(c) < 0x100)
    table = F.create_map(*(F.lit(x) for pair in several.items() for x in pair))
    apart = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    has = c.rlike(rf"[{low}\x{{100}}-\x{{10ffff}}]") & (F.length(F.translate(c, "".join(several), "")) < F.length(c))
    return F.when(has, apart).otherwise(c)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(c: str | Column) -> Column:
    """The different search words of a name, in order: at least two characters, no stopwords, then
    the joined forms of hyphenated compounds. What few texts need is asked for before it is done."""

    def split(out: Column) -> Column:
        compounds = F.transform(F.regexp_extract_all(out, F.lit("[a-z0-9]+(?:-[a-z0-9]+)+"), F.lit(0)), lambda w: F.replace(w, F.lit("-"), F.lit("")))
        each = F.split(out, "[^a-z0-9]+")
        each = F.array_distinct(F.when(out.contains("-"), F.concat(each, compounds)).otherwise(each))
        return F.filter(each, lambda w: (F.length(w) > 1) & ~w.isin(*STOPWORDS))

    plain = _let(col(c), lambda x: F.when(x.rlike(f"[{APOSTROPHES}]"), F.translate(x, APOSTROPHES, "")).otherwise(x))
    apart = _let(plain, _taken_apart)
    bare = _let(apart, lambda x: F.when(x.rlike(r"[^\x00-\x7f]"), strip_accents(x, compatible=True)).otherwise(x))
    return _let(F.lower(bare), split)


def decode_cp1252(c: str | Column) -> Column:
    """Bytes of Windows-1252 as text; its five undefined bytes pass through."""
    return F.translate(F.decode(col(c), "ISO-8859-1"), "".join(map(chr, range(0x80, 0xA0))), CP1252)


#: Numbers that stand for another character than their own, and those that stand for none.
MOVED = {0: "\ufffd", 0x0D: "\r", **{0x80 + k: c for k, c in enumerate(CP1252)}}
NO_CHARACTER = (*range(0x1, 0x9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0), *(plane + k for plane in range(0, 0x110000, 0x10000) for k in (0xFFFE, 0xFFFF)))
#: Names that browsers also know without a semicolon; none is the beginning of another.
WITHOUT_SEMICOLON = tuple(n for n in html.entities.html5 if not n.endswith(";"))


@cache
def _names() -> str:
    """HTML's names with what they stand for, by first letter, so that a search goes through few of them."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, value in html.entities.html5.items():
        by_letter.setdefault(name[0], {})[name] = value
    return json.dumps(by_letter)


def _named(name: Column) -> Column:
    table = F.from_json(F.lit(_names()), "map<string,map<string,string>>")  # a constant: Spark reads it once a query
    return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)


def _character(number: Column) -> Column:
    """The character that a number stands for: U+FFFD for half a pair and beyond Unicode."""
    four = lambda n: F.lpad(F.hex(n), 4, "0")
    over = number - 0x10000
    units = F.when(over < 0, four(number)).otherwise(F.concat(four(F.shiftright(over, 10) + 0xD800), four(over.bitwiseAND(0x3FF) + 0xDC00)))
    moved = F.create_map(*(F.lit(x) for pair in MOVED.items() for x in pair))
    own = F.when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd").when(number.isin(*NO_CHARACTER), "").otherwise(F.decode(F.unhex(units), "UTF-16BE"))
    return F.coalesce(F.try_element_at(moved, number), own)


def _numbered(digits: Column, base: int) -> Column:
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return _let(F.when(F.length(short) > 7, 0x110000).otherwise(F.conv(short, base, 10).cast("int")), _character)


def _after_ampersand(piece: Column) -> Column:
    """A text's piece from an ampersand (not included) to the next, decoded."""
    rest = lambda c, begin: F.substring(c, begin, F.length(c))

    def decoded(name: Column) -> Column:
        known = F.nullif(F.regexp_extract(name, rf"\A(?:{'|'.join(WITHOUT_SEMICOLON)})", 0), F.lit(""))
        begun = _let(known, lambda k: F.concat(_named(k), rest(name, F.length(k) + 1), F.lit(";")))
        value = F.when(name.rlike(r"\A[A-Za-z][A-Za-z0-9]*\z"), F.coalesce(_named(F.concat(name, F.lit(";"))), begun)).when(name.rlike(r"\A#[0-9]+\z"), _numbered(rest(name, F.lit(2)), 10)).when(name.rlike(r"\A#[xX][0-9a-fA-F]+\z"), _numbered(rest(name, F.lit(3)), 16))
        return F.coalesce(F.when(F.length(name) < F.length(piece), F.concat(value, rest(piece, F.length(name) + 2))), F.concat(F.lit("&"), piece))

    return _let(F.substring_index(piece, ";", 1), decoded)


def unescape(c: str | Column) -> Column:
    """HTML entities that end with a semicolon as characters, each once; the others stay. A name that is unknown but
    begins with a known one that needs no semicolon is decoded so far, as browsers do."""
    pieces = F.transform(F.split(col(c), "&"), lambda piece, k: F.when(k == 0, piece).otherwise(_after_ampersand(piece)))
    return F.when(col(c).contains("&"), F.array_join(pieces, "")).otherwise(col(c))
