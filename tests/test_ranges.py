"""Reading in ranges gives what reading the whole text gives, wherever it is cut."""

import random

import pytest
from pyspark.sql import functions as F

from regspark.sources import dialect
from regspark.sources.ranges import entries, exits

MOST = 60
TEXTS = [
    '"a";"b";"c"\r\n"d";"e";"f"\r\n',
    '"A "B"\n\nC";"1";"2"\n"X";"1";"2"\n',  # a quote before a line end inside a value
    '"A";"1"\n"X";"1";"2"\n',  # a record cut short
    '"A";"1"\n7;"1";"2"\n',
    'x;y;z\r\n"q";"r\r\n";"s"\r\n',
    "\n\n\r\nx;y;z\n\n",
    '"long\n\n\n\n\nvalue\n";"1\n2";"3"\n"X";"1";"2"\n',
    '"never closes;\n' + "line;of;three\n" * 9 + '"X";"1";"2"\n',  # a stray quote swallows MOST characters at most
    'ab"c;"1";"2"\n"X";"1";"2"\n',
    '"a;";"b\r";"c"\r"d";"e";"f"\n',  # line ends of one character
]


def in_ranges(text, size, width=3, most=MOST):
    """By the steps of read_ranges, from pieces of about size characters that end at line ends."""
    pieces, held = [], ""
    for line in text.removesuffix("\n").split("\n"):
        held += line + "\n"
        if len(held) >= size:
            pieces.append(held)
            held = ""
    pieces += [held] if held else []
    units = [p + "".join(pieces[k + 1 :])[:most] for k, p in enumerate(pieces)]
    maps = [exits(u, len(p), width, ";", most) for u, p in zip(units, pieces, strict=True)]
    out = []
    for unit, piece, at in zip(units, pieces, entries([len(p) for p in pieces], maps), strict=True):
        while 0 <= at < len(piece):
            found, at = dialect.step(unit, at, width, ";", most)
            out += found
    return out


def test_every_cut_gives_the_same_records():
    for text in [*TEXTS, "".join(TEXTS)]:
        want = list(dialect.records(text, 3, most=MOST))
        for size in range(1, len(text) + 2):
            assert in_ranges(text, size) == want, (text, size)


def test_random_texts():
    rng = random.Random(8)
    for _ in range(400):
        text = "".join(rng.choices(['"', ";", "\n", "a", '";"', '"\n"', '"\n', "\r\n"], k=rng.randint(1, 60))) + "\n"
        want = list(dialect.records(text, 3, most=20))
        for size in (1, 5, 17):
            assert in_ranges(text, size, most=20) == want, (text, size)


def test_a_record_ends_within_the_cap():
    text = '"' + "x\n" * 40 + '";"1";"2"\n"X";"1";"2"\n'
    assert list(dialect.records(text, 3))[0] == ["x\n" * 40, "1", "2"]
    found = list(dialect.records(text, 3, most=50))
    assert len(found) == 42 and found[-1] == ["X", "1", "2"] and found[0] == ['"x']


@pytest.mark.parametrize("limits", [{}, {"range_chars": 300, "most": 100}, {"range_chars": 50, "most": 400, "most_broadcast": 0}])
def test_files(spark, tmp_path, limits):
    rng = random.Random(2)
    own = {}
    for name in ("a", "b"):
        rows = [[str(k), "".join(rng.choices('ab"é;\n', weights=[9, 9, 1, 1, 1, 4], k=rng.randrange(0, 30))), rng.choice(["x", "y\nz"])] for k in range(300)]
        text = "﻿" + "".join(";".join(f'"{v}"' for v in r) + rng.choice(["\n", "\r\n"]) for r in rows)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        own[name] = list(dialect.records(text[1:], 3, most=limits.get("most", dialect.MOST)))
    (tmp_path / "empty.csv").write_bytes(b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # also small blocks, smaller than a record may be
    try:
        df = dialect.read_quoted(spark, str(tmp_path / "*.csv"), 3, **limits)
        got = df.select(F.regexp_extract("path", r"(\w+)\.csv", 1).alias("name"), "record", "fields").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, want in own.items():
        assert [(r["record"], r["fields"]) for r in sorted(got, key=lambda r: r["record"]) if r["name"] == name] == list(enumerate(want, 1))
    assert any(len(r["fields"]) != 3 for r in got)  # rejects and what is read again are among them


def test_what_a_worker_holds_is_bounded(spark, tmp_path, monkeypatch):
    """Rows of whole ranges go to Python in small batches, records come back in small ones, numbered as before."""
    from regspark.operators.store import BATCHES
    from regspark.sources import ranges

    for name in BATCHES:
        spark.conf.unset(name)
    monkeypatch.setattr(ranges, "OUT_CHARS", 40)
    want = [[str(k), "é\n" * (k % 30), "z"] for k in range(300)]
    (tmp_path / "a.csv").write_bytes(("﻿" + "".join(";".join(f'"{v}"' for v in r) + "\n" for r in want)).encode())
    got = dialect.read_quoted(spark, str(tmp_path / "a.csv"), 3, range_chars=2000, most=400).collect()
    assert [(r["record"], r["fields"]) for r in sorted(got, key=lambda r: r["record"])] == list(enumerate(want, 1))
    assert all(int(spark.conf.get(name).rstrip("bB")) <= int(most) for name, most in BATCHES.items())
