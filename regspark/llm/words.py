"""Words of many texts at once as 64-bit hashes, by array operations instead of one string a word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about most_bytes (one row at least), so that Python objects of few rows live at once."""
    for batch in batches:
        n = max(1, min(batch.num_rows, int(batch.num_rows * most_bytes / max(batch.nbytes, 1))))
        for k in range(0, batch.num_rows, n):
            yield batch.slice(k, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; in place where x is a scratch array of its own."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def code_points(texts: list[str], between: str) -> np.ndarray:
    """The code points of all texts, each followed by between."""
    return np.frombuffer((between.join(texts) + between).encode("utf-32-le", "surrogatepass"), "<u4") if texts else np.empty(0, np.uint32)


def span_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of consecutive points (none of them empty)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    own = points[place + np.repeat(starts, lengths)].astype(np.uint64)
    own |= place.astype(np.uint64) << np.uint64(21)
    return np.add.reduceat(mix(own), first)


def ascii_lower(points: np.ndarray) -> np.ndarray:
    """The points with A-Z lower-cased."""
    return np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)


def word_hashes(texts: list[str], is_word: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes and lengths of all words in order, number of words of each text): words are the longest runs of points
    that is_word accepts, after A-Z are lower-cased. A line end is no word character."""
    points = ascii_lower(code_points(texts, "\n"))
    inside = np.zeros(len(points) + 1, bool)
    inside[1:] = is_word(points)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    n = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return span_hashes(points, starts, ends - starts), ends - starts, n


def hash_of(word: str) -> int:
    """The hash that word_hashes gives an already lower-cased word."""
    points = code_points([word], "")
    return int(span_hashes(points, np.array([0]), np.array([len(points)]))[0])


def not_space(points: np.ndarray) -> np.ndarray:
    """[^\\x20\\x09-\\x0D]"""
    return (points != 0x20) & ((points < 0x09) | (points > 0x0D))


def alphanumeric(points: np.ndarray) -> np.ndarray:
    """[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"""
    return ((points >= 0x30) & (points <= 0x39)) | ((points >= 0x61) & (points <= 0x7A)) | (points >= 0x80)


class HashTable:
    """64-bit hash -> row number, by linear probing over arrays that are never more than half full."""

    def __init__(self) -> None:
        self.n = 0
        self.enlarge(16)

    def enlarge(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The rows, -1 where there is none."""
        slot = (hashes & self.mask).astype(np.int64)
        found = np.where(self.keys[slot] == hashes, self.rows[slot], -1)
        left = np.flatnonzero((found < 0) & (self.rows[slot] >= 0))  # another key is there: look on
        at = slot[left]
        while len(left):
            at = (at + 1) & int(self.mask)
            same = self.keys[at] == hashes[left]
            found[left] = np.where(same, self.rows[at], -1)
            more = ~same & (self.rows[at] >= 0)
            left, at = left[more], at[more]
        return found

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Give new, different hashes the next rows."""
        rows = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.n += len(hashes)
        if 2 * self.n > len(self.rows):
            there = self.rows >= 0
            old_keys, old_rows = self.keys[there], self.rows[there]
            self.enlarge((4 * self.n).bit_length())
            self.place(old_keys, old_rows)
        self.place(hashes, rows)
        return rows

    def place(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        at, left = (hashes & self.mask).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = self.rows[at] < 0
            self.rows[at[free]] = rows[left[free]]  # the last one that wants a place has it
            self.keys[at[free]] = hashes[left[free]]
            lost = self.rows[at] != rows[left]
            left, at = left[lost], (at[lost] + 1) & int(self.mask)
