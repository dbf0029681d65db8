"""Token ids of whole texts by the tokenizers library, with each distinct word encoded once per worker.

A byte-level BPE splits a text into words first and encodes each word by itself, so the ids of
a text are the joined ids of its words. Real corpora repeat words far more often than texts;
looking a word up costs a fraction of merging its bytes again. Words are found and looked up as
64-bit hashes of many texts at once (two words share one with a chance of 2**-64).
"""

from __future__ import annotations

import ctypes
import gc
import os
import re

import numpy as np
import pyarrow as pa

from .words import HashTable, code_points, span_hashes

#: Fixed value: the word pattern of this kind of vocabulary, in the form of the re module; its letters
#: are the Latin ones. word_starts() finds the same words.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
WORDS = re.compile(rf" ?[{LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+")
#: Texts with other characters (their classes differ between regex libraries) or with the special
#: token's string go to the library whole.
UNUSUAL = re.compile(r"[^\t-\r -~¡-±´-¸º»¿-ɏ‐-‧‰-⁞€]")
SPECIAL = "<|endoftext|>"

END, SPACE, OTHER_SPACE, LETTER, DIGIT, OTHER, ODD = range(7)


def kinds() -> np.ndarray:
    """The kind of each code point under 0x2100; all others are ODD. The one that ends a text is 0."""
    letter, out = re.compile(f"[{LETTERS}]"), np.full(0x2101, ODD, np.uint8)
    for c in map(chr, range(0x2100)):
        if not UNUSUAL.match(c):
            out[ord(c)] = SPACE if c == " " else OTHER_SPACE if c.isspace() else DIGIT if c in "0123456789" else LETTER if letter.match(c) else OTHER
    out[0] = END
    return out


def word_starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where a word of WORDS begins, or a text ends; the last kind is END."""
    before, after = np.concatenate([[END], kind[:-1]]), np.concatenate([kind[1:], [END]])
    space, space_before = (kind == SPACE) | (kind == OTHER_SPACE), (before == SPACE) | (before == OTHER_SPACE)
    solid, solid_after = kind >= LETTER, after >= LETTER
    # a space belongs to the solid run that follows; other white space in front of one stands alone
    start = (kind == END) | (solid & (kind != before) & (before != SPACE)) | (space & (~space_before | solid_after))
    for k in np.flatnonzero((points == 39) & start & (after == LETTER)):
        two = points[k + 1 : k + 3].tobytes().decode("utf-32-le")
        n = 1 if two[0] in "sdmt" else 2 if two in ("ll", "ve", "re") else 0
        if n:
            start[k + 1] = False
            start[k + 1 + n] = True
    return start


class Encoder:
    """encode(texts) -> one array of ids per text, the end id last. most_words bounds the memory of the
    word table (some 50 bytes each)."""

    def __init__(self, path: str, end_id: int, most_words: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.most_words, self.kinds = end_id, most_words, kinds()
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[k for token, k in vocabulary.items() if token[0] == "Ġ"]] = True
        self.clear()

    def clear(self) -> None:
        self.table = HashTable()
        self.ids, self.lengths, self.offsets = np.empty(0, np.uint32), np.empty(0, np.int32), np.empty(0, np.int64)

    def learn(self, new: list[str]) -> None:
        """Encode unseen words. Those of a space and other characters go in groups: each of their
        words starts where a token starts with a space."""
        grouped = np.fromiter((w[0] == " " and len(w) > 1 and w[1] > " " for w in new), bool, len(new))
        alone = [w for w, g in zip(new, grouped, strict=True) if not g]
        together = [w for w, g in zip(new, grouped, strict=True) if g]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        some = self.tokenizer.encode_batch_fast(["".join(together[k : k + 64]) for k in range(0, len(together), 64)], add_special_tokens=False)
        ids = np.array([i for own in found for i in own], np.uint32)
        more = np.concatenate([np.empty(0, np.uint32), *(np.array(e.ids, np.uint32) for e in some)])
        starts = np.flatnonzero(self.spaced[more])
        if len(starts) != len(together):
            raise ValueError("the vocabulary does not start words at spaces")
        lengths = np.empty(len(new), np.int32)
        lengths[~grouped] = [len(own) for own in found]
        lengths[grouped] = np.diff(np.append(starts, len(more)))
        offsets = np.empty(len(new), np.int64)
        offsets[~grouped] = len(self.ids) + np.cumsum(lengths[~grouped]) - lengths[~grouped]
        offsets[grouped] = len(self.ids) + len(ids) + starts
        self.offsets = np.concatenate([self.offsets, offsets])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids, more])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of some hundred thousand characters at most; see portions()."""
        odd = [SPECIAL in t or "\0" in t for t in texts]
        points = code_points(["" if o else t for t, o in zip(texts, odd, strict=True)], "\0")
        kind = self.kinds[np.minimum(points, 0x2100)]
        start = np.flatnonzero(word_starts(points, kind))
        is_end = kind[start] == END
        words = start[~is_end]
        size = np.diff(start, append=len(points))[~is_end]
        last = np.cumsum(~is_end)[is_end]  # words up to the end of each text
        if (kind == ODD).any():
            ends = start[is_end]
            for t in np.unique(np.searchsorted(ends, np.flatnonzero(kind == ODD))).tolist():
                odd[t] = True
        hashes = span_hashes(points, words, size)
        rows = self.table.find(hashes)
        unseen = np.flatnonzero(rows < 0)
        if len(unseen):
            new, at = np.unique(hashes[unseen], return_index=True)
            at = unseen[at]
            if self.table.n + len(new) > self.most_words:
                unseen = np.arange(len(hashes))
                new, at = np.unique(hashes, return_index=True)
                self.clear()
            whole = points.tobytes()
            self.learn([whole[4 * s : 4 * (s + n)].decode("utf-32-le") for s, n in zip(words[at].tolist(), size[at].tolist(), strict=True)])
            self.table.add(new)
            rows[unseen] = self.table.find(hashes[unseen])
        return self.joined(texts, odd, rows, last)

    def joined(self, texts: list[str], odd: list[bool], rows: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        lengths = self.lengths[rows].astype(np.int64)
        before = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(self.offsets[rows] - before, lengths) + np.arange(int(lengths.sum()))]
        cuts = np.concatenate([[0], np.append(before, len(ids))[last]]) if len(texts) else np.zeros(1, np.int64)
        flat = np.insert(ids, cuts[1:], self.end_id)
        cuts += np.arange(len(cuts))
        return [self.whole(t) if o else flat[a:b] for t, o, a, b in zip(texts, odd, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def whole(self, text: str) -> np.ndarray:
        return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, self.end_id], np.uint32)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One encoder per worker process; later tasks find its words again."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def forget() -> None:
    """Give the memory of word tables and of earlier tasks' arrays back to the system, for tasks of operators that
    need much themselves: a worker serves one task after another and else keeps what it has once had."""
    _encoders.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)


def portions(values: list[str], most_chars: int = 500_000):
    """(from, to) of consecutive texts with about most_chars together, to keep arrays small (some 60 bytes a character)."""
    start = size = 0
    for k, v in enumerate(values):
        size += len(v)
        if size >= most_chars:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(values):
        yield start, len(values)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
