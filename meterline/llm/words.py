"""Words and their hashes for a run of texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95)

#: Bytes of words: digits, letters and all of UTF-8's upper half, capitals lowered; the rest is 0.
ALNUM = np.zeros(256, np.uint8)
ALNUM[48:58] = range(48, 58)
ALNUM[97:123] = range(97, 123)
ALNUM[65:91] = range(97, 123)
ALNUM[128:] = range(128, 256)

#: The same without digits.
LETTERS = ALNUM.copy()
LETTERS[48:58] = 0

#: All but white space; capitals lowered.
SOLID = np.arange(256, dtype=np.uint8)
SOLID[65:91] = range(97, 123)
SOLID[[9, 10, 11, 12, 13, 32]] = 0
SOLID[0] = 9  # a zero byte is part of a word; 9 is free


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts, each followed by a 0
    starts: np.ndarray  # of words in data
    ends: np.ndarray
    doc: np.ndarray  # of each word, as an index into the texts
    hashes: np.ndarray


def words_of(texts: Sequence[str], kinds: np.ndarray = ALNUM) -> Words:
    """All words of the texts in order. `kinds` maps a byte to what it counts as, 0 for a separator."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\0".join(coded) + b"\0", np.uint8)
    data = kinds[raw]
    data[ends_of := np.cumsum([len(c) + 1 for c in coded]) - 1] = 0
    solid = np.concatenate(([False], data != 0))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[0::2], edges[1::2]
    doc = np.searchsorted(ends_of, starts)
    if not len(starts):
        return Words(data, starts, ends, doc, np.zeros(0, np.uint64))
    lengths = ends - starts
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    inside = np.flatnonzero(data)
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(inside)) - np.repeat(first, lengths)
    sums = np.add.reduceat(data[inside].astype(np.uint64) * powers[within], first)
    return Words(data, starts, ends, doc, mix(sums ^ lengths.astype(np.uint64)))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of `size` words and the text each is from, in order. A shorter text is one run."""
    h, doc, n = words.hashes, words.doc, len(words.hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size if len(total) else 0):
        total = total * _STEP + h[j : n - size + 1 + j]
    whole = doc[: len(total)] == doc[size - 1 :] if len(total) else np.zeros(0, bool)
    docs, counts = np.unique(doc, return_counts=True)
    short = docs[counts < size]
    out_doc, out = doc[: len(total)][whole], mix(total[whole])
    if len(short):
        at = np.searchsorted(doc, short)
        extra = np.array(
            [_fold(h[a : a + c]) for a, c in zip(at, counts[counts < size], strict=True)], np.uint64
        )
        out_doc, out = np.concatenate((out_doc, short)), np.concatenate((out, mix(extra)))
        order = np.argsort(out_doc, kind="stable")
        out_doc, out = out_doc[order], out[order]
    return out_doc, out


def _fold(hashes: np.ndarray) -> int:
    total = len(hashes)
    for x in hashes.tolist():
        total = (total * int(_STEP) + x) % (1 << 64)
    return total
