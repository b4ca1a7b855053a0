"""64-bit hashes of the words of many texts at once.

A word is a longest run of letters, digits and ``_`` in lower case.  Its hash
is a mixed polynomial over its UTF-8 bytes.  Texts of ASCII characters only are
hashed with array operations over all their bytes; others word by word, with
the hashes of known words kept.
"""

from __future__ import annotations

import re

import numpy as np

WORDS = re.compile(r"\w+")
_BASE = 0x100000001B3D
_MASK = (1 << 64) - 1
_LOWER = np.array([ord(chr(i).lower()) if i < 128 else i for i in range(256)], np.uint64) + np.uint64(1)
_IS_WORD = np.array([i < 128 and (chr(i).isalnum() or chr(i) == "_") for i in range(256)])
_POWERS = np.array([1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(64, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            out = np.full(size, _BASE, np.uint64)
            out[0] = 1
            _POWERS = np.multiply.accumulate(out)
    return _POWERS


def _ascii(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer("\n".join(texts).encode(), np.uint8)
    word = _IS_WORD[raw]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    counts = np.diff(np.searchsorted(first, ends, "left"), prepend=0)
    if not len(first):
        return np.zeros(0, np.uint64), counts
    length = last - first
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    values = _LOWER[raw[word]] * _powers(int(length.max()))[at]
    return mix(np.add.reduceat(values, np.cumsum(length) - length)), counts


class _Known(dict):
    def __missing__(self, word: str) -> int:
        h, p = 0, 1
        for b in word.encode("utf-8", "surrogatepass"):
            h, p = (h + (b + 1) * p) & _MASK, p * _BASE & _MASK
        if len(self) >= 300_000:
            self.clear()
        self[word] = h
        return h


_KNOWN = _Known()


def _other(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    words = [WORDS.findall(t.lower()) for t in texts]
    flat = np.fromiter((h for w in words for h in map(_KNOWN.__getitem__, w)), np.uint64)
    return mix(flat), np.fromiter(map(len, words), np.int64, len(words))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, end to end, and the number of words of each text."""
    plain = np.fromiter((t.isascii() for t in texts), bool, len(texts))
    counts = np.zeros(len(texts), np.int64)
    groups = []
    with np.errstate(over="ignore"):
        for which, hashes in ((plain, _ascii), (~plain, _other)):
            docs = np.flatnonzero(which)
            if len(docs):
                ids, n = hashes([texts[i] for i in docs])
                counts[docs] = n
                groups.append((docs, ids, n))
    out = np.empty(int(counts.sum()), np.uint64)
    start = np.cumsum(counts) - counts
    for docs, ids, n in groups:
        out[np.repeat(start[docs] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, counts
