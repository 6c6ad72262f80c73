"""Hashed word features for linear models over whole texts."""

from __future__ import annotations

import re
import zlib

import numpy as np

#: Words of letters and digits, and runs of other signs.
TOKEN = re.compile(r"\w+|[^\w\s]+")
BITS = 18
SIZE = 1 << BITS
REMEMBERED = 200_000
_LOW = np.uint64(0xFFFFFFFF)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The word's number in the lower half, its shape's in the upper, in the worker.
_known: dict[str, int] = {}


def _shape(word: str) -> str:
    if not (word[0].isalnum() or word[0] == "_"):
        return word[:3]
    if word.isdigit():
        return "9"
    return "A" if word.isupper() and len(word) > 1 else "T" if word[0].isupper() else "a"


def _number(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) | zlib.crc32(_shape(word).encode("utf-8", "replace"), 1) << 32


def _mixed(*parts: np.ndarray) -> np.ndarray:
    h = parts[0] * _MIX
    for p in parts[1:]:
        h = (h ^ p ^ h >> np.uint64(29)) * _MIX
    return (h >> np.uint64(64 - BITS)).astype(np.uint32)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, values): word and shape n-grams of the whole text, hashed; values have unit length.

    Words and pairs of words, shapes of one to three words, and a mark for a word that repeats the one before.
    An empty text has no features.
    """
    words = TOKEN.findall(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    known = _known
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(words).difference(known):
        known[w] = _number(w)
    both = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    w, s = both & _LOW, both >> np.uint64(32)
    again = np.count_nonzero(w[1:] == w[:-1])
    found = np.concatenate([_mixed(w), _mixed(s), _mixed(w[:-1], w[1:]), _mixed(s[:-1], s[1:]), _mixed(s[:-2], s[1:-1], s[2:]), np.full(again, 1, np.uint32)])
    found.sort()
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    values = np.log1p(np.diff(first, append=len(found)))
    return found[first].astype(np.int64), values / np.sqrt(values @ values)
