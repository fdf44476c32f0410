"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 300_000
U64 = np.uint64
_STEP, _FIRST, _SECOND = U64(0x9E3779B97F4A7C15), U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_HALF = U64(33)


class _Words(dict):
    """64-bit hash of a word; bounded, kept per Python worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near numbers become far ones."""
    x = x ^ (x >> _HALF)
    x *= _FIRST
    x ^= x >> _HALF
    x *= _SECOND
    x ^= x >> _HALF
    return x


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words in order; A-Z lowered, words end at ASCII white space."""
    words = text.encode().lower().split() if text else []
    return np.fromiter(map(_WORDS.__getitem__, words), dtype=U64, count=len(words))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words.

    A text with fewer words is one shingle; one without words has none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    found = np.full(count, width, dtype=U64)
    for at in range(width):
        found = scramble((found + words[at : at + count]) * _STEP)
    return np.unique(found)


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that name the whole set."""
    value = xxhash.xxh3_128_intdigest(shingles.tobytes())
    high, low = value >> 64, value & (2**64 - 1)
    return high - 2**63, low - 2**63
