"""Texts as sets of word shingles, a set being a sorted array of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 300_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (the finalizer of splitmix64, a public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd factors, one for each place in a shingle; others for shingles of another length.
_FACTORS = mix(np.arange(1, 129, dtype=np.uint64) * _ODD) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words (str or bytes), remembered."""

    def __missing__(self, word: bytes | str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Shingler:
    """Text to set; remembers the hashes of words, a bounded number of them."""

    def __init__(self, n: int = 5):
        self.n = n
        self.known = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # lower-cases A-Z, splits at the six blanks
        if not words:
            return np.empty(0, np.uint64)
        hashes = self.known.of(words)
        size = min(self.n, len(words))  # at most 64
        count = len(words) - size + 1
        found = hashes[:count] * _FACTORS[size]
        for i in range(1, size):
            found += hashes[i : i + count] * _FACTORS[size + i]
        return np.unique(mix(found))
