"""Word hashes that Python workers remember, shared by the operators on n-grams."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import xxhash

#: Odd multipliers for the places of a word within an n-gram; any fixed odd numbers do.
PLACES = np.array([xxhash.xxh3_64_intdigest(f"place {k}") | 1 for k in range(16)], np.uint64)


_held: list[dict] = []


def hold(cache: dict) -> dict:
    """``cache``, after any other that was held is emptied: a worker that runs one operator after another keeps one large cache."""
    for other in _held:
        if other is not cache:
            other.clear()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)  # else the C library keeps what it held
    _held[:] = [cache]
    return cache


class WordHashes(dict):
    """64-bit hashes of words (bytes or str); forgets all when it holds ``most``."""

    def __init__(self, most: int = 1 << 17) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each number's bits over all 64."""
    x = (x ^ (x >> np.uint64(32))) * PLACES[13]
    x = (x ^ (x >> np.uint64(29))) * PLACES[14]
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` neighbours."""
    n = len(hashes) - width + 1
    total = hashes[:n] * PLACES[0]
    for k in range(1, width):
        total += hashes[k : k + n] * PLACES[k]
    return mixed(total)
