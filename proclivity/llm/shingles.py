"""Hashed words, shingles and minimum hashes of texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

from proclivity.llm.common import sole, words

STEP = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; emptied when it holds many."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) > self.MOST:
                self.clear()
            self[word] = value
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(
            map(self.__getitem__, found), np.uint64, len(found)
        )


@lru_cache(maxsize=1)
def _memo() -> WordHashes:
    return WordHashes()


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return sole(_memo).of(found)


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words."""
    count = len(hashes) - n + 1
    out = np.zeros(max(0, count), np.uint64)
    for k in range(n):
        out = mix(out * STEP + hashes[k : k + count])
    return out


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of five consecutive words; a text of fewer is
    one shingle, a text without words has none."""
    hashes = word_hashes(words(text))
    if not len(hashes):
        return hashes
    return np.unique(runs_of(hashes, min(SHINGLE, len(hashes))))
