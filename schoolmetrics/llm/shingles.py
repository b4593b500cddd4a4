"""Sets of hashed 5-word shingles of whole texts, computed batch by batch inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
#: Words remembered per task; beyond this the memory starts anew.
MEMO = 50_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser, which is public domain)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    start = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(start)


FACTORS = constants(WIDTH, 11) | np.uint64(1)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    A-Z is lower-cased and words are split at ASCII white space (space, tab to carriage return), which is what
    `bytes.lower` and `bytes.split` do. Fewer than five words make one shingle; no words make none.
    """
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(WIDTH, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += codes[i : n - width + 1 + i] * FACTORS[i]
    return np.unique(mix(total))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)
