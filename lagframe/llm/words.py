"""Words and word shingles as 64-bit numbers, in numpy inside tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D, after lower-casing A-Z:
exactly what ``bytes.lower().split()`` yields on UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import xxhash

MEMO_LIMIT = 1 << 18


class WordHashes(dict):
    """Word bytes -> 64-bit hash, remembering recent words within ``MEMO_LIMIT``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Order-sensitive hash of aligned columns of word hashes; differs by length."""
    h = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix(h)


def shingle_set(text: bytes, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of one text; with fewer words
    the whole sequence is the only shingle; without words the set is empty."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = hashes.of(words)
    n = min(width, len(h))
    return np.unique(sequence_hash([h[i : len(h) - n + 1 + i] for i in range(n)]))
