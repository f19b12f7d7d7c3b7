"""Word-shingle sets of texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORD_CACHE = 200_000  # word hashes remembered per Python worker (memory bound only)
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                  0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULT[0]
    x = (x ^ (x >> np.uint64(29))) * _MULT[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct (signed) hashes of the ``width``-word shingles of a UTF-8 text.

    Words are maximal runs without the six ASCII white-space characters, A-Z
    lower-cased (``bytes.lower`` and ``bytes.split`` do exactly that). Fewer
    words than ``width`` make one shingle of all of them; no words, none.
    """
    words = (text or b"").lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=n)
    if n < width:  # a sequence of its own length: seeded apart from full shingles
        width, acc = n, np.full(1, n, dtype=np.uint64)
    else:
        acc = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        acc = _mix(acc + h[i:i + len(acc)] * _MULT[2] + np.uint64(i + 1))
    return np.unique(acc.view(np.int64))
