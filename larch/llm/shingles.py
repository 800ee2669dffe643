"""Word shingles of texts as sorted 64-bit hashes with their counts, in numpy."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser (fixed public constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * _GAMMA)


_BYTE = stream(256, 1)
_PLACE = stream(4096, 2) | np.uint64(1)
_TURN = stream(SHINGLE_WORDS, 3) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = stream(2 * n, 2) | np.uint64(1)
    return _PLACE


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word (run of bytes that are not ASCII white space)."""
    data = np.frombuffer(raw, dtype=np.uint8)
    solid = ~_SPACE[data]
    if not solid.any():
        return np.zeros(0, dtype=np.uint64)
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = end - start
    at = np.flatnonzero(solid)
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(len(at)) - np.repeat(first, length)
    return mix(np.add.reduceat(_BYTE[data[at]] * _places(int(length.max()))[place], first) + length.astype(np.uint64))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs. A text of
    one to four words has one shingle, all its words."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    n = len(h)
    if not n:
        return h, np.zeros(0, dtype=np.int64)
    size = min(n, SHINGLE_WORDS)
    s = sum((h[k:n - size + 1 + k] * _TURN[k] for k in range(size)), np.full(n - size + 1, size, dtype=np.uint64))
    return np.unique(mix(s), return_counts=True)


def multiset_overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sum of minima and of maxima of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both
