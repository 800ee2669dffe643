"""Content-chosen anchors: a window of L bytes and its equals elsewhere pick the
same place inside them (minimizers), so equal windows meet by the anchor's hash."""

from __future__ import annotations

import numpy as np

from larch.llm.shingles import mix, stream

_BYTE = stream(256, 11)
_TURN = stream(64, 12) | np.uint64(1)
#: Positions take the low bits of a minimizer's key, so ties go to the leftmost.
PLACE_BITS = 24
_PLACE_MASK = np.uint64((1 << PLACE_BITS) - 1)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of data[i:i + k] for every i, by doubling the length."""
    h, size, step = _BYTE[data], 1, 0
    while size < k:
        shift = min(size, k - size)  # the last two halves may overlap
        h = h[:-shift] * _TURN[step] + h[shift:] if shift < len(h) else h[:0]
        size += shift
        step += 1
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i, by doubling the width."""
    size = 1
    while size < w:
        shift = min(size, w - size)
        x = np.minimum(x[:-shift], x[shift:]) if shift < len(x) else x[:0]
        size += shift
    return x


def cells(data: np.ndarray, doc: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash) of each run of windows with one anchor.

    ``data`` is the bytes of several documents, ``doc`` the document of each
    byte; windows of ``length`` bytes that cross documents are left out."""
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=np.uint64)
    assert len(data) <= 1 << PLACE_BITS
    h = gram_hashes(data, gram)
    key = (h & ~_PLACE_MASK) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, length - gram + 1) & _PLACE_MASK).astype(np.int64)
    valid = doc[:n] == doc[length - 1:]
    run = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:n] != doc[:n - 1])]))
    last = np.concatenate([run[1:], [n]]) - 1
    ok = valid[run]
    # windows that cross into the next document end a run early
    until = np.searchsorted(doc, doc[run[ok]], side="right") - length
    return run[ok], np.minimum(last[ok], until), h[anchor[run[ok]]]
