"""Repeated windows by a Burrows-Wheeler transform of many texts, in numpy.

Suffixes are sorted as far as the window length by prefix doubling. Intervals
of the transform that stand for the same string are extended backwards, breadth
first: the strings of l bytes are all seen before those of l + 1, so the longest
common prefixes of neighbouring suffixes come out by increasing value. An
interval is followed only if its end was not known yet, hence as many are
followed as there are suffixes; the search stops at the window length, and every
neighbour without a value by then shares at least a window.
"""

from __future__ import annotations

import numpy as np


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[:-by] = x[by:]
    return out


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``codes`` (uint8), sorted by their first ``depth`` codes."""
    n, h = len(codes), 1
    key = codes.astype(np.uint64)
    while h < 8:
        key = (key << np.uint64(8 * h)) | (_shifted(key, h) if h < n else np.uint64(0))
        h *= 2
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]])  # starts of groups of equal keys
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    while h < depth:
        alone = head & np.concatenate([head[1:], [True]])
        at = np.flatnonzero(~alone)  # places in the order whose group has more than one suffix
        if not len(at):
            break
        follow = order[at] + h
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = (rank[order[at]].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        sub = np.argsort(key, kind="stable")
        key, order[at] = key[sub], order[at][sub]
        head[at] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[at]] = np.maximum.accumulate(np.where(head, np.arange(n), 0))[at]
        h *= 2
    return order


def bounded_lcp(codes: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """lcp[i] of suffixes i - 1 and i in the order, where it is under ``limit``;
    else, or where a 0 code cuts the common prefix, ``limit``."""
    n = len(codes)
    bwt = codes[order - 1]
    by_code = np.argsort(bwt, kind="stable")
    step = np.empty(n, dtype=np.int64)  # the row of the suffix that starts one code earlier
    step[by_code] = np.arange(n)
    first = bwt[by_code]
    lcp = np.full(n + 1, limit, dtype=np.int32)
    lcp[0] = lcp[n] = 0
    lo, hi = np.zeros(1, dtype=np.int64), np.full(1, n, dtype=np.int64)
    for length in range(limit):
        single = hi - lo == 1
        one = lo[single]
        one = step[one[bwt[one] != 0]]
        many_lo, sizes = lo[~single], (hi - lo)[~single]
        ends = np.cumsum(sizes)
        row = np.arange(ends[-1] if len(ends) else 0) + np.repeat(many_lo - ends + sizes, sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        solid = bwt[row] != 0
        key = np.sort((owner[solid].astype(np.uint64) << np.uint64(32)) | step[row[solid]].astype(np.uint64))
        to = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        code, own = first[to], key >> np.uint64(32)
        head = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (own[1:] != own[:-1])])) if len(to) else to
        lo = np.concatenate([one, to[head]])
        hi = np.concatenate([one, to[np.concatenate([head[1:], [len(to)]]) - 1] if len(to) else to]) + 1
        new = lcp[hi] == limit
        lo, hi = lo[new], hi[new]
        lcp[hi] = length
        if not len(lo):
            break
    return lcp


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, whether each window of ``length`` bytes occurs again."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = int((sizes + 1).sum())
    if n >= 1 << 31:
        raise ValueError("split the texts: a transform holds at most 2 GiB")
    data = np.frombuffer(b"\x00".join([*texts, b""]), dtype=np.uint8) if texts else np.zeros(0, dtype=np.uint8)
    solid = np.ones(n, dtype=bool)
    solid[starts + sizes] = False
    present = np.flatnonzero(np.bincount(data[solid], minlength=256))
    if len(present) > 255:
        raise ValueError("more than 255 byte values; UTF-8 has 243")
    table = np.zeros(256, dtype=np.uint8)
    table[present] = np.arange(1, len(present) + 1)
    codes = np.where(solid, table[data], 0).astype(np.uint8)
    order = suffix_order(codes, length)
    lcp = bounded_lcp(codes, order, length)
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(n)  # bytes before the next separator
    whole = left[order] >= length
    both = whole[1:] & whole[:-1] & (lcp[1:n] == length)
    again = np.zeros(n, dtype=bool)
    again[order[1:][both]] = True
    again[order[:-1][both]] = True
    return [again[s:s + max(k - length + 1, 0)] for s, k in zip(starts.tolist(), sizes.tolist(), strict=True)]
