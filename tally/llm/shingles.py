"""Sets of word shingles as sorted 64-bit hashes, computed with numpy from Arrow text columns."""

from __future__ import annotations

import numpy as np

from tally.llm.arrowbytes import SEGMENT_BYTES, flat_bytes, row_groups
from tally.llm.wordbytes import hash_spans, mix

WINDOW_FACTORS = tuple(np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(16))
SHORT = np.uint64(0xA0761D6478BD642F)           # sets a text shorter than a shingle apart from shingles

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of a segment; no word runs over one of the row ``starts``."""
    b = LOWER[data]
    inside = ~SPACE[b]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    border = np.zeros(len(b) + 1, dtype=bool)   # a row begins here
    border[starts] = True
    border[-1] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    i, j = np.flatnonzero(first), np.flatnonzero(last)
    return hash_spans(b, i, j + 1), i


def long_pieces(data: np.ndarray):
    """Cut one long text at white space into pieces of about SEGMENT_BYTES."""
    p, n = 0, len(data)
    while p < n:
        q = min(n, p + SEGMENT_BYTES)
        while q < n and not SPACE[data[q]]:
            q += 1
        yield data[p:q]
        p = q


def sets(column, k: int):
    """Yield the set of each text of an Arrow string column: sorted distinct hashes of its k-word shingles.

    With fewer than k words the whole sequence is one shingle; without words the set is empty.
    """
    data, offsets = flat_bytes(column)
    for i, j in row_groups(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo > SEGMENT_BYTES and j == i + 1:
            w = np.concatenate([word_hashes(piece, np.zeros(1, np.int64))[0] for piece in long_pieces(data[lo:hi])])
            ends = np.array([len(w)])
        else:
            starts = offsets[i:j] - lo
            w, at = word_hashes(data[lo:hi], starts[starts < hi - lo])
            ends = np.searchsorted(at, np.append(starts[1:], hi - lo))
        n = max(0, len(w) - k + 1)
        windows = np.zeros(n, np.uint64)
        for x in range(k):
            windows += w[x:x + n] * WINDOW_FACTORS[x]
        windows = mix(windows)
        p = 0
        for e in ends.tolist():
            if e - p >= k:
                yield np.unique(windows[p:e - k + 1])
            elif e > p:
                factors = np.array(WINDOW_FACTORS[:e - p])
                whole = (w[p:e] * factors).sum(dtype=np.uint64, keepdims=True)
                yield mix(mix(whole ^ SHORT) + np.uint64(e - p))
            else:
                yield np.zeros(0, np.uint64)
            p = e


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    one = int(mix(s).sum(dtype=np.uint64)) if len(s) else 0
    two = int(np.bitwise_xor.reduce(mix(s ^ SHORT))) if len(s) else 0
    return one - (1 << 64 if one >= 1 << 63 else 0), two - (1 << 64 if two >= 1 << 63 else 0)
