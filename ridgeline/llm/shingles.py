"""Sets of word shingles, vectorised over blocks of texts."""

from __future__ import annotations

import numpy as np

from ridgeline.llm.common import BASE, mix, prefix_hash, segment_hash

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word (run of bytes other than ASCII white space, A-Z lower-cased), in order."""
    low = _LOWER[data]
    word = ~_SPACE[low]
    first = word.copy()
    last = word.copy()
    if len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first[1:] &= ~word[:-1] | edge[1:-1]
        last[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, "right") - 1, segment_hash(prefix_hash(low), start, end)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every distinct shingle of ``size`` words, ordered by both.

    A row with fewer words, but some, has its whole sequence as one shingle.
    """
    row, word = word_hashes(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    begin = np.cumsum(n) - n
    full = np.flatnonzero(row[:-size + 1] == row[size - 1:]) if len(row) >= size else np.zeros(0, np.int64)
    rows, hashes = [row[full]], [np.full(len(full), size, np.uint64)]
    for j in range(size):
        hashes[0] = mix(hashes[0] * np.uint64(BASE) + word[full + j])
    for few in range(1, size):
        short = np.flatnonzero(n == few)
        h = np.full(len(short), few, np.uint64)
        for j in range(few):
            h = mix(h * np.uint64(BASE) + word[begin[short] + j])
        rows.append(short)
        hashes.append(h)
    r, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[keep], h[keep]
