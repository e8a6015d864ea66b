"""Vectorised word hashing over the raw UTF-8 bytes of a text column.

Words are runs of bytes outside the ASCII white space x20 and x09-x0D, with A-Z lower-cased.  Every word gets a
64-bit hash; 5-word shingles get the hash of their five words in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from rulestream.llm.common import mix64, slices, string_buffer

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.random.default_rng(20240502).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE = 5
CHUNK_BYTES = 1 << 20


@dataclass
class Words:
    """Words of consecutive rows: hash, byte range (in ``data``), and the first word of every row."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # n + 1 word offsets by row
    data: np.ndarray
    offsets: np.ndarray  # n + 1 byte offsets by row


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    inside = ~_SPACE[data]
    head = inside.copy()
    if n:
        head[1:] &= ~inside[:-1]
        at = offsets[:-1][offsets[:-1] < n]
        head[at] = inside[at]
    start = np.flatnonzero(head)
    tail = inside.copy()
    if n:
        tail[:-1] &= ~inside[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        tail[last] |= inside[last]
    end = np.flatnonzero(tail) + 1
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, np.zeros(len(offsets), np.int64), data, offsets)
    size = end - start
    place = np.cumprod(np.full(int(size.max()), _STEP, np.uint64))
    total = int(size.sum())
    base = np.cumsum(size) - size
    within = np.arange(total) - np.repeat(base, size)
    value = _BYTE[_LOWER[data[np.repeat(start, size) + within]]] * place[within]
    return Words(mix64(np.add.reduceat(value, base)), start, end, np.searchsorted(start, offsets), data, offsets)


def words_of(col: pa.Array):
    """Yield (first row, last row, Words) over slices of the column of bounded size; a row is never split."""
    data, offsets = string_buffer(col)
    for a, b in slices(len(col), np.diff(offsets), CHUNK_BYTES):
        yield a, b, _words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def shingles(w: Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row; fewer than five words: the whole sequence as one."""
    out = []
    h = w.hash
    n = len(h)
    if n >= SHINGLE:
        s = np.zeros(n - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            s += h[k:n - SHINGLE + 1 + k] * _PLACE[k]
        s = mix64(s)
    else:
        s = np.zeros(0, np.uint64)
    for r in range(len(w.first) - 1):
        a, b = int(w.first[r]), int(w.first[r + 1])
        if b - a >= SHINGLE:
            out.append(np.unique(s[a:b - SHINGLE + 1]))
        elif b > a:
            v = np.array([(b - a) * 0x51ED27 & 0xFFFFFFFF], np.uint64)
            for k in range(b - a):
                v = v + h[a + k:a + k + 1] * _PLACE[k + 8]
            out.append(mix64(v))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
