"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A batch is worked through in slices of a few megabytes, so that memory is bounded by the slice or by the longest single
text. No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a run of rows: `start`/`end` are byte places in `data`; row i has words first[i]:first[i+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes (uint64), by differences of a running polynomial."""
        n = len(self.start)
        out = np.empty(n, dtype=np.uint64)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(self.end, self.start[lo] + SLICE_BYTES, side="right")))
            at = self.start[lo]
            part = self.data[at : self.end[hi - 1]]
            up, down = powers(_BASE, len(part)), powers(_INVERSE, len(part))
            run = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up, out=run[1:])
            s, e = self.start[lo:hi] - at, self.end[lo:hi] - at
            out[lo:hi] = mixed((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            lo = hi
        return out

    def row_bytes(self, row: int) -> list[bytes]:
        a, b = self.first[row], self.first[row + 1]
        data = self.data
        return [data[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and row offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `limit` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of the rows that `offsets` cuts `data` into; no word spans two rows."""
    base = offsets[0]
    data, off = data[base : offsets[-1]], offsets - base
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(off), dtype=np.int64))
    solid = ~_BLANK[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    filled = off[:-1] < off[1:]
    heads, tails = off[:-1][filled], off[1:][filled] - 1
    begins[heads], ends[tails] = solid[heads], solid[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, off))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) for slices of a text column."""
    data, offsets = as_bytes(column)
    for lo, hi in slices(offsets, limit):
        yield lo, hi, split_words(data, offsets[lo : hi + 1])


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive values (len(h) - size + 1 of them, over row borders too)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64(0xC2B2AE3D27D4EB4F)
    if size <= 8:
        out = h[:n].copy()
        for k in range(1, size):
            out = out * base + h[k : k + n]
        return mixed(out)
    up, down = powers(int(base), len(h)), powers(pow(int(base), -1, 1 << 64), n)
    run = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up, out=run[1:])
    return mixed((run[size : size + n] - run[:n]) * down)
