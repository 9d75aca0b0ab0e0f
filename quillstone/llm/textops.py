"""Vectorised work on the UTF-8 bytes of Arrow text columns: words, rolling hashes, shingles.

Everything runs over slices of bounded bytes, so the memory of a Python worker follows the slice
(or the one text that is larger), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text expanded at once.
SLICE_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240613)
BYTE_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to the slice size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of at most `most` bytes or one row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def prefix_hash(data: np.ndarray, table: np.ndarray = BYTE_TABLE, base: int = _BASE) -> np.ndarray:
    """c with c[j] - c[i] = sum of table[byte k] * base**k over i <= k < j."""
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data), base), out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray, inverse: int = _INVERSE) -> np.ndarray:
    """The hash of each span's bytes, wherever it stands."""
    return (c[end] - c[start]) * powers(len(c), inverse)[start]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that aren't ASCII white space."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the row of each word."""
    starts, ends, rows = word_spans(data, offsets)
    return mix(span_hash(prefix_hash(data), starts, ends) + U(1)), rows


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of k words; a row of 1 to k-1 words has one shingle of all its words."""
    h, rows = word_hashes(data, offsets)
    n = len(h)
    if not n:
        return h, rows
    out = np.zeros(n, np.uint64)
    full = np.zeros(n, bool)
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * U(0xD6E8FEB86659FD93) + h[j : n - k + 1 + j]
        out[: n - k + 1] = acc
        full[: n - k + 1] = rows[: n - k + 1] == rows[k - 1 :]
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    counts = np.diff(np.r_[start, n])
    for s, c in zip(start[counts < k].tolist(), counts[counts < k].tolist()):
        acc = np.full(1, c, np.uint64)  # an array, since scalars warn when they overflow
        for j in range(c):
            acc = acc * U(0xD6E8FEB86659FD93) + h[s + j]
        out[s], full[s] = acc[0], True
    return mix(out[full]), rows[full]
