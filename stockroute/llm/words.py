"""Word hashing over whole Arrow batches with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D (all one-byte
characters, so UTF-8 needs no decoding). Texts are taken whole; a batch is
walked in slices of whole texts, so memory follows the slice (or the longest
single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GAPS = np.zeros(256, dtype=bool)
_GAPS[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {flag: _byte_values(flag) for flag in (False, True)}
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``.
    The table kept between calls covers a slice; a longer text gets its own."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 2 * SLICE_BYTES:
        _POWERS[:] = made
    return made[0], made[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1] \
        if offsets is not None and n else np.zeros(n + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, ends


def word_hashes(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(first, last, bounds, hashes)`` of a text column: text ``first + i``
    (below ``last``) has the word hashes ``hashes[bounds[i]:bounds[i + 1]]``.
    ``lower`` folds A-Z to a-z before hashing."""
    raw, ends = text_buffers(column)
    n, first = len(ends) - 1, 0
    values = _VALUES[lower]
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        data = raw[ends[first]:ends[last]]
        at = ends[first:last + 1] - ends[first]
        size = len(data)
        if not size:
            yield first, last, np.zeros(last - first + 1, dtype=np.int64), np.zeros(0, dtype=np.uint64)
            first = last
            continue
        inside = ~_GAPS[data]
        before = np.empty(size, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[at[:-1][at[:-1] < size]] = False
        after = np.empty(size, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[at[1:][at[1:] > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        stops = np.flatnonzero(inside & ~after) + 1
        power, inverse = _powers(size)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[data] * power[:size], out=total[1:])
        hashes = mix((total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
        yield first, last, np.searchsorted(starts, at), hashes
        first = last


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` word hashes (empty if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        out = (out ^ hashes[j:j + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix(out)
