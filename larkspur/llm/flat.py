"""Words of many texts as flat numpy arrays, for use inside Arrow tasks.

Words are runs of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  UTF-8 never uses these bytes inside a character, so
bytes and characters agree on the word borders.  A null text is an empty one.
Work goes on in slices of about a megabyte, so a task's memory depends on its
longest text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = np.uint64(0x9E3779B97F4A7C15)
BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
PLACE = mix((np.arange(64, dtype=np.uint64) + np.uint64(1001)) * _STEP) | np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


class Flat:
    """Texts of one slice: bytes, offsets, and the words found in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[filled] = solid[filled]
        ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[ends] = solid[ends]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.bounds = np.searchsorted(self.doc, np.arange(len(offsets)))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def span_hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each byte span; equal bytes give equal hashes wherever they stand."""
        power, inverse = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((BYTE_VALUE_LOWER if lower else BYTE_VALUE)[self.data] * power[: len(self.data)], out=total[1:])
        return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _STEP)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return self.span_hashes(self.start, self.end, lower)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``k`` words within one text, and the index of each first word."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += hashes[j : j + n] * PLACE[j]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return mix(total[at]), at


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit values; equal runs give equal hashes wherever they stand."""
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _STEP)


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Flat]]:
    """Cut a string column into (first row, last row + 1, words)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary()) if column.null_count else column.cast(pa.large_binary())
    if not len(column):
        return
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, Flat(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def list_column(parts: list[np.ndarray], dtype=np.int64) -> pa.Array:
    """Arrays, one per row, as an Arrow list column."""
    ends = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    flat = np.concatenate(parts).astype(dtype, copy=False) if parts else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
