"""Whole columns of text as NumPy arrays: Arrow buffers, spans of bytes, hashes of spans.

Text stays in the buffers that Spark hands over; no Python object is made per row or word.
Work on a buffer goes in pieces of about ``PIECE`` bytes, so that memory follows the batch and
not a multiple of it; one text, however long, is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
# Multiplier of the polynomial hash and its inverse modulo 2^64 (any odd number has one).
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ONE = np.ones(1, np.uint64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the row offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` units each; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def runs(member: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values; no run crosses a position in ``breaks``."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(member), bool)
    before[0] = False
    before[1:] = member[:-1]
    before[breaks[breaks < len(member)]] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty(len(member), bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[breaks[(breaks > 0) & (breaks <= len(member))] - 1] = False
    return starts, np.flatnonzero(member & ~after) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class SpanHasher:
    """Hashes of many spans of one array, from prefix sums of ``unit * base ** place``."""

    def __init__(self) -> None:
        self._power = self._inverse = _ONE

    def _grow(self, n: int) -> None:
        if len(self._power) < n:
            self._power, self._inverse = powers(_BASE, n), powers(_INVERSE, n)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of ``data``, from which ``spans`` takes any of its spans."""
        self._grow(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._power[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For ordered spans that do not overlap, in pieces; the result per span is the same."""
        out, first = np.empty(len(starts), np.uint64), 0
        while first < len(starts):
            low = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, low + PIECE, "right")))
            sums = self.sums(data[low : ends[last - 1]])
            out[first:last] = self.spans(sums, starts[first:last] - low, ends[first:last] - low)
            first = last
        return out


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark's longs."""
    return pa.array(x.view(np.int64))


def parity_sketch(row: np.ndarray, element: np.ndarray, rows: int, words: int) -> pa.Array:
    """Per row a bitmap as ``words`` longs; each element of the row's set flips one of the bits.

    Elements that two sets share flip the same bits, so the bitmaps of two sets differ in no more
    places than the sets differ in elements: a lossless filter for sets that are to differ little.
    """
    bits = 64 * words
    place = (mix(element ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(row * bits + place, minlength=rows * bits) & 1).astype(np.uint8).reshape(rows, bits)
    longs = np.packbits(odd, axis=1, bitorder="little").reshape(-1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * words), pa.array(longs))
