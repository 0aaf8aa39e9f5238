"""Byte-level text helpers: whole Arrow columns at a time, with numpy.

Texts are treated as UTF-8 bytes. White space is ``[\\x20\\x09-\\x0D]``, so a word
never splits a multi-byte character. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes, or a single longer row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def parts(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and offsets of each slice of a column."""
    data, off = flat(column)
    for lo, hi in slices(off):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


#: Bytes that are neither ASCII letters or digits nor part of a longer character.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def words(data: np.ndarray, off: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, a longest run of bytes outside ``gaps``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~gaps[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[off[:-1][off[:-1] < len(data)]] = False
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(off, start, "right") - 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from running sums of a polynomial."""
    if not len(start):
        return np.zeros(0, np.uint64)
    return Sums(data).of(start, end)


class Sums:
    """Running sums over some bytes, from which any range has its hash at once."""

    def __init__(self, data: np.ndarray) -> None:
        steps = np.full(len(data) + 1, _BASE, np.uint64)
        steps[0] = 1
        power = np.cumprod(steps)
        steps[1:] = _INVERSE
        self.back = np.cumprod(steps)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * power[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(np.uint64))


def grams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words of one row, and where each run begins."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * _ODD + h[k:len(h) - n + 1 + k])
    at = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
    return out[at], at


def ranges(row: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each of ``n`` rows begin in a sorted row column."""
    return np.searchsorted(row, np.arange(n + 1))
