"""Vectorised scanning of Arrow text columns inside Spark tasks.

Words are maximal runs of bytes outside space and 0x09-0x0D, which is
the pattern ``[^\\x20\\x09-\\x0D]+``. Everything here works on the UTF-8
bytes of a slice of rows, so whole texts of any length are read without
building a Python string per word.

Hashes are 64-bit: two different words, shingles or windows share one
with probability about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at once (a longer row is handled alone).
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, base: int) -> None:
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._row(b, size) for b in (self.base, self.inv))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTES_POW = _Powers(0xD6E8FEB86659FD93)
_WORDS_POW = _Powers(0xA0761D6478BD642F)


class Text(NamedTuple):
    """A slice of rows: their bytes, and where each row begins (n + 1)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Word spans in ``Text.data``; ``first`` (n + 1) is each row's first word."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Text]:
    """Row slices of a string column of about ``limit`` bytes (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if not len(column):
        return
    large = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Text(at, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def lower_ascii(text: Text) -> Text:
    return text._replace(data=_LOWER[text.data])


def _row_starts(text: Text) -> np.ndarray:
    at = np.zeros(len(text.data) + 1, dtype=bool)
    at[text.offsets] = True
    return at


def words(text: Text) -> Words:
    filled = ~_SPACE[text.data]
    if not filled.any():
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(text.rows + 1, dtype=np.int64))
    cut = _row_starts(text)
    before = np.empty_like(filled)
    before[0] = False
    before[1:] = filled[:-1]
    after = np.empty_like(filled)
    after[-1] = False
    after[:-1] = filled[1:]
    start = np.flatnonzero(filled & (~before | cut[:-1]))
    end = np.flatnonzero(filled & (~after | cut[1:])) + 1
    return Words(start, end, np.searchsorted(start, text.offsets))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    up, down = _BYTES_POW.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def window_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` consecutive hashes (rows not told apart)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _WORDS_POW.upto(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n] + np.uint64(size))


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, from the rows' first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of the ``size``-word windows that lie within one row."""
    row = row_of(first)
    n = len(row) - size + 1
    return np.flatnonzero(row[:n] == row[size - 1 :]) if n > 0 else np.zeros(0, dtype=np.int64)


def gather_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), one after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    begin = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - begin, length)


def as_arrow_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def from_arrow_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, row offsets from 0) of a list column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=offsets[1:])
    return column.flatten().to_numpy(zero_copy_only=False), offsets
