"""Count-min sketches built in the partitions and merged by cell range.

One task fills one fixed-size sketch. It leaves as compressed cell
ranges (shards), so merging is an ordinary shuffle on the shard number
and no task or driver ever holds more than one sketch. Every estimate is
at least the true count (up to the value at which cells saturate).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
SHARDS = 64

_SCHEMA = "shard int, cells binary"
_ARROW = pa.schema([("shard", pa.int32()), ("cells", pa.binary())])


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((keys * _SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64)


class Twice:
    """Counters that saturate at two, as two bit planes: seen, seen again.

    The kept sketch is the second plane: ``rows`` x 2**bits / 8 bytes.
    """

    def __init__(self, bits: int, rows: int = 2) -> None:
        self.bits, self.rows = bits, rows

    def new(self) -> np.ndarray:
        return np.zeros((self.rows, SHARDS, 2, (1 << self.bits) // SHARDS // 8), dtype=np.uint8)

    def add(self, table: np.ndarray, keys: np.ndarray) -> None:
        width = table.shape[3]
        for row in range(self.rows):
            at, n = np.unique(cells(keys, row, self.bits), return_counts=True)
            shard, byte, bit = at // (width * 8), (at >> 3) % width, np.left_shift(1, at & 7).astype(np.uint8)
            again = (n > 1) | (table[row, shard, 0, byte] & bit > 0)
            for plane, of in ((0, np.ones_like(again)), (1, again)):
                where = np.flatnonzero(of)
                if len(where):
                    place = at[where] >> 3
                    first = np.flatnonzero(np.diff(place, prepend=-1))
                    s, b = shard[where][first], byte[where][first]
                    table[row, s, plane, b] |= np.bitwise_or.reduceat(bit[where], first)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.reshape(2, -1), b.reshape(2, -1)
        return np.stack([a[0] | b[0], a[1] | b[1] | (a[0] & b[0])]).reshape(-1)

    def kept(self, part: np.ndarray) -> np.ndarray:
        return part.reshape(2, -1)[1]

    def repeated(self, sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """True where the estimated count is two or more."""
        out = np.ones(len(keys), dtype=bool)
        for row in range(self.rows):
            at = cells(keys, row, self.bits)
            out &= (sketch[row, at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


class Seen:
    """A set of keys as bits: false positives, no false negatives."""

    def __init__(self, bits: int, rows: int = 2) -> None:
        self.bits, self.rows = bits, rows

    def new(self) -> np.ndarray:
        return np.zeros((self.rows, SHARDS, (1 << self.bits) // SHARDS // 8), dtype=np.uint8)

    def add(self, table: np.ndarray, keys: np.ndarray) -> None:
        flat = table.reshape(self.rows, -1)
        for row in range(self.rows):
            at = cells(keys, row, self.bits)
            np.bitwise_or.at(flat[row], at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a | b

    def kept(self, part: np.ndarray) -> np.ndarray:
        return part

    def holds(self, sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for row in range(self.rows):
            at = cells(keys, row, self.bits)
            out &= (sketch[row, at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


class Levels:
    """Counters whose kept form is the rounded-up binary logarithm of the count.

    Cells hold up to 65,535 in a task and 2**32 - 1 when merged.
    """

    def __init__(self, bits: int, rows: int = 1) -> None:
        self.bits, self.rows = bits, rows

    def new(self) -> np.ndarray:
        return np.zeros((self.rows, SHARDS, (1 << self.bits) // SHARDS), dtype=np.uint32)

    def add(self, table: np.ndarray, keys: np.ndarray) -> None:
        flat = table.reshape(self.rows, -1)
        for row in range(self.rows):
            at, n = np.unique(cells(keys, row, self.bits), return_counts=True)
            flat[row, at] = np.minimum(flat[row, at].astype(np.int64) + n, 0xFFFFFFFF).astype(np.uint32)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = a.view(np.uint32).astype(np.int64) + b.view(np.uint32)
        return np.minimum(total, 0xFFFFFFFF).astype(np.uint32).view(np.uint8)

    def kept(self, part: np.ndarray) -> np.ndarray:
        return np.ceil(np.log2(part.view(np.uint32).astype(np.float64) + 1)).astype(np.uint8)

    def level(self, sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = sketch[0, cells(keys, 0, self.bits)]
        for row in range(1, self.rows):
            out = np.minimum(out, sketch[row, cells(keys, row, self.bits)])
        return out


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], kind: Twice | Seen | Levels) -> np.ndarray:
    """The merged sketch of all keys of ``df``, one line of bytes a row.

    What reaches the driver is the kept form alone: its size is fixed by
    the kind's bits and rows, whatever the input.
    """

    def row(shard: int, part: np.ndarray) -> pa.RecordBatch:
        packed = zlib.compress(part.tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([packed], pa.binary())], schema=_ARROW)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kind.new()
        for batch in batches:
            for keys in keys_of(batch):
                kind.add(table, keys)
        for i, part in enumerate(table.reshape(kind.rows * SHARDS, -1)):
            if part.any():
                yield row(i, part)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch["shard"].to_pylist(), batch["cells"]):
                part = np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.uint8)
                merged[i] = kind.merge(merged[i], part) if i in merged else part
        for i, part in merged.items():
            yield row(i, kind.kept(part))

    done = df.mapInArrow(partial, _SCHEMA).repartition(F.col("shard")).mapInArrow(merge, _SCHEMA)
    blank = kind.kept(kind.new().reshape(kind.rows * SHARDS, -1)[0].view(np.uint8))
    out = np.tile(blank, (kind.rows * SHARDS, 1))
    for r in done.collect():  # one job; an iterator would run a job a partition, one after another
        out[r["shard"]] = np.frombuffer(zlib.decompress(bytes(r["cells"])), dtype=np.uint8)
    return out.reshape(kind.rows, -1)
