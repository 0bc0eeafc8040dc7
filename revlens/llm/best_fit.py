"""Bulk-synchronous best-fit packing of token pieces into sequences.

Sizes are whole numbers up to the capacity, so the order in which pieces
and gaps stand after a range sort is told by a count for each size and a
rank within the size. One superstep takes the largest size still open:

* sweep: its pieces go to the successor gap, the smallest one they fit;
* rank: the i-th piece of the size takes the i-th sequence of that gap
  size, so no two pieces want one place, and what is left over goes on to
  the next gap size; when no gap fits, just enough sequences are opened;
* update: the sequences filled move to their new gap size.

The sweep runs on counts (at most ``capacity`` numbers, however large the
corpus). Spark counts the sizes, ranks the pieces (each task ranks its
own, and the tasks' counts are summed in windows by size) and looks up
each piece's place. The pieces cross one shuffle, without their ids.

Cases: a null or empty text is one piece that holds the end id alone;
equal rows are packed one by one; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import chunks, textscan
from revlens.llm.stage import materialize, tuned

CAPACITY = 2048


def supersteps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Places of all pieces, from the number of pieces of each length.

    A line (length, first rank, first sequence, offset) holds for the ranks
    up to the next line of that length, in consecutive sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    lines, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                new = -(-left // (capacity // length))
                gaps[capacity] = [(opened, new)]
                opened, gap = opened + new, capacity
            updated = []
            ranges = gaps.pop(gap)
            while ranges and left:
                first, many = ranges.pop()
                used = min(many, left)
                lines.append((length, rank, first, capacity - gap))
                updated.append((first, used))
                if used < many:
                    ranges.append((first + used, many - used))
                rank, left = rank + used, left - used
            if ranges:
                gaps[gap] = ranges
            if gap > length:
                gaps.setdefault(gap - length, []).extend(updated)
    return lines


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """One row a piece, ranked among the pieces of its length in its task."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chunks.held(chunks.JsonTokenizer, tokenizer, chunks.bare_words, True, True)
        part, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                flat, n = coder.rows(text)
                flat, n = np.insert(flat.astype("<u4"), np.cumsum(n), np.uint32(end_id)), n + 1
                many = -(-n // capacity)
                row = np.repeat(np.arange(text.rows), many)
                piece = textscan.gather_ranges(np.zeros(len(many), dtype=np.int64), many)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                begin = (np.cumsum(n) - n)[row] + start
                raw = flat.tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(begin.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                sizes, at, same = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(length), dtype=np.int64)
                rank[order] = np.arange(len(length)) - np.repeat(at, same) + np.repeat(met[sizes], same)
                met[sizes] += same
                columns = {
                    "_id": batch.column("_id").slice(text.first, text.rows).take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array(np.full(len(row), part), pa.int32()), "rank": pa.array(rank, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = textscan.as_arrow_lists(flat.astype(np.int32), length, pa.int32())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint" + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", *,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for every piece."""
    tuned(docs)
    spark = docs.sparkSession
    pieces = materialize(cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces")
    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lines = np.array(sorted(supersteps(counts, capacity)), dtype=np.int64).reshape(-1, 4)
    places = spark.sparkContext.broadcast((lines[:, 0] * (1 << 44) + lines[:, 1], lines))

    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lines = places.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            line = lines[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(line[:, 2] + rank - line[:, 1], pa.int64()), pa.array(line[:, 3], pa.int64())],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank") + ", sequence_id bigint, offset bigint"
    placed = ranked.mapInArrow(run, schema)
    out = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if with_ids else [])
    return placed.select(F.col("_id").alias(id_col), *out)
