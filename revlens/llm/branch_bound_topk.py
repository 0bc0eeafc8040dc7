"""Exact top-k search by columnar branch and bound.

Candidates are held in blocks with one column a dimension (vertical
layout). Scores grow dimension block by dimension block; what the rest
can still add is bounded by the remaining mass of both vectors (the
product of their remaining lengths). Once the bound leaves few enough
candidates in the race against a query's k-th best score so far, the
survivors are compacted to a list of pairs and only these go on.

Blocks of queries meet blocks of candidates in a join on the candidate
block's number, so work is spread over (query block, candidate block)
and no task holds more than one of each. Each meeting returns its k best;
Spark merges them, with a limit in each task before the shuffle.

Components are floor(scale * x) and the score is their inner product:
whole numbers, computed exactly (in doubles while every sum stays below
2**53, else in 64-bit integers).

Cases: vectors null, empty, or with null or non-finite components take no
part; shorter vectors count as padded with zeros; ties go to the smaller
id; a row is never its own neighbour, but a row of equal id or content
is; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textscan
from revlens.llm.stage import materialize, tuned, with_uid

DIMS = 8
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
_CHUNK = 2048
_QUERIES = 256
_SPARSE = 0.2

_BLOCK = "part int, seq int, n int, dims int, rows binary, ids binary, cells binary"


def _pack(frame: DataFrame, size: int) -> DataFrame:
    """Rows (uid, id, vector of longs) as blocks, one column a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, many = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            dims = max(m.shape[1] for _, _, m in held)
            cells = np.concatenate([np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for _, _, m in held])
            rows, ids = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            small = np.int16 if len(cells) and np.abs(cells).max() < 1 << 15 else np.int64
            packed = np.ascontiguousarray(cells.T.astype(small))
            values = [part, seq, len(ids), dims, rows.tobytes(), ids.tobytes(), packed.tobytes()]
            kinds = [pa.int32()] * 4 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["part", "seq", "n", "dims", "rows", "ids", "cells"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                some = batch.slice(at, size)
                flat, offsets = textscan.from_arrow_lists(some.column("vector"))
                length = np.diff(offsets)
                matrix = np.zeros((some.num_rows, int(length.max())), dtype=np.int64)
                matrix[np.repeat(np.arange(some.num_rows), length), textscan.gather_ranges(np.zeros_like(length), length)] = flat
                uid, ids = (some.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("uid", "id"))
                while len(ids):
                    take = size - many
                    held.append((uid[:take], ids[:take], matrix[:take]))
                    many += len(held[-1][1])
                    uid, ids, matrix = uid[take:], ids[take:], matrix[take:]
                    if many == size:
                        yield block()
                        seq, held, many = seq + 1, [], 0
        if held:
            yield block()

    return frame.mapInArrow(run, _BLOCK)


def _unpack(n: int, dims: int, rows: bytes, ids: bytes, cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.int16 if len(cells) == 2 * n * dims else np.int64
    return np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(cells, kind).reshape(dims, n)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k first by score, then id."""
    order = np.lexsort((rows, ids, -score, query))
    q = query[order]
    first = np.searchsorted(q, q, side="left")
    return order[np.arange(len(q)) - first < k]


def _rest(cells: np.ndarray) -> np.ndarray:
    """Remaining length of every vector after each dimension block, a little rounded up."""
    squares = np.add.reduceat(cells.astype(np.float64) ** 2, np.arange(0, len(cells), DIMS), axis=0)
    left = np.concatenate([np.cumsum(squares[::-1], axis=0)[::-1][1:], np.zeros((1, cells.shape[1]))])
    return np.sqrt(left) * (1 + 1e-9)


def search_block(q_rows, q_ids, q_cells, c_rows, c_ids, c_cells, k: int):
    """(query position, candidate position, score): the k best of one block for each query."""
    dims = max(len(q_cells), len(c_cells))
    q_cells, c_cells = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (q_cells, c_cells))
    reach = float(np.abs(q_cells).max(initial=0)) * float(np.abs(c_cells).max(initial=0)) * dims
    kind = np.float64 if reach < 2**52 else np.int64
    q_all, c_all = q_cells.astype(kind), c_cells.astype(kind)
    q_rest, c_rest = _rest(q_cells), _rest(c_cells)
    blocks = range(0, dims, DIMS)
    out = []
    for q0 in range(0, len(q_ids), _QUERIES):
        q = slice(q0, min(q0 + _QUERIES, len(q_ids)))
        bound = np.full(q.stop - q.start, -np.inf)
        best = [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0, dtype=kind)]
        for c0 in range(0, len(c_ids), _CHUNK):
            c = slice(c0, min(c0 + _CHUNK, len(c_ids)))
            score = np.zeros((q.stop - q.start, c.stop - c.start), dtype=kind)
            pairs = None
            for b, d in enumerate(blocks):
                rows = slice(d, d + DIMS)
                if pairs is None:
                    score += q_all[rows, q].T @ c_all[rows, c]
                    if 2 * (d + DIMS) < dims and not np.isfinite(bound).all():
                        continue
                    alive = score + np.outer(q_rest[b, q], c_rest[b, c]) >= bound[:, None]
                    if d + DIMS >= dims or alive.mean() < _SPARSE:
                        pairs = np.nonzero(alive)
                        sums = score[pairs]
                else:
                    qi, ci = pairs
                    sums = sums + np.einsum("ij,ij->j", q_all[rows, q.start + qi], c_all[rows, c.start + ci])
                    on = sums + q_rest[b, q.start + qi] * c_rest[b, c.start + ci] >= bound[qi]
                    pairs, sums = (qi[on], ci[on]), sums[on]
            qi, ci = pairs[0], pairs[1] + c.start
            other = q_rows[q.start + qi] != c_rows[ci]
            best = [np.concatenate(x) for x in zip(best, (qi[other], ci[other], sums[other]))]
            keep = _best(best[0], best[2], c_ids[best[1]], c_rows[best[1]], k)
            best = [x[keep] for x in best]
            number = np.bincount(best[0], minlength=len(bound))
            last = np.cumsum(number) - 1
            full = number >= k
            bound[full] = best[2][last[full]]
        out.append((best[0] + q.start, best[1], best[2]))
    return [np.concatenate(x) for x in zip(*out)]


def _whole(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k best rows for each row where ``queries`` holds."""
    tuned(vectors)
    usable = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.col(id_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    known = materialize(
        with_uid(vectors.filter(usable).select(F.col(id_col).cast("bigint").alias("id"), queries.alias("asks"), _whole(vector_col, scale).alias("vector"))), "vectors"
    )
    candidates = materialize(_pack(known.select("uid", "id", "vector"), CANDIDATE_BLOCK), "candidates")
    asked = _pack(known.filter("asks").select("uid", "id", "vector"), QUERY_BLOCK)
    # consecutive numbers for the candidate blocks
    parts = candidates.groupBy("part").agg(F.count("*").alias("n_blocks"))
    before = F.coalesce(F.sum("n_blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = candidates.join(parts.select("part", before.alias("before")), "part").withColumn("block", F.col("before") + F.col("seq"))
    total = parts.agg(F.sum("n_blocks")).first()[0] or 0
    meets = asked.select(*(F.col(c).alias(f"q_{c}") for c in ("n", "dims", "rows", "ids", "cells")), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(total - 1, 0)).cast("bigint"))).alias("block"))
    pairs = meets.join(numbered.select("block", *(F.col(c).alias(f"c_{c}") for c in ("n", "dims", "rows", "ids", "cells"))), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, c = (_unpack(*(batch.column(f"{s}_{x}")[i].as_py() for x in ("n", "dims", "rows", "ids", "cells"))) for s in "qc")
                qi, ci, score = search_block(*q, *c, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q[0][qi], pa.int64()), pa.array(q[1][qi], pa.int64()), pa.array(c[1][ci], pa.int64()), pa.array(c[0][ci], pa.int64()), pa.array(score.astype(np.int64), pa.int64())],
                    names=["asker", "query_id", "vec_id", "uid", "score"],
                )

    found = pairs.drop("block").mapInArrow(run, "asker bigint, query_id bigint, vec_id bigint, uid bigint, score bigint")
    order = Window.partitionBy("asker").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
