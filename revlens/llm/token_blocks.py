"""Token ids of a table in range-coded block files.

The rows are dealt by ranges of their id and sorted, so the files, the
blocks of a file and the rows of a block follow ascending ids (nulls
first). A block holds whole rows, about ``block_ids`` ids, and decodes on
its own. Blocks are rows of Parquet files, written and read by Spark, so
any file system will do and a lost task is written again whole.

Cases: a null or empty text has the end id alone; equal ids keep all
their rows, in any order among themselves; extra columns are ignored; an
empty table gives no blocks. A damaged block raises ValueError. A row is
held whole in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import chunks, range_coder, textscan
from revlens.llm.stage import tuned
from revlens.session import new_stage_path

BLOCK_IDS = 1 << 20
_BLOCK = "part int, part_start bigint, n_ids bigint, directory binary, payload binary"


def _directory(ids: list[int | None], lengths: np.ndarray) -> bytes:
    """Row ids and lengths of a block; a null id is marked."""
    known = np.array([x is not None for x in ids], dtype=np.uint8)
    values = np.array([x if x is not None else 0 for x in ids], dtype="<i8")
    return zlib.compress(np.diff(values, prepend=0).tobytes() + lengths.astype("<i8").tobytes() + known.tobytes(), 1)


def _read_directory(packed: bytes) -> tuple[list[int | None], np.ndarray]:
    raw = zlib.decompress(packed)
    n = len(raw) // 17
    values = np.cumsum(np.frombuffer(raw, dtype="<i8", count=n))
    lengths = np.frombuffer(raw, dtype="<i8", count=n, offset=8 * n)
    known = raw[16 * n :]
    return [v if k else None for v, k in zip(values.tolist(), known)], lengths


def write_blocks(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", *,
    path: str | None = None, block_ids: int = BLOCK_IDS,
) -> str:
    """Write the ids of every text, each followed by ``end_id``; returns the folder."""
    tuned(docs)
    path = path or new_stage_path(docs.sparkSession, "token-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chunks.held(chunks.JsonTokenizer, tokenizer, chunks.spaced_words, False, True)
        vocab = max(coder.library.get_vocab_size(), end_id + 1)
        part, at = TaskContext.get().partitionId(), 0
        names, ids, lengths = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal names, ids, lengths, at
            flat, length = np.concatenate(ids), np.concatenate(lengths)
            columns = [[part], [at], [len(flat)], [_directory(names, length)], [range_coder.encode(flat, vocab)]]
            at += len(flat)
            names, ids, lengths = [], [], []
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "part_start", "n_ids", "directory", "payload"])

        held_ids = 0
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                flat, length = coder.rows(text)
                ends = np.cumsum(length)
                names += batch.column("_id").slice(text.first, text.rows).to_pylist()
                ids.append(np.insert(flat.astype(np.uint32, copy=False), ends, end_id))
                lengths.append(length + 1)
                held_ids += len(ids[-1])
                if held_ids >= block_ids:
                    yield flush()
                    held_ids = 0
        if names:
            yield flush()

    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
        .withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("_id", "_tie").drop("_tie").sortWithinPartitions("_id")
    )
    ordered.mapInArrow(run, _BLOCK).write.parquet(path)
    return path


def read_blocks(spark: SparkSession, path: str, id_col: str = "doc_id", *, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) for every row of the files.

    ``start`` counts all ids before the row. Only the totals of the parts,
    one number a written task, pass through the driver.
    """
    blocks = spark.read.schema(_BLOCK).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    begin, at = {}, 0
    for row in totals:
        begin[row["part"]] = at
        at += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, packed, payload in zip(*(batch.column(c) for c in ("part", "part_start", "directory", "payload"))):
                names, lengths = _read_directory(packed.as_py())
                ids = range_coder.decode(payload.as_py()).astype("<u4", copy=False)
                ends = np.cumsum(lengths)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("token block: directory does not fit")
                starts = begin[part.as_py()] + start.as_py() + ends - lengths
                rows = [ids[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                columns = {
                    id_col: pa.array(names, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = textscan.as_arrow_lists(ids.astype(np.int32), lengths, pa.int32())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return blocks.mapInArrow(run, schema)
