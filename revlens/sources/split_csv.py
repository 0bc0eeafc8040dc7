"""Quoted CSV read in byte ranges (S1): one large file, many tasks.

Spark reads a CSV file with quoted newlines (``multiLine``) in one task,
as a newline alone does not end a record. Here the file is read as text
in byte ranges, which Spark deals to tasks for any store that it can open,
and the records are put together from the lines:

1. Every range counts its quotes. Their running sum tells whether a range
   begins inside a quoted field (an odd number of quotes before it).
2. With that, each range finds its records: a line begins a record if an even
   number of quotes stands before it. Lines before the range's first record
   and after its last whole one are fragments, at most two a range.
3. The fragments of a record that runs over range ends are joined.

Each record is then parsed by ``from_csv`` with the options of ``read_csv``, so
values come out the same (but CRLF within quotes stays CRLF, where the
reader of whole files makes LF of it if lines end so). As RFC 4180 has it, a field that holds a quote
must be quoted, and its quotes doubled; lines end with LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import new_stage_path, ship_package
from revlens.sources.csv import CSV_OPTIONS, normalise_missing

SPLIT_BYTES = 128 * 1024 * 1024
# Ranges whose state is sent to every task (one row of 40 bytes each).
MAX_RANGES = 2_000_000
# Records of a range are numbered below this.
ORDINALS = 33

_WHOLE, _TAIL, _HEAD = 0, 1, 2
_SCHEMA = "position bigint, kind int, begins boolean, record string"


def _lines(session: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, value): the lines, with the range that they begin in."""
    read = session.read.option("lineSep", "\n").text(path)
    return read.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", F.col("_metadata.file_path").alias("path"))


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, rank, inside): the ranges in file order, and whether each
    begins inside quotes. One row a range, so one task can order them."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"), F.first("path").alias("path"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    ranked = F.row_number().over(Window.orderBy("path", "start"))
    return counted.select("file", "start", ranked.cast("bigint").alias("rank"), (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one or more ranges, each in order, to records and fragments."""
    rank, ordinal, open_lines, tail, first = None, 0, [], False, False

    def row(record: str, kind: int) -> tuple:
        return (rank << ORDINALS) + ordinal, kind, first and ordinal == 0, record

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 4
        types = (pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["position", "kind", "begins", "record"])

    for batch in batches:
        value = batch.column("value")
        ranks, start, inside = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rank", "start", "inside"))
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2 == 1
        edge = np.flatnonzero(np.diff(ranks, prepend=-1) != 0).tolist()
        for at, to in zip(edge, [*edge[1:], batch.num_rows]):
            rows: list[tuple] = []
            if ranks[at] != rank:
                if open_lines:
                    rows.append(row("\n".join(open_lines), _TAIL if tail else _HEAD))
                rank, ordinal, open_lines = int(ranks[at]), 0, []
                tail, first = bool(inside[at]), start[at] == 0
                in_quotes = tail
            else:
                in_quotes = bool(open_lines)
            # the state before each line, and after it
            after = (np.cumsum(odd[at:to]) + in_quotes) % 2 == 1
            before = np.concatenate([[in_quotes], after[:-1]])
            alone = ~before & ~after
            at_line = 0
            while at_line < to - at:
                if alone[at_line] and not open_lines:
                    # a stretch of one-line records, handed on as it stands
                    stop = at_line + int(np.argmin(np.append(alone[at_line:], False)))
                    if rows:
                        yield batch_of(rows)
                        rows = []
                    n = stop - at_line
                    number = np.arange(ordinal, ordinal + n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((rank << ORDINALS) + number), pa.array(np.full(n, _WHOLE, dtype=np.int32)), pa.array((number == 0) & first), value.slice(at + at_line, n).cast(pa.string())],
                        names=["position", "kind", "begins", "record"],
                    )
                    ordinal += n
                    at_line = stop
                    continue
                open_lines.append(value[at + at_line].as_py())
                if not after[at_line]:
                    rows.append(row("\n".join(open_lines), _TAIL if tail else _WHOLE))
                    open_lines, tail, ordinal = [], False, ordinal + 1
                at_line += 1
            if rows:
                yield batch_of(rows)
    if open_lines:
        yield batch_of([row("\n".join(open_lines), _TAIL if tail else _HEAD)])


def _joined(fragments: DataFrame) -> DataFrame:
    """The records whose fragments lie in several ranges. Which fragments
    belong together is found on their places alone."""
    order = Window.orderBy("position", "kind")
    places = fragments.select("position", "kind").withColumn("of", F.sum((F.col("kind") == _HEAD).cast("int")).over(order))
    parts = fragments.join(places, ["position", "kind"]).groupBy("of").agg(
        F.array_sort(F.collect_list(F.struct("position", "kind", "record", "begins"))).alias("parts")
    )
    return parts.select(
        F.col("parts")[0]["position"].alias("position"), F.col("parts")[0]["begins"].alias("begins"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")
    )


def read_csv_ranges(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, *,
    missing_tokens: bool = True, split_bytes: int = SPLIT_BYTES, position: str | None = None,
) -> DataFrame:
    """S1 + S2 as ``read_csv``, from byte ranges of about ``split_bytes``.

    The records are written once, as Parquet under ``spark.checkpoint.dir``:
    that is the copy that later stages read. ``position`` names a column to
    add: a long that follows the order of files and rows.
    """
    ship_package(spark)
    # a session of its own, so that both scans see the same ranges
    session = spark.newSession()
    for key, value in (("maxPartitionBytes", split_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
        session.conf.set(f"spark.sql.files.{key}", value)
    lines = _lines(session, path)
    at = new_stage_path(spark, "csv-ranges")
    _ranges(lines).write.parquet(f"{at}/ranges")
    ranges = session.read.parquet(f"{at}/ranges")
    if (many := ranges.count()) > MAX_RANGES:
        raise ValueError(f"{many} ranges of {split_bytes} bytes: name larger ones by split_bytes")
    placed = lines.join(F.broadcast(ranges), ["file", "start"], "left").select(
        F.when(F.col("rank").isNull(), F.raise_error(F.lit("the files changed while they were read"))).otherwise(F.col("rank")).alias("rank"), "start", "inside", "value"
    )
    placed.mapInArrow(_records, _SCHEMA).write.parquet(f"{at}/records")
    written = spark.read.parquet(f"{at}/records")
    whole = written.where(F.col("kind") == _WHOLE).select("position", "begins", "record")
    records = whole.unionByName(_joined(written.where(F.col("kind") != _WHOLE)))
    # the first record of a file is its header; blank lines are no records
    text = F.regexp_replace("record", r"\r$", "")
    records = records.where(~F.col("begins")).select("position", text.alias("record")).where("record <> ''")
    if schema is None:
        schema = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path).schema
    kind = schema if isinstance(schema, str) else ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    parsed = records.select("position", F.from_csv("record", kind, options).alias("row"))
    columns = [F.col("position").alias(position)] if position else []
    out = parsed.select(*columns, "row.*")
    return normalise_missing(out) if missing_tokens else out
