"""Substring deduplication with a count-min prefilter.

A window is ``size`` consecutive words of one row. Every word that lies
in a window whose word sequence starts anywhere else too is removed.

1. Each window is named by its smallest ``GRAM``-word hash (its anchor),
   so neighbouring windows share anchors and about one word in eleven is
   an anchor. Equal windows choose equal anchors. The partitions count
   anchor places in count-min sketches, which are merged: the estimate of
   a window's anchor is never below the window's own count.
2. A second pass keeps the windows whose anchor is estimated repeated and
   groups them exactly by hash. Those found once are struck from their
   row; nothing that repeats is lost, whatever the sketch's width.

Hot windows (a passage in a third of all rows) are combined in the map
tasks before the shuffle. The sketch is fixed in size; a corpus too large
for it only sends more windows to the exact pass.

Cases: a null or empty text has no words; a row shorter than a window
keeps all its words; equal rows are copies of each other, so all words of
those with a whole window go; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import sketch, textscan
from revlens.llm.stage import materialize, tuned, with_uid

SIZE = 35
GRAM = 15
SKETCH_BITS = 26
SKETCH_ROWS = 3


def _slide(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``size`` consecutive values."""
    width = 1
    while width * 2 <= size:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[: len(values) - (size - width)], values[size - width :]) if width < size else values


def _windows(text: textscan.Text, size: int, gram: int):
    """(words, starts of the windows within rows, word hashes, gram hashes, anchors of all windows)."""
    w = textscan.words(text)
    at = textscan.inside(w.first, size)
    if not len(at):
        return w, at, None, None, None
    hashes = textscan.span_hash(text.data, w.start, w.end)
    grams = textscan.window_hash(hashes, gram)
    return w, at, hashes, grams, _slide(grams, size - gram + 1, np.minimum)


def _anchor_keys(text: textscan.Text, size: int, gram: int) -> np.ndarray:
    """The hash of every place that some window of the slice chose as its anchor."""
    _, at, _, grams, anchors = _windows(text, size, gram)
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    span = size - gram + 1
    padded = np.zeros(len(anchors) + 2 * (span - 1), dtype=np.uint64)
    padded[at + span - 1] = anchors[at]
    return grams[_slide(padded, span, np.maximum) == grams]


def _kept(raw: bytes, removed: np.ndarray | None) -> tuple[int, list[bytes]]:
    found = raw.split()
    if removed is None:
        return 0, found
    return int(removed.sum()), [w for w, gone in zip(found, removed.tolist()) if not gone]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SIZE, gram: int = GRAM,
    bits: int = SKETCH_BITS, keep: list[str] | None = None, with_text: bool = False,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept_text], *keep) for every row.

    ``keep`` names more columns of ``docs`` to carry; ``with_text`` adds the
    kept words joined by one space.
    """
    tuned(docs)
    keep = keep or []
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(F.lit(0).alias("_"), *keep).alias("_keep"))

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in textscan.slices(batch.column("_text")):
            keys = _anchor_keys(text, size, gram)
            if len(keys):
                yield keys

    counts_of = sketch.Twice(bits, SKETCH_ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(sketch.build(source.select("_text"), keys_of, counts_of))
    out_text = "kept_text string" if with_text else ""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without a suspected window are finished here; the others carry their suspected windows."""
        for batch in batches:
            ids, texts, kept = batch.column("_id"), batch.column("_text"), batch.column("_keep")
            for text in textscan.slices(texts):
                w, at, hashes, _, anchors = _windows(text, size, gram)
                n = text.rows
                if len(at):
                    at = at[counts_of.repeated(shared.value, anchors[at])]
                row = np.searchsorted(w.first, at, side="right") - 1
                counts = np.bincount(row, minlength=n)
                windows = textscan.window_hash(hashes, size)[at] if len(at) else np.zeros(0, dtype=np.uint64)
                # the places, as runs of neighbouring windows
                opens = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0))
                runs = np.stack([at[opens] - w.first[row[opens]], np.diff(opens, append=len(at))], axis=1).astype(np.int32)
                whole = text.data.tobytes()
                sha, plain, packed, pending = [], [], [], counts > 0
                for i in range(n):
                    raw = whole[text.offsets[i] : text.offsets[i + 1]]
                    joined = None if pending[i] else b" ".join(raw.split())
                    sha.append(None if joined is None else hashlib.sha256(joined).hexdigest())
                    plain.append(joined.decode("utf-8", "replace") if with_text and joined is not None else None)
                    packed.append(zlib.compress(raw, 3) if joined is None else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(text.first, n), kept.slice(text.first, n), pa.array(w.counts, pa.int64()), pa.array(sha, pa.string()),
                        pa.array(plain, pa.string()), pa.array(packed, pa.binary()), textscan.as_arrow_lists(runs.reshape(-1), 2 * np.bincount(row[opens], minlength=n), pa.int32()),
                        textscan.as_arrow_lists(windows.view(np.int64), counts, pa.int64()),
                    ],
                    names=["_id", "_keep", "n_words", "kept_sha256", "kept_text", "_packed", "runs", "windows"],
                )

    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    kept_type = types["_keep"]
    schema = f"_id {types['_id']}, _keep {kept_type}, n_words bigint, kept_sha256 string, kept_text string, _packed binary, runs array<int>, windows array<bigint>"
    staged = materialize(with_uid(source.mapInArrow(scan, schema)), "windows")

    # Exact counts of the suspected windows, combined in the map tasks.
    places = staged.select("uid", F.posexplode("windows").alias("place", "window"))
    once = (
        places.groupBy("window").agg(F.count("*").alias("n"), F.min("uid").alias("uid"), F.min("place").alias("place"))
        .filter("n = 1").groupBy("uid").agg(F.collect_list("place").alias("single"))
    )
    pending = staged.filter("kept_sha256 is null").drop("windows", "kept_sha256", "kept_text").join(once, "uid", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, s_off = textscan.from_arrow_lists(batch.column("runs"))
            single, x_off = textscan.from_arrow_lists(batch.column("single"))
            n_words, removed, sha, left = batch.column("n_words").to_pylist(), [], [], []
            for i, value in enumerate(batch.column("_packed")):
                run = runs[s_off[i] : s_off[i + 1]].astype(np.int64)
                at = np.delete(textscan.gather_ranges(run[::2], run[1::2]), single[x_off[i] : x_off[i + 1]])
                edge = np.zeros(n_words[i] + 1, dtype=np.int32)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size, -1)
                gone, words = _kept(zlib.decompress(value.as_py()), np.cumsum(edge[:-1]) > 0)
                joined = b" ".join(words)
                removed.append(gone)
                sha.append(hashlib.sha256(joined).hexdigest())
                left.append(joined.decode("utf-8", "replace") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_keep"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(left, pa.string())],
                names=["_id", "_keep", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    done = pending.select("_id", "_keep", "n_words", "_packed", "runs", "single").mapInArrow(
        finish, f"_id {types['_id']}, _keep {kept_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
    clean = staged.filter("kept_sha256 is not null").select(
        "_id", "_keep", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256", "kept_text"
    )
    return clean.unionByName(done).select(
        F.col("_id").alias(id_col), "n_words", "n_removed", "kept_sha256", *(["kept_text"] if out_text else []),
        *(F.col(f"_keep.`{c}`").alias(c) for c in keep),
    )
