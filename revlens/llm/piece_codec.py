"""SentencePiece encoding and decoding by distinct marked words.

When no piece holds the word marker anywhere but in its leading run, no
merge crosses the place where a marker follows another character. A text
is cut there; every distinct chunk is segmented once by the library and
its ids are joined back by position. If a vocabulary breaks the premise,
whole texts go to the library.

Decoding is the library's own ``decode`` of each row's ids.

Cases: a null or empty text gives the begin and end ids alone; extra
columns are ignored; equal rows give equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import chunks, textscan
from revlens.llm.stage import tuned

MARKER = "▁"


class PieceCodec:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.separable = not any(re.search(f"[^{MARKER}]{MARKER}", name) for name in names) and self._identity()
        self.marker = self.library.encode(" a") [:1]
        self.table = chunks.ChunkTable(self._encode)

    def _identity(self) -> bool:
        """Whether spaces and characters pass the normaliser unchanged."""
        probe = " a  b ﬁ\n c "
        return self.library.decode(self.library.encode(probe)) == probe

    def _encode(self, found: list[bytes]) -> list[list[int]]:
        """Every chunk begins with a space; the library puts its own marker there."""
        out = self.library.encode([x[1:].decode("utf-8", "replace") for x in found], num_threads=1)
        # to an empty text it adds none: a lone space is the marker by itself
        return [self.marker if x == b" " else ids for x, ids in zip(found, out)]

    def rows(self, text: textscan.Text) -> tuple[np.ndarray, np.ndarray]:
        """(ids without begin and end of all rows, number of ids of each row)."""
        if not self.separable:
            raw = text.data.tobytes()
            spans = zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist())
            every = self.library.encode([raw[a:b].decode("utf-8", "replace") for a, b in spans], num_threads=1)
            return np.array([x for ids in every for x in ids], dtype=np.int64), np.array([len(x) for x in every], dtype=np.int64)
        # The marker that the library puts before a text counts as a space.
        filled = np.diff(text.offsets) > 0
        data = np.insert(text.data, text.offsets[:-1][filled], np.uint8(32))
        shifted = text.offsets + np.concatenate([[0], np.cumsum(filled)])
        start, end, first = chunks.marked_words(textscan.Text(text.first, data, shifted))
        ids, per_chunk = self.table.ids(data, start, end, textscan.span_hash(data, start, end))
        return ids, chunks.row_lengths(first, per_chunk)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row.

    ``path`` is the model file, present on every machine. Ids include begin
    and end; their hash is over little-endian unsigned 32-bit integers.
    """
    tuned(docs)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = chunks.held(PieceCodec, path)
        begin, end = codec.library.bos_id(), codec.library.eos_id()
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                flat, lengths = codec.rows(text)
                at = np.concatenate([[0], np.cumsum(lengths)])
                ids_sha, text_sha, rows, decoded = [], [], [], []
                for i in range(text.rows):
                    ids = [begin, *flat[at[i] : at[i + 1]].tolist(), end]
                    said = codec.library.decode(ids)
                    ids_sha.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(said.encode()).hexdigest())
                    if with_ids:
                        rows.append(ids)
                        decoded.append(said)
                columns = {
                    "_id": batch.column("_id").slice(text.first, text.rows), "n_tokens": pa.array(lengths + 2, pa.int64()),
                    "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()),
                }
                if with_ids:
                    columns |= {"ids": pa.array(rows, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
