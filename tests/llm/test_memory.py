"""What a Python worker holds: small tables for few chunks, small batches of texts."""

import numpy as np
import pyarrow as pa

from revlens.llm import chunks
from revlens.llm.stage import tuned
from revlens.session import BATCH_BYTES

_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_chunk_table_grows_with_the_chunks_met():
    asked = []

    def encode(found):
        asked.extend(found)
        return [list(x) for x in found]

    table = chunks.ChunkTable(encode)
    assert len(table.keys) < 1 << 16
    rng = np.random.default_rng(1)
    data = np.arange(1, 241, dtype=np.uint8)
    for size in (50, 9_000, 30_000):  # past half of the first slots twice
        start = rng.integers(0, 230, size)
        end = start + rng.integers(1, 10, size)
        hashes = rng.permutation(np.arange(1, size + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        want = [data[s:e].tolist() for s, e in zip(start, end)]
        for _ in range(2):  # met again: nothing is asked for
            before = len(asked)
            ids, n = table.ids(data, start, end, hashes)
            if not _:
                first = {int(h): i for i, h in enumerate(hashes)}
                want = [table.flat[table.begin[k] : table.begin[k] + table.length[k]].tolist() for k in table._find(hashes)]
            assert n.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
        assert len(asked) == before and len(first) == size
    assert table.held == 30_000 == len(asked) and len(table.keys) == 1 << 16


def test_texts_go_to_the_workers_in_small_batches(spark):
    held = spark.conf.get(_KEY)
    try:
        spark.conf.set(_KEY, "64m")
        df = spark.range(4_000, numPartitions=1).selectExpr("repeat('x', 5000) AS text")

        def size(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

        found = [r.n for r in tuned(df).mapInArrow(size, "n bigint").collect()]
        assert sum(found) == 4_000 and max(found) * 5_000 < 2 * BATCH_BYTES
        spark.conf.set(_KEY, "1000000")  # a session's own bound is kept
        tuned(df)
        assert spark.conf.get(_KEY) == "1000000"
    finally:
        spark.conf.set(_KEY, held.rstrip("b"))
