"""What a job holds on disk: shuffles of ended writes, waves of an answer store."""

import os
import time

from pyspark.sql import functions as F

from revlens.operators.inference import generate
from revlens.session import new_stage_path, path_exists, run_root, stage_root, temporary_stages
from revlens.sources.stage import materialize, shuffles_dropped, write_stage

_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Echo:
    def generate(self, prompts):
        return [p[::-1] for p in prompts]


def _texts(spark, n, copies=1):
    rows = spark.range(n * copies).select((F.col("id") % n).alias("id"))
    words = F.array(*(F.sha2(F.concat_ws("-", F.col("id").cast("string"), F.lit(k)), 512) for k in range(40)))
    return rows.select("id", F.concat_ws(" ", words).alias("t"))


def _bytes(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(folder) for f in fs)


def test_a_written_stage_leaves_no_shuffle(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    count = lambda: sum(b.startswith("shuffle_") for b in blocks.getAllBlocks().mkString(" ").split())
    before, held = count(), spark.conf.get(_KEY, "false")
    out = materialize(_texts(spark, 500).groupBy("t").count(), "counts")
    for _ in range(50):  # they go in the background
        if (now := count()) <= before:
            break
        time.sleep(0.1)
    assert now <= before and out.count() == 500
    assert spark.conf.get(_KEY, "false") == held
    with shuffles_dropped(spark), shuffles_dropped(spark):
        assert spark.conf.get(_KEY) == "true"
    assert spark.conf.get(_KEY, "false") == held
    # a frame whose shuffle is gone can be read again
    frame = _texts(spark, 50).groupBy("t").count()
    with shuffles_dropped(spark):
        first = frame.count()
    assert frame.count() == first == 50


def test_temporary_stages_go_and_others_stay(spark):
    kept = write_stage(spark.range(3).toDF("a"), new_stage_path(spark, "kept"))
    with temporary_stages(spark):
        gone = write_stage(spark.range(3).toDF("a"), new_stage_path(spark, "gone"))
        with temporary_stages(spark):
            inner = write_stage(spark.range(3).toDF("a"), new_stage_path(spark, "inner"))
        assert path_exists(spark, gone) and not path_exists(spark, inner)
    after = write_stage(spark.range(3).toDF("a"), new_stage_path(spark, "after"))
    assert path_exists(spark, kept) and path_exists(spark, after) and not path_exists(spark, gone)


def test_answers_of_a_store_lie_on_disk_about_twice(spark, tmp_path):
    """The store and the answers given back; prompts and waves are gone."""
    stage_root(spark)
    df = _texts(spark, 300, copies=2)
    before = _bytes(run_root(spark))
    store = str(tmp_path / "store")
    options = {"answer_store": store, "model_id": "m"}
    out = generate(df, "t", "out", Echo, wave_prompts=40, **options)
    one = _bytes(store)
    assert _bytes(run_root(spark)) - before < 1.5 * one  # three copies and more before
    want = {(r.id, r.t, r.t[::-1]) for r in df.collect()}
    assert {tuple(r) for r in out.collect()} == want and out.count() == 600
    again = generate(df, "t", "out", Echo, **options)
    assert {tuple(r) for r in again.collect()} == want and again.count() == 600


def test_known_new_failed_and_missing_prompts_together(spark, tmp_path):
    class Some:
        def generate(self, prompts):
            if any(p.endswith("7") for p in prompts):
                raise RuntimeError("model down")
            return [p.upper() for p in prompts]

    rows = lambda a, b: spark.createDataFrame([(i, None if i % 5 == 0 else f"prompt {i // 2}") for i in range(a, b)], "id long, t string")
    store = str(tmp_path / "store")
    options = {"answer_store": store, "model_id": "m", "on_error": "null", "error_col": "err", "batch_size": 1}
    generate(rows(0, 60), "t", "out", Some, wave_prompts=7, **options).collect()
    for _ in range(2):
        got = generate(rows(30, 120), "t", "out", Some, wave_prompts=7, **options).collect()
        assert len(got) == 90
        for r in got:
            down = r.t is not None and r.t.endswith("7")
            assert r.out == (None if down or r.t is None else r.t.upper()) and (r.err is not None) == down
