"""The bucketed answer store and the window of calls in flight."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from revlens.operators import answers
from revlens.operators.inference import generate, model_tasks, score, wave_tasks
from revlens.operators.prompts import DEFAULT_PROMPTS
from revlens.operators.window import Busy, Gate, Windowed


class Upper:
    def generate(self, prompts):
        return [p.upper() for p in prompts]


def prompts(spark, n, first=0):
    return spark.createDataFrame([(i, f"prompt {i}") for i in range(first, first + n)], "id long, t string")


def stored(spark, path):
    return {r.prompt_sha256: r.answer for r in spark.read.parquet(*glob.glob(f"{path}/run=*/bucket=*")).collect()}


def ask(spark, n, path, first=0, **options):
    return {r.id: r.out for r in generate(prompts(spark, n, first), "t", "out", Upper, answer_store=path, model_id="m", **options).collect()}


def test_look_up_reads_only_the_buckets_it_needs(spark, tmp_path):
    path = str(tmp_path / "s")
    assert len(ask(spark, 600, path)) == 600
    few = prompts(spark, 3).select(F.sha2("t", 256).alias("prompt_sha256"))
    found = answers.look_up(spark, path, "m", few)
    assert found.where("known").count() == 3
    read = answers._read(spark, path, "m", answers._runs(spark, path), few)
    buckets = {r[0] for r in few.select(answers.part_of("prompt_sha256", answers.BUCKETS)).collect()}
    files = {f.split("bucket=")[1].split("/")[0] for f in read.inputFiles()}
    assert len(buckets) <= 3 and read.count() < 40
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and files
    # more prompts, more buckets
    more = answers._read(spark, path, "m", answers._runs(spark, path), prompts(spark, 60).select(F.sha2("t", 256).alias("prompt_sha256")))
    assert read.count() < more.count() < 600


def test_waves_are_written_by_range_and_read_once(spark, tmp_path):
    df = prompts(spark, 400).select(F.sha2("t", 256).alias("prompt_sha256"), "t")
    waves = answers.by_wave(df, 5)
    counts = [w.count() for w in waves]
    assert len(waves) == 5 and sum(counts) == 400 and min(counts) > 40
    assert len({f for w in waves for f in w.inputFiles()}) == sum(len(w.inputFiles()) for w in waves)
    assert answers.by_wave(df.limit(0), 0) == []


def test_waves_have_a_file_each_and_not_one_for_every_task(spark):
    df = prompts(spark, 400).repartition(8).select(F.sha2("t", 256).alias("prompt_sha256"), "t")
    waves = answers.by_wave(df, 6)
    assert sum(w.count() for w in waves) == 400 and max(len(w.inputFiles()) for w in waves) == 1
    # fewer waves than shuffle partitions: equal parts of them
    assert sum(len(w.inputFiles()) for w in answers.by_wave(df, 1)) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_wave_takes_few_jobs_and_few_tasks(spark, tmp_path):
    def jobs(n):
        spark.sparkContext.setJobGroup(f"waves-{n}", "")
        try:
            ask(spark, 60, str(tmp_path / f"s{n}"), wave_prompts=n)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"waves-{n}"))

    assert jobs(5) - jobs(30) <= 4 * (60 // 5 - 60 // 30)
    assert wave_tasks(spark, 1, 16) == spark.sparkContext.defaultParallelism
    assert wave_tasks(spark, 10**6, 16) == model_tasks(spark)


def test_second_run_asks_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "s")
    ask(spark, 50, path, wave_prompts=20)
    before = stored(spark, path)
    assert len(before) == 50
    got = ask(spark, 40, path, first=30)
    assert got == {i: f"PROMPT {i}" for i in range(30, 70)}
    new = max(glob.glob(f"{path}/run=*"), key=os.path.getmtime)
    assert spark.read.parquet(*glob.glob(f"{new}/bucket=*")).count() == 20


def test_compaction_keeps_every_answer(spark, tmp_path):
    path = str(tmp_path / "s")
    ask(spark, 60, path, wave_prompts=10)
    generate(prompts(spark, 5), "t", "out", Upper, answer_store=path, model_id="other").collect()
    # two runs that stored the same prompts, and one of the older form
    keyed = prompts(spark, 10).select(F.sha2("t", 256).alias("prompt_sha256"), F.upper("t").alias("answer"))
    answers.add(keyed, path, "m")
    keyed.withColumn("model", F.lit("m")).write.parquet(f"{path}/run=old")
    runs = len(glob.glob(f"{path}/run=*"))
    assert answers.compact(spark, path, buckets=16) == runs > 4
    assert [os.path.basename(f)[:8] for f in glob.glob(f"{path}/run=*")] == ["run=b16-"]
    rows = spark.read.parquet(*glob.glob(f"{path}/run=*/bucket=*"))
    assert rows.count() == 65 == rows.select("model", "prompt_sha256").distinct().count()
    assert ask(spark, 60, path) == {i: f"PROMPT {i}" for i in range(60)}
    assert answers.compact(spark, path, buckets=16) == 1  # nothing was asked anew


def test_failures_are_reported_and_not_stored(spark, tmp_path):
    class Some:
        def generate(self, prompts):
            if any(p.endswith(("7", "3")) for p in prompts):
                raise RuntimeError("model down")
            return [p.upper() for p in prompts]

    path = str(tmp_path / "s")
    rows = generate(prompts(spark, 50), "t", "out", Some, answer_store=path, model_id="m", on_error="null", error_col="err", wave_prompts=9, batch_size=4).collect()
    assert {r.id for r in rows if r.err} == {i for i in range(50) if i % 10 in (3, 7)}
    assert all(r.out == f"PROMPT {r.id}" for r in rows if not r.err) and len(stored(spark, path)) == 40


# --- calls in flight ------------------------------------------------------------


class Slow:
    """Counts its calls in flight."""

    def __init__(self, wait=0.05):
        self.wait, self.running, self.most, self.calls, self.lock = wait, 0, 0, 0, threading.Lock()

    def generate(self, prompts):
        with self.lock:
            self.running += 1
            self.calls += 1
            self.most = max(self.most, self.running)
        time.sleep(self.wait)
        with self.lock:
            self.running -= 1
        return [p.upper() for p in prompts]


def test_calls_in_flight_are_bounded_and_in_order():
    backend = Windowed(Slow, in_flight=10, retries=0)
    began = time.perf_counter()
    assert backend.generate([f"p{i}" for i in range(60)]) == [f"P{i}" for i in range(60)]
    assert 2 <= backend.backend.most <= 10
    assert time.perf_counter() - began < 60 * 0.05 / 3


def test_failures_stay_with_their_prompt_after_retries():
    class Flaky(Slow):
        def __init__(self):
            super().__init__(0.001)
            self.seen = {}

        def generate(self, prompts):
            (p,) = prompts
            self.seen[p] = self.seen.get(p, 0) + 1
            if p == "never":
                raise ConnectionError("refused")
            if p == "wrong":
                raise ValueError("bad prompt")
            if p == "late" and self.seen[p] < 3:
                raise Busy("later")
            return super().generate(prompts)

    backend = Windowed(Flaky, in_flight=4, retries=3, first_wait=0.01)
    found = dict(zip("a late wrong never z".split(), backend.generate_each("a late wrong never z".split())))
    assert found["a"] == ("A", None) and found["late"] == ("LATE", None) and found["z"] == ("Z", None)
    assert isinstance(found["wrong"][1], ValueError) and isinstance(found["never"][1], ConnectionError)
    assert backend.backend.seen == {"a": 1, "z": 1, "late": 3, "wrong": 1, "never": 4}


def test_a_refusal_halves_the_window_and_waits_for_all():
    now = [0.0]
    gate = Gate(8, first_wait=1.0, clock=lambda: now[0])
    for _ in range(3):
        gate.enter()
    gate.leave(True)
    gate.leave(True)  # under way together: one refusal
    assert gate.open == 4 and gate.resume_at == 1.0
    gate.leave(False)
    now[0] = 1.5
    gate.enter()
    gate.leave(True)
    assert 2 < gate.open < 2.5 and gate.resume_at == 2.5
    now[0] = 9.0
    for _ in range(100):
        gate.enter()
        gate.leave(False)
    assert gate.open == 8
    with pytest.raises(ValueError):
        Windowed(Slow, 0)


class SlowServer:
    def generate(self, prompts):
        time.sleep(0.1)
        return [str(len(p)) for p in prompts]


def test_a_job_keeps_many_calls_in_flight(spark):
    df = prompts(spark, 160)
    began = time.perf_counter()
    out = generate(df, "t", "out", SlowServer, concurrency=2, in_flight=20, retries=1).collect()
    took = time.perf_counter() - began
    assert len(out) == 160 and all(r.out == str(len(f"prompt {r.id}")) for r in out)
    assert took < 160 * 0.1 / 2  # one at a time, two tasks need 8 s


def test_scoring_with_a_window_gives_the_same(spark):
    df = spark.createDataFrame([(i, 0, f"review {i}", "5") for i in range(30)], "listing_id long, review_pos int, Review string, Review_Score string")
    cols = ["listing_id", "prompt_id", "response"]
    plain = sorted(map(tuple, score(df, SlowServer, DEFAULT_PROMPTS, batch_size=90).select(*cols).collect()))
    assert sorted(map(tuple, score(df, SlowServer, DEFAULT_PROMPTS, in_flight=16, retries=2).select(*cols).collect())) == plain


def test_model_stage_takes_a_resource_profile(spark):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
    seen = []

    def spy(self, func, schema, barrier=False, profile=None):
        seen.append(profile)
        return original(self, func, schema, barrier)

    kind = type(spark.range(0))
    original = kind.mapInPandas
    kind.mapInPandas = spy
    try:
        assert generate(prompts(spark, 4), "t", "out", Upper, profile=profile).count() == 4
    finally:
        kind.mapInPandas = original
    assert seen == [profile]
