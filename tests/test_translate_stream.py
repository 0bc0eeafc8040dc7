"""Translation of arriving reviews: each text is asked once."""

import os
import signal
import subprocess
import sys
import time

import pytest

from revlens.streaming.translate import REVIEWS_SCHEMA, start_translate_stream


class Noting:
    """Writes down every text it is asked."""

    def __init__(self, path):
        self.path = path

    def generate(self, prompts):
        with open(self.path, "a") as f:
            f.writelines(p + "\n" for p in prompts)
        return [f" [en] {p}\n" for p in prompts]


class Factory:
    def __init__(self, path):
        self.path = path

    def __call__(self):
        return Noting(self.path)


def write(spark, path, first, texts):
    rows = [(first + i, 0, t, "9") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, REVIEWS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, **options):
    query = start_translate_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), Factory(str(tmp_path / "asked")), template="{review}", **options)
    query.awaitTermination(180)
    assert query.exception() is None
    return {r.listing_id: r for r in spark.read.parquet(str(tmp_path / "out" / "translated")).collect()}


def asked(tmp_path):
    path = tmp_path / "asked"
    return sorted(path.read_text().split("\n")[:-1]) if path.exists() else []


def test_a_text_answered_before_is_not_asked_again(spark, tmp_path):
    write(spark, str(tmp_path / "in"), 0, ["hola", "adios", "hola", None, ""])
    rows = run(spark, tmp_path)
    assert asked(tmp_path) == ["", "adios", "hola"]
    assert rows[0].Review == rows[2].Review == "[en] hola" and rows[3].Review is None and rows[4].Review == "[en]"
    assert not any(r.reused for r in rows.values())
    # a later run of the stream: state comes back from the checkpoint
    write(spark, str(tmp_path / "in"), 10, ["hola", "nuevo", "adios"])
    rows = run(spark, tmp_path, max_files_per_trigger=1)
    assert asked(tmp_path) == ["", "adios", "hola", "nuevo"]
    assert {i: rows[i].reused for i in (10, 11, 12)} == {10: True, 11: False, 12: True} and len(rows) == 8


def test_an_answer_expires(spark, tmp_path):
    write(spark, str(tmp_path / "in"), 0, ["hola"])
    run(spark, tmp_path, ttl_hours=1 / 3600)
    time.sleep(2)
    write(spark, str(tmp_path / "in"), 5, ["hola"])
    rows = run(spark, tmp_path, ttl_hours=1 / 3600)
    assert asked(tmp_path) == ["hola", "hola"] and not rows[5].reused


def test_a_failure_is_told_and_not_kept(spark, tmp_path):
    class Down:
        def generate(self, prompts):
            raise RuntimeError("model down")

    write(spark, str(tmp_path / "in"), 0, ["hola"])
    query = start_translate_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), Down, template="{review}", on_error="null")
    query.awaitTermination(180)
    (row,) = spark.read.parquet(str(tmp_path / "out" / "translated")).collect()
    assert row.Review == "hola" and "model down" in row.answer_error
    write(spark, str(tmp_path / "in"), 1, ["hola"])
    rows = run(spark, tmp_path)
    assert rows[1].Review == "[en] hola" and asked(tmp_path) == ["hola"]


STREAM = """
import sys, time
sys.path.insert(0, {root!r})
from revlens.session import get_session
from revlens.streaming.translate import start_translate_stream
from tests.test_translate_stream import Factory
spark = get_session("local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {stage!r}}})
q = start_translate_stream(spark, {source!r}, {out!r}, Factory({asked!r}), template="{{review}}", available_now={now}, processing_time="500 milliseconds", max_files_per_trigger=1)
if {now}:
    q.awaitTermination(120)
    print("DONE", spark.read.parquet({out!r} + "/translated").count())
else:
    time.sleep(600)
"""


@pytest.mark.parametrize("files", [4])
def test_killed_and_started_again_each_text_is_asked_once(spark, tmp_path, files):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    source, out, noted = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "asked")
    for k in range(files):
        write(spark, source, 100 * k, [f"text {i}" for i in range(5 * k, 5 * k + 10)])

    def start(now):
        code = STREAM.format(root=root, stage=str(tmp_path / f"stage{now}"), source=source, out=out, asked=noted, now=now)
        return subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, start_new_session=True)

    first = start(False)
    commits = tmp_path / "out" / "_checkpoint" / "commits"
    until = time.time() + 120
    while time.time() < until and not (commits.exists() and [c for c in commits.iterdir() if c.name.isdigit()]):
        time.sleep(0.1)
    # everything is committed, or some of it: kill between batches
    while time.time() < until:
        offsets = {c.name for c in (tmp_path / "out" / "_checkpoint" / "offsets").iterdir() if c.name.isdigit()}
        done = {c.name for c in commits.iterdir() if c.name.isdigit()}
        if offsets == done:
            break
        time.sleep(0.02)
    os.killpg(first.pid, signal.SIGKILL)
    first.communicate(timeout=60)
    write(spark, source, 1000, [f"text {i}" for i in range(30)])
    second = start(True)
    said, errors = second.communicate(timeout=180)
    assert f"DONE {files * 10 + 30}" in said, errors[-3000:]
    seen = asked(tmp_path)
    assert sorted(set(seen)) == sorted(f"text {i}" for i in range(30))
    # a batch that began between the look and the kill may have asked once more
    assert len(seen) - 30 <= 10
