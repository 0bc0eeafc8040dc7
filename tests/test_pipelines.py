"""End-to-end stages on small CSV inputs."""

import glob

from pyspark.sql import functions as F

from revlens.operators.inference import LengthScorer, PrefixTranslator
from revlens.operators.prompts import Prompt
from revlens.plans.evaluate import evaluate
from revlens.plans.extract import run_extract
from revlens.plans.translate import run_translate
from revlens.sources.csv import read_csv

LISTINGS_CSV = '''id,name,address,reviews,review_scores
1,"flat,\nnice","{'country': 'Canada'}","[{'comments': 'Great ""place""\\nreally'}, {'comments': 'ok'}]","{'review_scores_value': 9.5}"
2,house,"{'country': 'Australia'}","[{'comments': 'fine'}]","{'review_scores_value': 8}"
3,room,"{'country': 'Canada'}","[{'comments': 'a'}, 5]","{'review_scores_value': 10}"
4,loft,"{'country': 'Canada'}",NA,"{'review_scores_value': 7}"
'''


def test_extract_stage_csv(spark, tmp_path):
    src = tmp_path / "listings.csv"
    src.write_text(LISTINGS_CSV, encoding="utf-8")
    out = str(tmp_path / "reviews")
    filtered = str(tmp_path / "filtered")
    result = run_extract(spark, str(src), out, ["Canada"], id_col="id", output_format="csv", filtered_path=filtered)
    assert result.rows_written == 3
    stage1 = {r.listing_id: r for r in read_csv(spark, filtered).collect()}
    assert set(stage1) == {"1", "3", "4"} and stage1["1"].name == "flat,\nnice" and stage1["1"].address == "{'country': 'Canada'}"
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(out + "/*.csv")))
    assert '"9,5"' in text
    back = read_csv(spark, out).orderBy("listing_id", "review_pos").collect()
    assert [(r.Review, r.Review_Score) for r in back] == [
        ('Great "place"\nreally', "9,5"),
        ("ok", "9,5"),
        ("a", "10"),
    ]
    assert [r.listing_id for r in result.errors.collect()] == ["3"]  # CSV keys stay text


def test_extract_assigns_ids_once(spark, tmp_path):
    src = tmp_path / "listings.csv"
    src.write_text(LISTINGS_CSV, encoding="utf-8")
    result = run_extract(spark, str(src), str(tmp_path / "r"), ["Canada", "Australia"])
    ids = {r.listing_id for r in result.reviews.collect()}
    assert len(ids) == 3


def test_evaluate_and_translate(spark, tmp_path):
    rows = [(i, 0, f"review number {i} " + "x" * (i % 13), str(1 + i % 10)) for i in range(60)]
    reviews = spark.createDataFrame(rows, "listing_id long, review_pos int, Review string, Review_Score string")
    prompts = [Prompt(0, "en", "Score: {review}"), Prompt(1, "en", "Rate this one: {review}")]
    ev = evaluate(reviews, LengthScorer, prompts, limit=50, output_dir=str(tmp_path / "out"))
    assert ev.test.count() == 10 and ev.dev.count() == 40
    assert ev.dev.select("prompt_id").distinct().count() == 1
    assert {r.prompt_id for r in ev.deviations} == {0, 1}
    assert "best prompt" in ev.report()
    assert glob.glob(str(tmp_path / "out" / "test_predictions" / "*.csv"))
    translated = run_translate(spark, reviews, str(tmp_path / "t"), PrefixTranslator, limit=3, template="{review}")
    changed = translated.where(F.col("Review").startswith("[en] ")).count()
    assert changed == 3 and translated.count() == 60


def test_stage_root_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from revlens.session import stage_root

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

        def set(self, key, value):
            self[key] = value

    class Context(SimpleNamespace):
        def getCheckpointDir(self):
            return self.ckpt

        def setCheckpointDir(self, path):
            self.ckpt = path

    cluster = SimpleNamespace(conf=Conf(), sparkContext=Context(master="yarn", ckpt=None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stage_root(cluster)
    cluster.conf.set("spark.checkpoint.dir", "hdfs:///shared/stages/")
    assert stage_root(cluster) == "hdfs:///shared/stages"
    assert cluster.sparkContext.ckpt == "hdfs:///shared/stages/"


def test_spread_never_runs_upstream_stages(spark):
    from revlens.session import spread

    sc = spark.sparkContext

    def last_job():
        return max(sc.statusTracker().getJobIdsForGroup(None) or [-1])

    src = spark.range(0, 1000, numPartitions=3)
    shuffled = src.groupBy((src.id % 7).alias("k")).count()
    before = last_job()
    assert spread(shuffled) is shuffled  # sized by its shuffle already
    assert last_job() == before  # and nothing ran to find that out
    assert spread(src) is src  # some idle slots: cheaper than moving the rows
    few = spread(spark.range(0, 1000, numPartitions=1))
    assert last_job() == before
    assert few.rdd.getNumPartitions() == sc.defaultParallelism


def test_package_is_shipped_once_with_every_module(spark):
    import io
    import os
    import zipfile

    from revlens import session

    names = set(zipfile.ZipFile(io.BytesIO(session.package_zip())).namelist())
    package = os.path.dirname(session.__file__)
    for folder, _dirs, files in os.walk(package):
        for name in files:
            if name.endswith(".py"):
                assert os.path.relpath(os.path.join(folder, name), os.path.dirname(package)) in names
    assert "revlens/operators/inference.py" in names
    session.ship_package(spark)
    assert session.ship_package(spark) is None  # once per application


def test_evaluate_resumes_from_an_answer_store(spark, tmp_path):
    rows = [(i, 0, f"review number {i} " + "y" * (i % 7), str(1 + i % 10)) for i in range(40)]
    reviews = spark.createDataFrame(rows, "listing_id long, review_pos int, Review string, Review_Score string")
    prompts = [Prompt(0, "en", "Score: {review}"), Prompt(1, "en", "Rate this one: {review}")]
    store = str(tmp_path / "store")
    first = evaluate(reviews, LengthScorer, prompts, limit=-1, answer_store=store, model_id="lengths")
    n_stored = spark.read.parquet(store).count()
    # 32 dev reviews x 2 prompts + 8 test reviews x the chosen prompt
    assert n_stored == 32 * 2 + 8
    second = evaluate(reviews, LengthScorer, prompts, limit=-1, answer_store=store, model_id="lengths")
    assert spark.read.parquet(store).count() == n_stored  # nothing new was asked
    assert (first.prompt.prompt_id, first.dev_mae) == (second.prompt.prompt_id, second.dev_mae)
    assert first.summary.first() == second.summary.first()


def test_reviews_without_keys_get_file_positions(spark, tmp_path):
    from revlens.sources.csv import load_reviews

    src = tmp_path / "reviews.csv"
    src.write_text("Review,Review_Score\n" + "".join(f'"r {i}, ""x""","{i % 10},5"\n' for i in range(40)), encoding="utf-8")
    reviews = load_reviews(spark, str(src), partitions=5)
    rows = sorted((r.listing_id, r.review_pos, r.Review) for r in reviews.collect())
    assert rows == [(i, 0, f'r {i}, "x"') for i in range(40)]
    translated = run_translate(spark, str(src), str(tmp_path / "t"), PrefixTranslator, limit=3, template="{review}", input_format="csv")
    assert sorted(r.listing_id for r in translated.where(F.col("Review").startswith("[en]")).collect()) == [0, 1, 2]
    keyed = tmp_path / "keyed.csv"
    keyed.write_text("listing_id,review_pos,Review,Review_Score\n12,1,a,5\n3,0,b,4\n", encoding="utf-8")
    ev = load_reviews(spark, str(keyed))
    assert dict(ev.dtypes)["listing_id"] == "bigint" and sorted(r.listing_id for r in ev.collect()) == [3, 12]


def test_a_run_has_its_own_folder(spark, monkeypatch):
    from revlens import session

    path = session.new_stage_path(spark, "kept")
    assert path.startswith(session.run_root(spark) + "/kept-")
    with monkeypatch.context() as m:
        m.setattr(session, "run_root", lambda s: f"{session.stage_root(s)}/run-other")
        other = session.new_stage_path(spark, "gone")
        spark.range(3).write.parquet(other)
        shipped = set(session._SHIPPED)
        session.remove_run(spark)
        session._SHIPPED |= shipped
    assert not session.path_exists(spark, other)
    assert session.path_exists(spark, session.run_root(spark))
