import pytest
from pyspark.sql import functions as F

from revlens.operators.inference import LengthScorer, PrefixTranslator, generate, score, translate
from revlens.operators.prompts import DEFAULT_PROMPTS, Prompt, as_prompts, with_prompts

REVIEWS = "listing_id long, review_pos int, Review string, Review_Score string"


class Failing:
    def generate(self, prompts):
        if any("boom" in p for p in prompts):
            raise RuntimeError("model down")
        return [p.upper() for p in prompts]


class Counting:
    """Answers with the prompt length; used to check dedup."""

    def generate(self, prompts):
        return [str(len(p)) for p in prompts]


def _reviews(spark):
    rows = [(1, 0, "good", "9"), (1, 1, "good", "9"), (2, 0, None, "5"), (3, 0, "bad place", None), (4, 0, "ok", "7")]
    return spark.createDataFrame(rows, REVIEWS)


def test_with_prompts_is_a_generate_not_a_join(spark):
    crossed = with_prompts(_reviews(spark), DEFAULT_PROMPTS)
    assert crossed.count() == 5 * len(DEFAULT_PROMPTS)
    plan = crossed._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Join" not in plan and "Exchange" not in plan


def test_prompt_set_is_checked():
    with pytest.raises(ValueError):
        as_prompts([])
    with pytest.raises(ValueError):
        Prompt(0, "en", "no slot")
    with pytest.raises(ValueError):
        as_prompts([Prompt(1, "", "{review}"), Prompt(1, "", "{review}!")])


def test_a_large_prompt_set_is_joined(spark):
    prompts = ["x" * 20_000 + f" {i} {{review}}" for i in range(70)]
    got = with_prompts(_reviews(spark), prompts, text_col="t").select("listing_id", "review_pos", "prompt_id", "t").collect()
    assert len(got) == 5 * 70
    assert all(r.t is None or (r.t.startswith("x" * 20_000) and f" {r.prompt_id} " in r.t) for r in got)


def test_dedup_equals_direct(spark):
    df = with_prompts(_reviews(spark), DEFAULT_PROMPTS)
    a = generate(df, "prompt_text", "out", Counting, dedup=True)
    b = generate(df, "prompt_text", "out", Counting, dedup=False)
    key = ["listing_id", "review_pos", "prompt_id"]
    ra = sorted((r.listing_id, r.review_pos, r.prompt_id, r.out) for r in a.select(*key, "out").collect())
    rb = sorted((r.listing_id, r.review_pos, r.prompt_id, r.out) for r in b.select(*key, "out").collect())
    assert ra == rb
    assert all((r[3] is None) == (r[0] == 2) for r in ra)


def test_inference_is_one_map_in_pandas(spark):
    direct = score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS, dedup=False)
    assert direct._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    # with dedup the answers were written once; the result reads them back
    deduped = score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS)
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "answers-" in plan


def test_score_parses_answers(spark):
    rows = score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS).collect()
    assert len(rows) == 15
    for r in rows:
        if r.Review is None:
            assert r.response is None and r.predicho is None
            continue
        rendered = DEFAULT_PROMPTS[r.prompt_id].template.replace("{review}", r.Review)
        n = len(rendered)
        assert r.predicho == (None if n % 7 == 0 else float(n % 11))
        assert r.response == (f"{n % 11}/10" if n % 7 == 0 else str(n % 11))


def test_on_error_policies(spark):
    df = spark.createDataFrame([(1, "fine"), (2, "boom")], "id long, t string")
    out = generate(df, "t", "out", Failing, on_error="null", error_col="err", batch_size=1)
    rows = {r.id: r for r in out.collect()}
    assert rows[1].out == "FINE" and rows[1].err is None
    assert rows[2].out is None and "model down" in rows[2].err
    with pytest.raises(Exception, match="model down"):
        generate(df, "t", "out", Failing).collect()


@pytest.mark.parametrize("dedup", [True, False])
def test_one_bad_prompt_costs_no_other_its_answer(spark, dedup):
    df = spark.createDataFrame([(i, "boom" if i == 7 else f"t{i}") for i in range(65)], "id long, t string").coalesce(1)
    rows = generate(df, "t", "out", Failing, on_error="null", error_col="err", dedup=dedup).collect()
    assert {r.id for r in rows if r.out is None} == {7}
    assert {r.id for r in rows if r.err} == {7}


def test_failed_calls_are_counted(spark):
    from revlens.operators.scoring import deviation

    df = spark.createDataFrame([(i, 0, "boom" if i < 3 else f"t{i}", "5") for i in range(9)], REVIEWS)
    (row,) = deviation(score(df, Failing, [Prompt(0, "", "{review}")], on_error="null")).collect()
    assert (row.n_rows, row.n_failed, row.n_bad, row.n_numeric) == (9, 3, 6, 0)


def test_translate_limit_changes_only_first_rows(spark):
    df = spark.createDataFrame([(i, 0, f"t{i}", "5") for i in range(5)], REVIEWS)
    out = translate(df, PrefixTranslator, template="{review}", limit=2)
    rows = sorted((r.listing_id, r.Review) for r in out.collect())
    assert rows == [(0, "[en] t0"), (1, "[en] t1"), (2, "t2"), (3, "t3"), (4, "t4")]
    everything = translate(df, PrefixTranslator, template="{review}")
    assert all(r.Review.startswith("[en] ") for r in everything.collect())


def test_translate_keeps_nulls(spark):
    out = translate(_reviews(spark), PrefixTranslator, template="{review}")
    rows = {(r.listing_id, r.review_pos): r.Review for r in out.collect()}
    assert rows[(2, 0)] is None and rows[(1, 0)] == "[en] good"


def test_hot_texts_are_salted(spark):
    # one text holds most rows: with a tiny threshold it is split over buckets
    rows = [(i, 0, "same text" if i % 3 else f"t{i}", "5") for i in range(300)]
    df = spark.createDataFrame(rows, REVIEWS)
    salted = generate(df, "Review", "out", Counting, hot_rows=10)
    plain = generate(df, "Review", "out", Counting, dedup=False)
    a = sorted((r.listing_id, r.out) for r in salted.collect())
    b = sorted((r.listing_id, r.out) for r in plain.collect())
    assert a == b and len(a) == 300
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def test_model_stage_keeps_one_task_per_slot(spark):
    # a few KB of prompts: AQE alone would coalesce them into one task
    import glob
    import os

    from revlens.operators.inference import model_tasks
    from revlens.session import run_root

    def answer_dirs():
        return set(glob.glob(f"{run_root(spark)}/answers-*"))

    before = answer_dirs()
    df = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "id long, t string")
    out = generate(df, "t", "out", Counting)
    (new,) = answer_dirs() - before
    parts = [f for f in os.listdir(new) if f.startswith("part-")]
    assert len(parts) == model_tasks(spark) >= spark.sparkContext.defaultParallelism
    assert sorted(int(r.out) for r in out.collect()) == sorted(len(f"text {i}") for i in range(500))


def test_score_by_review_equals_direct(spark):
    # duplicates, NULL reviews and one hot review (salted with hot_rows=5)
    rows = [(i, 0, None if i % 11 == 0 else ("same" if i % 2 else f"r{i % 9}"), "5") for i in range(60)]
    df = spark.createDataFrame(rows, REVIEWS)
    cols = ["listing_id", "review_pos", "prompt_id", "response", "predicho", "err"]
    by_review = score(df, LengthScorer, DEFAULT_PROMPTS, hot_rows=5, error_col="err", on_error="null")
    direct = score(df, LengthScorer, DEFAULT_PROMPTS, dedup=False, error_col="err", on_error="null")
    assert by_review.columns == direct.columns
    a = sorted(tuple(r) for r in by_review.select(*cols).collect())
    b = sorted(tuple(r) for r in direct.select(*cols).collect())
    assert a == b and len(a) == 60 * len(DEFAULT_PROMPTS)
    assert dict(by_review.dtypes)["prompt_id"] == "int"


def test_rows_cross_the_join_back_once(spark):
    # prompts were applied to the distinct reviews before the model; the
    # rows are not exploded per prompt anywhere in the final plan, they
    # multiply only in the join's output
    scored = score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # (only reviews that are missing, which join nothing, are multiplied)
    assert "Join" in plan and plan.count("Generate explode") == 1 and "isnull(" in plan
    assert scored.count() == 5 * len(DEFAULT_PROMPTS)


ANSWERED_ONCE = {f"text {i}" for i in range(20)}


class RefuseKnown:
    """Answers like Counting but refuses prompts answered by an earlier
    run: resuming from the store must never send them again."""

    def generate(self, prompts):
        again = [p for p in prompts if p in ANSWERED_ONCE]
        if again:
            raise RuntimeError(f"asked again: {again[:3]}")
        return [str(len(p)) for p in prompts]


def test_answer_store_resumes_without_asking_again(spark, tmp_path):
    # an earlier run answered 20 prompts into a store
    earlier = str(tmp_path / "earlier")
    first = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, t string")
    out1 = generate(first, "t", "out", Counting, answer_store=earlier, model_id="m")
    assert sorted(int(r.out) for r in out1.collect()) == sorted(len(f"text {i}") for i in range(20))
    # hand those answers to RefuseKnown, which fails if asked for any of them
    store = str(tmp_path / "store")
    seed = spark.read.parquet(earlier).drop("run").withColumn("model", F.lit("refuser"))
    seed.write.parquet(f"{store}/run=seed")

    both = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(99, None)], "id long, t string")
    rows = {r.id: r.out for r in generate(both, "t", "out", RefuseKnown, answer_store=store, model_id="refuser").collect()}
    assert rows[99] is None
    assert all(rows[i] == str(len(f"text {i}")) for i in range(40))
    # the 20 new answers were added once
    stored = spark.read.parquet(store)
    assert stored.count() == stored.select("prompt_sha256").distinct().count() == 40


def test_answer_store_keeps_failures_out(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "fine"), (2, "boom")], "id long, t string")
    out = generate(df, "t", "out", Failing, on_error="null", error_col="err", batch_size=1, answer_store=store, model_id="m")
    rows = {r.id: (r.out, r.err) for r in out.collect()}
    assert rows[1] == ("FINE", None) and rows[2][0] is None and "model down" in rows[2][1]
    assert spark.read.parquet(store).count() == 1  # only the success


def test_score_with_answer_store_equals_without(spark, tmp_path):
    store = str(tmp_path / "store")
    cols = ["listing_id", "review_pos", "prompt_id", "response", "predicho"]
    plain = sorted(tuple(r) for r in score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS).select(*cols).collect())
    for _ in range(2):  # second run answers everything from the store
        stored = score(_reviews(spark), LengthScorer, DEFAULT_PROMPTS, answer_store=store, model_id="m")
        assert sorted(tuple(r) for r in stored.select(*cols).collect()) == plain
    assert spark.read.parquet(store).count() == spark.read.parquet(store).select("prompt_sha256").distinct().count()


def test_score_concurrency_sets_the_model_tasks(spark):
    import glob
    import os

    from revlens.session import run_root

    def answer_dirs():
        return set(glob.glob(f"{run_root(spark)}/answers-*"))

    before = answer_dirs()
    df = spark.createDataFrame([(i, 0, f"review {i}", "5") for i in range(200)], REVIEWS)
    rows = score(df, LengthScorer, DEFAULT_PROMPTS, concurrency=3).count()
    assert rows == 200 * len(DEFAULT_PROMPTS)
    (new,) = answer_dirs() - before
    assert len([f for f in os.listdir(new) if f.startswith("part-")]) == 3


def test_answer_store_needs_a_model_id_and_takes_an_empty_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, "fine")], "id long, t string")
    with pytest.raises(ValueError, match="model_id"):
        generate(df, "t", "out", Counting, answer_store=str(tmp_path / "s"))
    (tmp_path / "made").mkdir()
    assert generate(df, "t", "out", Counting, answer_store=str(tmp_path / "made"), model_id="m").first().out == "4"


RESUME = """
import sys
sys.path.insert(0, {root!r})
from revlens.session import get_session

spark = get_session("local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {stage!r}}})


class Model:
    \"\"\"Fails on its bad prompt; writes down all it is asked.\"\"\"

    def generate(self, prompts):
        with open({asked!r}, "a") as f:
            f.writelines(p + chr(10) for p in prompts)
        if {bad!r} in prompts:
            raise RuntimeError("model down")
        return [p.upper() for p in prompts]


from revlens.operators.inference import generate

df = spark.createDataFrame([(i, f"t{{i}}") for i in range(60)], "id long, t string")
print("ANSWERS", len([r for r in generate(df, "t", "out", Model, answer_store={store!r}, model_id="m", wave_prompts=10, batch_size=4).collect() if r.out]))
"""


def test_a_failed_run_is_resumed_by_another_process(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = []
    for k, bad in enumerate(("t33", "none")):
        asked = tmp_path / f"asked{k}"
        code = RESUME.format(root=root, stage=str(tmp_path / f"stage{k}"), asked=str(asked), bad=bad, store=str(tmp_path / "store"))
        run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        out.append((run, set(asked.read_text().split())))
    (first, asked_first), (second, asked_second) = out
    assert first.returncode and "model down" in first.stderr
    assert "ANSWERS 60" in second.stdout
    # the second asks only what was not answered: the bad one and later waves
    assert asked_second == ({f"t{i}" for i in range(60)} - asked_first) | {"t33"}
    assert len(asked_first) > 1


def test_distinct_texts_are_counted_without_a_sort(spark):
    from revlens.operators.inference import _distinct_texts

    plan = _distinct_texts(_reviews(spark).withColumn("__k", F.sha2("Review", 256)), "Review", "__t")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
