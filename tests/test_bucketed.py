"""Stages in buckets of the review key."""

from revlens.operators.inference import LengthScorer
from revlens.plans.evaluate import evaluate
from revlens.sources.stage import forget_bucketed, materialize_bucketed

REVIEWS = "listing_id long, review_pos int, Review string, Review_Score string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_evaluate_move_no_rows(spark):
    df = spark.createDataFrame([(i // 3, i % 3, f"review {i} " * (1 + i % 4), str(i % 11)) for i in range(300)], REVIEWS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ev = evaluate(df, LengthScorer, limit=-1)
        for part, n in ((ev.dev, 240), (ev.test, 60)):
            shown = plan(part)
            assert "SortMergeJoin" in shown and "Exchange" not in shown and "Bucketed: true" in shown
            assert part.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert forget_bucketed(spark) >= 3 and forget_bucketed(spark) == 0


def test_bucketed_stage_keeps_its_rows(spark):
    df = spark.createDataFrame([(i, i % 7, None if i % 5 else "x") for i in range(100)], "a long, b int, c string")
    back = materialize_bucketed(df, "t", ["a", "b"], buckets=3)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) and back.columns == df.columns
    assert len(back.inputFiles()) <= 3
    forget_bucketed(spark)
