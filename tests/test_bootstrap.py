"""Poisson bootstrap of the deviations; quantile sketches."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators.bootstrap import deviation_intervals, poisson_cuts, replicate_deviations, with_weights
from revlens.operators.quantiles import distances, merged, quantiles, rank_error, sketches
from revlens.operators.scoring import deviation


def weight(key, replicate, seed=42):
    digest = hashlib.md5(f"{seed}:{replicate // 8}:{key}".encode()).hexdigest()
    number = int(digest[replicate % 8 * 4 : replicate % 8 * 4 + 4], 16)
    return sum(number >= cut for cut in poisson_cuts())


def preds(spark, n=150, prompts=3):
    rng = random.Random(4)
    rows = [(i, p, str(rng.randint(1, 10)) if i % 13 else None, float(rng.randint(1, 10)) if rng.random() > 0.1 else None) for i in range(n) for p in range(prompts)]
    return spark.createDataFrame(rows, "listing_id long, prompt_id int, Review_Score string, predicho double"), rows


def test_weights_are_poisson_and_the_same_for_all_prompts(spark):
    cuts = poisson_cuts()
    shares = np.diff([0, *cuts, 1 << 16]) / (1 << 16)
    assert all(abs(s - math.exp(-1) / math.factorial(k)) < 1e-4 for k, s in enumerate(shares))
    df = spark.range(40).select("id", F.lit("x").alias("c"))
    got = {(r.id, r.replicate): r.weight for r in with_weights(df, ["id"], 20).collect()}
    assert got == {(i, r): w for i in range(40) for r in range(20) if (w := weight(str(i), r))}


def test_replicates_against_plain_sums(spark):
    df, rows = preds(spark)
    got = {(r.prompt_id, r.replicate): r.mae for r in replicate_deviations(df, ["listing_id"], replicates=30).collect()}
    want = {}
    for p in range(3):
        for r in range(30):
            pairs = [(weight(str(i), r), abs(float(real) - pred)) for i, q, real, pred in rows if q == p and real is not None and pred is not None]
            want[p, r] = sum(w * d for w, d in pairs) / sum(w for w, _ in pairs)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    plan = replicate_deviations(df, ["listing_id"], replicates=30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_intervals_hold_the_deviation_and_wins_sum_to_one(spark):
    df, _ = preds(spark)
    mae = {r.prompt_id: r.mae for r in deviation(df).collect()}
    rows = deviation_intervals(df, ["listing_id"]).collect()
    assert len(rows) == 3 and abs(sum(r.wins for r in rows) - 1) < 1e-9
    for r in rows:
        assert r.low < r.median < r.high and r.low < mae[r.prompt_id] < r.high
        assert abs(r.median - mae[r.prompt_id]) < 0.15
    again = deviation_intervals(df.repartition(7), ["listing_id"]).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    with pytest.raises(ValueError):
        deviation_intervals(df, ["listing_id"], level=1.0)


def test_prompt_without_numbers_never_wins(spark):
    df, _ = preds(spark)
    none = df.withColumn("predicho", F.when(F.col("prompt_id") != 1, F.col("predicho")))
    assert {r.prompt_id for r in deviation_intervals(none, ["listing_id"], replicates=16).collect()} == {0, 2}


def test_quantiles_are_within_the_bound(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(5, 2, 20_000), [float("nan")] * 10])
    df = spark.createDataFrame([(float(v), "a" if i % 3 else "b") for i, v in enumerate(values)], "v double, g string").repartition(6)
    found = sketches(df, ["g"], "v")
    rows = {r.g: r for r in quantiles(found).collect()}
    for g, at in (("a", lambda i: i % 3), ("b", lambda i: not i % 3)):
        own = np.sort([v for i, v in enumerate(values) if at(i) and v == v])
        assert rows[g].n == len(own)
        for share in (0.05, 0.25, 0.5, 0.75, 0.95):
            rank = np.searchsorted(own, rows[g][f"q{round(100 * share):02d}"]) / len(own)
            assert abs(rank - share) <= rank_error() + 1 / len(own)
    assert abs(rank_error() - 0.0193) < 0.0002


def test_sketches_of_two_days_merge(spark):
    one, two = (spark.range(a, b).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v")) for a, b in ((0, 5000), (5000, 20000)))
    both = merged(sketches(one, ["g"], "v").unionByName(sketches(two, ["g"], "v")), ["g"])
    row = quantiles(both).first()
    assert row.n == 20000 and abs(row.q50 - 10000) <= rank_error() * 20000


def test_distance_is_the_largest_gap_of_the_shares(spark):
    df = spark.range(9000).select((F.col("id") % 3).cast("string").alias("g"), F.when(F.col("id") % 3 == 1, F.col("id") / 9000 + 0.3).otherwise(F.col("id") / 9000).alias("v"))
    rows = {(r.one, r.other): r.distance for r in distances(sketches(df, ["g"], "v"), "g").collect()}
    assert set(rows) == {("0", "1"), ("0", "2"), ("1", "2")}
    bound = 2 * rank_error() + 1 / 200
    assert abs(rows["0", "1"] - 0.3) <= bound and abs(rows["1", "2"] - 0.3) <= bound and rows["0", "2"] <= bound
