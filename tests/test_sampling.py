import math

import pytest
from pyspark.sql import functions as F

from revlens.operators.sampling import cut_key, dev_test, exact_split, first_rows, first_rows_flag, n_test_rows

SMALL_CUT = {"topk_limit": 0, "local_limit": 7, "buckets": 4}


def test_test_sizes():
    assert n_test_rows(250, 0.2) == 50
    assert n_test_rows(11, 0.2) == 3
    assert n_test_rows(1000, 0.2) == 200


@pytest.mark.parametrize("n", [11, 250, 1000])
def test_exact_split_sizes_and_partition_independence(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    tagged = exact_split(df, "k", 0.2, 42)
    test = {r.k for r in tagged.where("split = 'test'").collect()}
    dev = {r.k for r in tagged.where("split = 'dev'").collect()}
    assert len(test) == math.ceil(0.2 * n)
    assert test.isdisjoint(dev) and len(test | dev) == n
    again = exact_split(df.repartition(7), "k", 0.2, 42)
    assert {r.k for r in again.where("split = 'test'").collect()} == test
    other_seed = exact_split(df, "k", 0.2, 7)
    assert {r.k for r in other_seed.where("split = 'test'").collect()} != test


def test_histogram_path_equals_topk_path(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    fast = exact_split(df, "k", 0.2, 42)
    refined = exact_split(df, "k", 0.2, 42, **SMALL_CUT)
    a = {r.k for r in fast.where("split = 'test'").collect()}
    b = {r.k for r in refined.where("split = 'test'").collect()}
    assert a == b and len(a) == 60


def test_cut_key_with_a_hot_first_key(spark):
    # a third of the rows share the first key value
    rows = [(7, i) for i in range(100)] + [(i, 0) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b long")
    ordered = sorted(rows)
    for k in (1, 5, 50, 120, 150, 300):
        assert cut_key(df, ["a", "b"], k, **SMALL_CUT) == ordered[k - 1]
        assert cut_key(df, ["a", "b"], k) == ordered[k - 1]


def test_cut_key_wide_and_negative_values(spark):
    vals = [-(2**62), -5, 0, 3, 2**40, 2**62 + 11] + list(range(100, 140))
    df = spark.createDataFrame([(v,) for v in vals], "a long")
    ordered = sorted(vals)
    for k in (1, 2, 6, 20, len(vals)):
        assert cut_key(df, ["a"], k, **SMALL_CUT) == (ordered[k - 1],)


def test_first_rows(spark):
    df = spark.createDataFrame([(i // 3, i % 3, f"r{i}") for i in range(30)], "listing_id long, review_pos int, t string")
    got = first_rows(df, 5, ["listing_id", "review_pos"]).collect()
    assert sorted(r.t for r in got) == sorted(f"r{i}" for i in range(5))
    refined = first_rows(df, 11, ["listing_id", "review_pos"], **SMALL_CUT)
    assert sorted(r.t for r in refined.collect()) == sorted(f"r{i}" for i in range(11))
    assert first_rows(df, -1, ["listing_id"]).count() == 30
    assert first_rows(df, 100, ["listing_id", "review_pos"], **SMALL_CUT).count() == 30
    with pytest.raises(ValueError):
        first_rows(df, -2, ["listing_id"])


def test_first_rows_flag(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    flags = {r.k: r.selected for r in first_rows_flag(df, 2, ["k"]).collect()}
    assert flags == {0: True, 1: True, 2: False, 3: False, 4: False}


def test_dev_test_composite_key(spark):
    df = spark.createDataFrame([(i // 4, i % 4) for i in range(40)], "listing_id long, review_pos int")
    dev, test = dev_test(df, ["listing_id", "review_pos"])
    assert test.count() == 8 and dev.count() == 32
    assert dev.join(test, ["listing_id", "review_pos"]).count() == 0


def test_many_partitions_take_the_histogram_path(spark):
    # k x partitions over the budget: the distributed refinement is used,
    # and it finds the same cut as the top-k path
    from revlens.operators.sampling import cut_key

    df = spark.range(0, 5000, numPartitions=40).withColumnRenamed("id", "k")
    hashed = df.withColumn("h", (F.col("k") * 7919) % 5003)
    topk = cut_key(hashed, ["h", "k"], 1000)
    refined = cut_key(hashed, ["h", "k"], 1000, topk_budget=1000 * 39, local_limit=100, buckets=8)
    assert topk == refined


@pytest.mark.parametrize("options", [{}, SMALL_CUT])
def test_keys_are_checked_alike_on_both_paths(spark, options):
    # text has its own order: '10' comes before '9'
    text = spark.createDataFrame([(str(i),) for i in range(1, 31)], "k string")
    assert cut_key(text, ["k"], 3, **options) == ("11",)
    maps = spark.createDataFrame([({"a": 1},)], "k map<string, int>")
    with pytest.raises(TypeError, match="no order"):
        cut_key(maps, ["k"], 1, **options)
    nulls = spark.createDataFrame([(i,) for i in range(30)] + [(None,)], "k long")
    with pytest.raises(ValueError, match="NULL"):
        first_rows(nulls, 5, ["k"], **options)
    with pytest.raises(ValueError, match="NULL"):
        first_rows(nulls, 500, ["k"], **options)
    twice = spark.createDataFrame([(i // 2,) for i in range(60)], "k long")
    with pytest.raises(ValueError, match="not unique"):
        first_rows(twice, 5, ["k"], **options)
    hot = spark.createDataFrame([(1,)] * 40 + [(i,) for i in range(2, 9)], "k long")
    with pytest.raises(ValueError, match="not unique"):
        first_rows(hot, 5, ["k"], **options)
