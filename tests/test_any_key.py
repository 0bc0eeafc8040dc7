"""L1 and X1 on keys of any sortable type, against plain sorting."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import sampling
from revlens.operators.sampling import cut_key, exact_split, first_rows, first_rows_flag

# both ways: top-k, and splitters with few intervals
WAYS = [{}, {"topk_limit": 0, "local_limit": 7}]


@pytest.fixture(autouse=True)
def few_splitters(monkeypatch):
    monkeypatch.setattr(sampling, "SPLITTERS", 5)


@pytest.mark.parametrize("way", WAYS)
def test_text_and_number_keys(spark, way):
    rng = random.Random(2)
    words = ["", " ", "a", "A", "aa", "é", "z", "ü", "10", "9", "\U0001f600", "￮"]
    rows = [(rng.choice(words), i) for i in range(200)] + [("hot", i) for i in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t string, n long").repartition(3)
    ordered = sorted(rows, key=lambda r: (r[0].encode(), r[1]))
    for k in (1, 2, 50, 150, 299, 300):
        assert cut_key(df, ["t", "n"], k, **way) == ordered[k - 1]
        assert {tuple(r) for r in first_rows(df, k, ["t", "n"], **way).collect()} == set(ordered[:k])
    assert cut_key(df, ["t", "n"], 301, **way) is None
    with pytest.raises(ValueError, match="not unique"):
        cut_key(df, ["t"], 3, **way)


@pytest.mark.parametrize("way", WAYS)
def test_time_keys(spark, way):
    start = dt.datetime(2024, 10, 27, 0, 0, 0)
    # across the hour that clocks repeat, microseconds apart
    rows = [(i, start + dt.timedelta(microseconds=i * 86_399_999)) for i in range(250)]
    df = spark.createDataFrame(rows, "id long, ts timestamp").select("id", "ts", F.col("ts").cast("timestamp_ntz").alias("ntz"), F.col("ts").cast("date").alias("day")).repartition(3)
    for key in (["ts"], ["ntz"], ["day", "id"]):
        got = {r.id for r in first_rows(df, 100, key, **way).collect()}
        assert got == set(range(100)), key
    flags = first_rows_flag(df, 30, ["ts"], **way).where("selected").count()
    assert flags == 30


@pytest.mark.parametrize("way", WAYS)
def test_double_keys_with_odd_values(spark, way):
    values = [float("-inf"), -1e300, -0.5, 0.0, 5e-324, 0.1, 0.1 + 2**-56, 1e300, float("inf"), float("nan")] + [i / 7 for i in range(2, 60)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    ordered = sorted((v for v in values if v == v)) + [float("nan")]
    for k in (1, 4, 6, 20, len(values) - 1):
        assert cut_key(df, ["x"], k, **way) == (ordered[k - 1],)
    assert math.isnan(cut_key(df, ["x"], len(values), **way)[0])


@pytest.mark.parametrize("way", WAYS)
def test_decimal_boolean_and_binary_keys(spark, way):
    df = spark.range(120).select((F.col("id") % 2 == 0).alias("b"), (F.col("id") / 8).cast("decimal(20,6)").alias("d"), F.md5(F.col("id").cast("string")).cast("binary").alias("x"), "id")
    rows = [tuple(r) for r in df.collect()]
    for key, at in ((["b", "d"], (0, 1)), (["x"], (2,))):
        ordered = sorted(rows, key=lambda r: tuple(bytes(r[i]) if i == 2 else r[i] for i in at))
        assert {r.id for r in first_rows(df, 70, key, **way).collect()} == {r[3] for r in ordered[:70]}


def test_split_on_text_keys_is_exact_and_stable(spark):
    df = spark.range(333).select(F.concat(F.lit("listing "), "id").alias("name"), "id")
    parts = [{r.name for r in exact_split(d, "name", 0.2, 42, **w).where("split = 'test'").collect()} for d, w in ((df, WAYS[0]), (df.repartition(7), WAYS[1]))]
    assert parts[0] == parts[1] and len(parts[0]) == math.ceil(0.2 * 333)


def test_keys_without_an_order_are_refused(spark):
    df = spark.range(3).select(F.create_map(F.lit("a"), "id").alias("m"), F.array("id").alias("l"), F.when(F.col("id") > 0, F.lit("x")).alias("t"))
    for key in ("m", "l"):
        with pytest.raises(TypeError, match="no order"):
            cut_key(df, [key], 1)
    with pytest.raises(ValueError, match="NULL"):
        cut_key(df, ["t"], 1)
