import pytest
from pyspark.sql import functions as F

from revlens.functions.text import comma_decimal, parse_comma_decimal, parse_number, render, strip


ANSWERS = [
    ("8", 8.0), (" 8 ", 8.0), ("8\n", 8.0), ("8.", 8.0), ("+8", 8.0), (".5", 0.5), ("1e1", 10.0),
    ("8/10", None), ("9,5", None), ("0x8", None), ("", None), ("Nota: 8", None),
    ("0", 0.0), ("11", 11.0), ("-3", -3.0),
    ("8d", None), ("8f", None), ("1D", None),
    ("nan", None), ("inf", None), ("1_0", None), ("８", None), (None, None),
    (" 8 ", 8.0),
    ("1e999", None), ("-1e400", None), ("\x1c8\x1f", 8.0), ("\u30008\u2003", 8.0),
]


def test_parse_number_matches_fixtures(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ANSWERS)], "i int, a string")
    got = {r["i"]: r["v"] for r in df.select("i", parse_number("a").alias("v")).collect()}
    for i, (_, expected) in enumerate(ANSWERS):
        assert got[i] == expected, ANSWERS[i]


def test_strip_is_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t a b \n",), (" x ",), ("",)], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["a b", "x", ""]


def test_decimal_comma_round_trip(spark):
    df = spark.createDataFrame([("9.5",), ("10",), (None,), ("9,5",)], "t string")
    rows = df.select(comma_decimal("t").alias("c"), parse_comma_decimal("t").alias("v")).collect()
    assert [r["c"] for r in rows] == ["9,5", "10", None, "9,5"]
    assert [r["v"] for r in rows] == [9.5, 10.0, None, 9.5]


def test_render_is_literal(spark):
    df = spark.createDataFrame([("a {x} $1 \\ {review}",), (None,)], "r string")
    out = [r[0] for r in df.select(render(F.lit("T: {review} / {review}"), "r")).collect()]
    assert out[0] == "T: a {x} $1 \\ {review} / a {x} $1 \\ {review}"
    assert out[1] is None


@pytest.mark.parametrize("value", [1.0, 2.5, None])
def test_fmt2(value):
    from revlens.functions.text import fmt2

    assert fmt2(value) == ("nan" if value is None else f"{value:.2f}")
