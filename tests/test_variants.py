import pytest
from pyspark.sql import functions as F

from revlens.operators.listings import explode_reviews, extraction_errors, filter_country, filter_nested, parse_listings
from revlens.operators.variants import LARGE, at_path, literal_as_json, parse_variants, with_variants
from revlens.sources.csv import read_csv, write_csv
from tests.test_literal import CASES

SCHEMA = "listing_id long, address string, reviews string, review_scores string"
NESTED = ("address", "reviews", "review_scores")

# Python values that a walk meets besides dicts.
ODD = [
    ("['my comments', {'comments': 'z'}]", "{}"), ("['other', {'comments': 'z'}]", "{}"), ("[['comments'], {'comments': 'z'}]", "{}"), ("[['x', 1], {'comments': 'z'}]", "{}"),
    ("{'x': 1}", "{}"), ("'abc'", "{}"), ("5", "{}"), ("None", "{}"), ("[]", "None"), ("[{'comments': 'a'}]", "'x'"), ("({'comments': 'a'}, {'comments': 'b'})", "{'review_scores_value': 9.0}"),
    ("[{'comments': 5}, {'comments': 'True'}]", "{'review_scores_value': 100}"), ("{[1]: 2}", "{}"), ("[{'comments': 'a', 'comments': 'b'}]", "{}"), ("[None, {'comments': 'a'}]", "{}"),
]
JSON = [
    ('[{"comments": "a"}, 5, {"comments": "z"}]', '{"review_scores_value": 9}'), ('[{"comments": "a"}, {"x": 1}, {"comments": null}]', '{"review_scores_value": 9.5}'),
    ('[{"comments": "a"}]', "[1]"), ("{bad", "{bad"), (None, None), ('{"comments": "a"}', "{}"), ('["comments"]', "{}"), ("[]", "{}"), ("null", "null"), ('"x"', "5"),
    ('[null, {"comments": "a"}]', "{}"), (" [ ]", " {}"),
]


def both(spark, rows, fmt):
    """(reviews, kind of error) from the text and from its copy."""
    df = spark.createDataFrame([(i, "{}", *r) for i, r in enumerate(rows)], SCHEMA)
    out = []
    for parsed in (parse_listings(df, fmt=fmt), parse_variants(with_variants(df, NESTED, fmt), fmt=fmt)):
        reviews = sorted(map(tuple, explode_reviews(parsed).collect()), key=repr)
        errors = sorted((r.listing_id, r.error.split(":")[0], r.reviews_kept) for r in extraction_errors(parsed).collect())
        out.append((reviews, errors))
    return out


@pytest.mark.parametrize("fmt, rows", [("python_literal", [c[:2] for c in CASES]), ("python_literal", ODD), ("json", JSON)])
def test_copy_gives_what_the_text_gives(spark, fmt, rows):
    text, copy = both(spark, rows, fmt)
    assert copy[0] == text[0]
    assert [e[::2] for e in copy[1]] == [e[::2] for e in text[1]]
    assert len(text[0]) + len(text[1]) > 5


def test_last_of_equal_keys_counts(spark):
    df = spark.createDataFrame([(1, "{}", '[{"comments": "a", "comments": "b"}]', "{}")], SCHEMA)
    assert [r.Review for r in explode_reviews(parse_variants(with_variants(df, NESTED, "json"), fmt="json")).collect()] == ["b"]


def test_every_key_keeps_its_type(spark):
    text = "{'country': 'Canada', 'n': 5, 'f': 9.0, 'b': True, 'none': None, 'big': 12345678901234567890123, 'deep': {'t': (1, 'x'), 3: {'a'}}, 'inf': 1e999}"
    df = with_variants(spark.createDataFrame([(1, text), (2, None), (3, "bad(")], "id long, address string"), ["address"])
    row = df.where("id = 1").select(F.to_json("address").alias("j"), F.schema_of_variant("address").alias("s"), "address_problem").first()
    assert row.j == '{"b":true,"big":12345678901234567890123,"country":"Canada","deep":{"3":["a"],"t":[1,"x"]},"f":9.0,"inf":"inf","n":5,"none":null}'
    for kind in ("b: BOOLEAN", "big: DECIMAL(23,0)", "f: DOUBLE", "n: BIGINT", "none: VOID"):
        assert kind in row.s
    assert row.address_problem is None
    assert [r.address_problem for r in df.where("id > 1").orderBy("id").collect()] == ["missing", "malformed"]
    assert literal_as_json("{[1]: 2}")["error"].startswith("TypeError")


@pytest.mark.parametrize("fmt", ["python_literal", "json"])
def test_one_parse_a_column(spark, tmp_path, fmt):
    spark.createDataFrame([(1, "{}", "[]", "{}")], SCHEMA).write.parquet(str(tmp_path / "x"))
    copy = with_variants(spark.read.parquet(str(tmp_path / "x")), NESTED, fmt)
    parsed = parse_variants(copy, fmt=fmt)
    for df, columns in ((explode_reviews(parsed), 2), (extraction_errors(parsed), 2), (copy, 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == columns
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == (fmt == "python_literal")


def test_json_text_is_parsed_once_a_level(spark, tmp_path):
    spark.createDataFrame([(1, "{}", "[]", "{}")], SCHEMA).write.parquet(str(tmp_path / "x"))
    parsed = parse_listings(spark.read.parquet(str(tmp_path / "x")), fmt="json")
    for df in (explode_reviews(parsed), extraction_errors(parsed), explode_reviews(parsed).where("listing_id = 1")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 3 and plan.count("get_json_object") <= 2
    assert "PushedFilters: [IsNotNull(listing_id), EqualTo(listing_id,1)]" in df._jdf.queryExecution().executedPlan().toString()


def test_shredded_copy_is_filtered_in_the_scan(spark, tmp_path):
    rows = [(i, f"{{'country': '{'Canada' if i % 2 else 'Spain'}', 'market': {i}}}", "[{'comments': 'a', 'stars': 4}]", "{'review_scores_value': 9}") for i in range(40)]
    with_variants(spark.createDataFrame(rows, SCHEMA).coalesce(1), NESTED).write.parquet(str(tmp_path / "x"))
    copy = spark.read.parquet(str(tmp_path / "x"))
    kept = filter_country(copy, ["Canada"]).select("listing_id", at_path("address", "market", kind="int").alias("market"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(address.`" in plan and "reviews" not in plan.split("ReadSchema")[1]
    assert sorted((r.listing_id, r.market) for r in kept.collect()) == [(i, i) for i in range(1, 40, 2)]
    assert copy.select(at_path("reviews", 0, "stars", kind="int").alias("s")).distinct().collect()[0].s == 4
    assert filter_nested(copy, "address", "market", [3, 5]).count() == 2


def test_texts_match_texts_alone(spark):
    df = with_variants(spark.createDataFrame([(1, "{'k': '5'}"), (2, "{'k': 5}"), (3, "{'k': None}"), (4, "[1]"), (5, None)], "id long, props string"), ["props"])
    assert [r.id for r in filter_nested(df, "props", "k", ["5"]).collect()] == [1]
    with pytest.raises(TypeError):
        filter_nested(df, "props", "k", ["5", 5])


def test_too_large_is_no_missing_value(spark):
    large = spark.range(1).select(F.lit(1).alias("id"), F.concat(F.lit('["'), F.repeat(F.lit("ab"), 70 * 1024 * 1024), F.lit('"]')).alias("reviews"))
    row = with_variants(large, ["reviews"], "json").select("reviews_problem", F.col("reviews").isNull().alias("none")).first()
    assert (row.none and row.reviews_problem == f"ValueError: more than {LARGE} bytes") or row.reviews_problem is None


def test_variant_goes_to_csv_as_json(spark, tmp_path):
    df = with_variants(spark.createDataFrame([(1, "{'country': 'Canada', 'n': 1}")], "id long, address string"), ["address"]).drop("address_problem")
    write_csv(df, str(tmp_path / "c"))
    assert read_csv(spark, str(tmp_path / "c")).first().address == '{"country":"Canada","n":1}'
