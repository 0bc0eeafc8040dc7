import pytest
from pyspark.sql import functions as F

from revlens.operators.listings import (
    compare_countries,
    count_rows,
    explode_reviews,
    extraction_errors,
    filter_country,
    filter_nested,
    parse_listings,
)
from tests.test_literal import CASES

LISTING_SCHEMA = "listing_id long, address string, reviews string, review_scores string"


def _listings(spark):
    rows = [(i, "{'country': 'Canada'}", r, s) for i, (r, s, *_rest) in enumerate(CASES)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def test_extract_matches_row_semantics(spark):
    parsed = parse_listings(_listings(spark))
    reviews = explode_reviews(parsed).orderBy("listing_id", "review_pos").collect()
    expected = [
        (i, pos, c, score)
        for i, (_r, _s, items, score, _e) in enumerate(CASES)
        for pos, c in enumerate(items)
    ]
    assert [(r.listing_id, r.review_pos, r.Review, r.Review_Score) for r in reviews] == expected
    errors = {r.listing_id: r for r in extraction_errors(parsed).collect()}
    assert set(errors) == {i for i, c in enumerate(CASES) if c[4]}
    assert errors[3].reviews_kept == 1


def test_extract_plan_parses_once(spark):
    parsed = parse_listings(_listings(spark))
    plan = explode_reviews(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_count_rows_observes_without_second_pass(spark):
    reviews = explode_reviews(parse_listings(_listings(spark)))
    observed, obs = count_rows(reviews)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == sum(len(c[2]) for c in CASES)


def test_country_filter_keeps_and_drops(spark):
    rows = [
        (1, "{'country': 'Canada'}"),
        (2, "{'country': 'Australia'}"),
        (3, "{}"),
        (4, "{'country': 5}"),
        (5, "{'country': 'Canada', 'city': 'x'}"),
    ]
    df = spark.createDataFrame(rows, "listing_id long, address string")
    kept = filter_country(df, ["Canada"])
    assert sorted(r.listing_id for r in kept.collect()) == [1, 5]
    # the address is returned whole, and parsed only where asked for
    assert {r.listing_id: r.address for r in kept.collect()}[5] == "{'country': 'Canada', 'city': 'x'}"
    parsed = filter_country(df, ["Canada"], parsed_col="place")
    assert parsed.schema["place"].dataType.simpleString() == "struct<country:string>"
    two = filter_country(df, ["Canada", "Australia"])
    assert sorted(r.listing_id for r in two.collect()) == [1, 2, 5]


@pytest.mark.parametrize("bad", [None, "bad(", "[1]"])
def test_country_filter_fails_fast(spark, bad):
    df = spark.createDataFrame([(1, "{'country': 'Canada'}"), (2, bad)], "listing_id long, address string")
    with pytest.raises(Exception, match="address can not be read"):
        filter_country(df, ["Canada"]).collect()


def test_country_filter_json_mode(spark):
    df = spark.createDataFrame(
        [(1, '{"country": "Canada"}'), (2, '{"country": "Australia"}')], "listing_id long, address string"
    )
    assert [r.listing_id for r in filter_country(df, ["Canada"], fmt="json").collect()] == [1]
    bad = spark.createDataFrame([(1, "{'country': 'Canada'}")], "listing_id long, address string")
    with pytest.raises(Exception):
        filter_country(bad, ["Canada"], fmt="json").collect()


def test_struct_address_is_pushed_to_parquet(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ("Canada",)), (2, ("Australia",))], "listing_id long, address struct<country:string>"
    )
    path = str(tmp_path / "listings")
    df.write.parquet(path)
    kept = filter_country(spark.read.parquet(path), ["Canada"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "address.country" in plan and "PushedFilters" in plan
    assert [r.listing_id for r in kept.collect()] == [1]


def test_filter_nested_on_map_and_struct(spark):
    df = spark.createDataFrame([(1, '{"k": 9}'), (2, '{"k": 10}')], "id long, props string")
    kept = filter_nested(df, "props", "k", [9], fmt="json", value_type="k long", parsed_col="parsed")
    assert [r.id for r in kept.collect()] == [1]


def test_json_extract_key_exists(spark):
    df = spark.createDataFrame(
        [(1, '[{"comments": "a"}, {"x": 1}, {"comments": null}]', '{"review_scores_value": 9.5}'),
         (2, "not json", "{}"),
         (3, None, None)],
        "listing_id long, reviews string, review_scores string",
    )
    rows = explode_reviews(parse_listings(df, fmt="json")).orderBy("listing_id", "review_pos").collect()
    assert [(r.listing_id, r.review_pos, r.Review, r.Review_Score) for r in rows] == [
        (1, 0, "a", "9.5"),
        (1, 1, None, "9.5"),
    ]


def test_compare_countries(spark):
    df = spark.createDataFrame(
        [("Canada", 9.0), ("Canada", 10.0), ("Australia", 8.0), ("Spain", 1.0)], "country string, score double"
    )
    rows = {r.country: r for r in compare_countries(df, ["Canada", "Australia"], value_col="score").collect()}
    assert set(rows) == {"Canada", "Australia"}
    assert rows["Canada"].n_rows == 2 and rows["Canada"].mean_value == 9.5
    assert F is not None


def test_json_rows_keep_their_prefix_and_report(spark):
    rows = [
        (1, '[{"comments": "a"}, 5, {"comments": "z"}]', '{"review_scores_value": 9}'),
        (2, '[{"comments": "a"}, {"x": 1}, {"comments": null}]', '{"review_scores_value": 9.5}'),
        (3, '[{"comments": "a"}]', "[1]"),
        (4, "{bad", "{bad"),
        (5, None, None),
        (6, '{"comments": "a"}', "{}"),
        (7, '["comments"]', "{}"),
        (8, "[]", "{}"),
    ]
    parsed = parse_listings(spark.createDataFrame(rows, "listing_id long, reviews string, review_scores string"), fmt="json")
    got = sorted((r.listing_id, r.review_pos, r.Review, r.Review_Score) for r in explode_reviews(parsed).collect())
    assert got == [(1, 0, "a", "9"), (2, 0, "a", "9.5"), (2, 1, None, "9.5")]
    errors = {r.listing_id: (r.error.split(":")[0], r.reviews_kept) for r in extraction_errors(parsed).collect()}
    assert errors == {1: ("TypeError", 1), 3: ("TypeError", 0), 6: ("TypeError", 0), 7: ("TypeError", 0)}
