from revlens.streaming.extract import LISTINGS_TEXT_SCHEMA, start_extract_stream


def _drop(spark, folder, rows):
    spark.createDataFrame(rows, LISTINGS_TEXT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_processes_each_file_once(spark, tmp_path):
    src = str(tmp_path / "in")
    out = str(tmp_path / "out")
    chk = str(tmp_path / "chk")
    _drop(spark, src, [
        (1, "{'country': 'Canada'}", "[{'comments': 'a'}, {'comments': 'b'}]", "{'review_scores_value': 9}"),
        (2, "{'country': 'Australia'}", "[{'comments': 'c'}]", "{'review_scores_value': 8}"),
    ])
    q = start_extract_stream(spark, src, out, ["Canada"], checkpoint=chk)
    q.awaitTermination(120)
    assert sorted(r.Review for r in spark.read.parquet(f"{out}/reviews").collect()) == ["a", "b"]

    _drop(spark, src, [(3, "{'country': 'Canada'}", "[{'comments': 'd'}, 5]", "{'review_scores_value': 7}")])
    q = start_extract_stream(spark, src, out, ["Canada"], checkpoint=chk)
    q.awaitTermination(120)
    reviews = spark.read.parquet(f"{out}/reviews")
    assert sorted(r.Review for r in reviews.collect()) == ["a", "b", "d"]
    assert [r.listing_id for r in spark.read.parquet(f"{out}/errors").collect()] == [3]


CSV_FILE = """listing_id,address,reviews,review_scores
7,"{'country': 'Canada'}","[{'comments': 'two\\nlines, ""quoted""'}, {'comments': 'x'}]","{'review_scores_value': 9.5}"
8,"{'country': 'Canada'}",NA,"{'review_scores_value': 7}"
9,"{'country': 'Australia'}","[{'comments': 'y'}]",{}
"""


def test_csv_stream_keeps_quotes_escapes_and_missing_tokens(spark, tmp_path):
    # doubled CSV quotes, an escaped newline inside the literal, an NA token
    src = tmp_path / "csv_in"
    src.mkdir()
    (src / "part-0.csv").write_text(CSV_FILE)
    out = str(tmp_path / "out")
    q = start_extract_stream(spark, str(src), out, ["Canada"], input_format="csv", checkpoint=str(tmp_path / "chk"))
    q.awaitTermination(120)
    rows = sorted((r.listing_id, r.review_pos, r.Review, r.Review_Score) for r in spark.read.parquet(f"{out}/reviews").collect())
    assert rows == [(7, 0, 'two\nlines, "quoted"', "9.5"), (7, 1, "x", "9.5")]


def test_json_stream_reads_natively(spark, tmp_path):
    src = str(tmp_path / "json_in")
    _drop(spark, src, [
        (1, '{"country": "Canada"}', '[{"comments": "a"}, {"other": 1}, {"comments": null}]', '{"review_scores_value": 9}'),
        (2, '{"country": "Australia"}', '[{"comments": "b"}]', '{"review_scores_value": 8}'),
    ])
    out = str(tmp_path / "out")
    q = start_extract_stream(spark, src, out, ["Canada"], fmt="json", checkpoint=str(tmp_path / "chk"))
    q.awaitTermination(120)
    rows = sorted((r.listing_id, r.review_pos, r.Review, r.Review_Score) for r in spark.read.parquet(f"{out}/reviews").collect())
    # A present key with a null value still gives a review
    assert rows == [(1, 0, "a", "9"), (1, 1, None, "9")]


def test_two_streams_with_default_settings_and_a_bad_address(spark, tmp_path):
    for name in ("one", "two"):
        src, out = str(tmp_path / f"{name}_in"), str(tmp_path / f"{name}_out")
        _drop(spark, src, [
            (1, "{'country': 'Canada'}", f"[{{'comments': '{name}'}}]", "{}"),
            (2, "bad(", "[{'comments': 'b'}]", "{}"),
            (3, None, "[{'comments': 'c'}]", "{}"),
        ])
        start_extract_stream(spark, src, out, ["Canada"]).awaitTermination(120)
        assert [r.Review for r in spark.read.parquet(f"{out}/reviews").collect()] == [name]
        assert sorted(r.listing_id for r in spark.read.parquet(f"{out}/bad_addresses").collect()) == [2, 3]
