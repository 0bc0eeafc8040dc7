from revlens.schemas import NA_TOKENS
from revlens.sources.csv import read_csv, write_csv


def test_na_tokens_are_pandas_defaults():
    assert len(NA_TOKENS) == 19 and "" in NA_TOKENS and "None" in NA_TOKENS
    assert "none" not in NA_TOKENS and "  " not in NA_TOKENS


def test_round_trip_is_exact(spark, tmp_path):
    texts = ['he said ""hi""\nand left', 'a "quoted", comma', "none", "  ", "", None] + list(NA_TOKENS)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for quote_all in (True, False):
        path = str(tmp_path / f"out_{quote_all}")
        write_csv(df, path, quote_all=quote_all)
        back = {int(r.id): r.t for r in read_csv(spark, path).collect()}
        for i, t in enumerate(texts):
            expected = None if t is None or t in NA_TOKENS else t
            assert back[i] == expected, (quote_all, t)


def test_decimal_comma_and_nested_columns(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "9.5", ("Canada",))], "Review string, Review_Score string, address struct<country:string>"
    )
    path = str(tmp_path / "c")
    write_csv(df, path, quote_all=True, comma_columns={"Review_Score": "Review_Score"}, single_file=True)
    text = "".join(open(p, encoding="utf-8").read() for p in __import__("glob").glob(path + "/*.csv"))
    assert '"9,5"' in text and '{""country"":""Canada""}' in text


def test_empty_result_keeps_header(spark, tmp_path):
    df = spark.createDataFrame([], "Review string, Review_Score string")
    path = str(tmp_path / "empty")
    write_csv(df, path, single_file=True)
    back = read_csv(spark, path)
    assert back.columns == ["Review", "Review_Score"] and back.count() == 0
