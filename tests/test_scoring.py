import pytest

from revlens.operators.scoring import best_prompt, deviation, pick_best, summary


def test_deviation_skips_missing_pairs(spark):
    df = spark.createDataFrame(
        [(0, "1", 2.0, "2"), (0, None, 5.0, "5"), (0, "3", None, "x")],
        "prompt_id int, Review_Score string, predicho double, response string",
    )
    row = deviation(df).first()
    assert row.mae == 1.0 and row.n_rows == 3 and row.n_numeric == 2 and row.n_bad == 1


def test_decimal_comma_real_scores(spark):
    df = spark.createDataFrame([(0, "9,5", 9.0, "9")], "prompt_id int, Review_Score string, predicho double, response string")
    assert deviation(df).first().mae == 0.5


def test_all_non_numeric_never_chosen(spark):
    dev = spark.createDataFrame([(0, None), (1, 2.0), (2, 3.0)], "prompt_id int, mae double")
    assert pick_best(dev.collect()) == (1, 2.0)


def test_tie_goes_to_first_prompt(spark):
    dev = spark.createDataFrame([(2, 1.5), (0, 1.5), (1, 2.0)], "prompt_id int, mae double")
    assert best_prompt(dev).first().prompt_id == 0


def test_every_prompt_null_is_an_error(spark):
    dev = spark.createDataFrame([(0, None), (1, None)], "prompt_id int, mae double")
    assert best_prompt(dev).count() == 0
    with pytest.raises(ValueError):
        pick_best(dev.collect())


def test_summary_means_over_own_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, None)], "Review_Score double, predicho double")
    row = summary(df).first()
    assert row.media_real == 2.0 and row.media_predicha == 3.5 and row.desviacion == 1.0
