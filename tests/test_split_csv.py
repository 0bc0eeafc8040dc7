import random

import pytest

from revlens.plans.extract import run_extract
from revlens.schemas import NA_TOKENS
from revlens.sources.csv import load_reviews, read_csv, write_csv
from revlens.sources.split_csv import read_csv_ranges


def texts(n=400, seed=5):
    rng = random.Random(seed)
    parts = ["a", "b c", ",", '"', '""', "\n", "\r\n", "\n\n", "é…", "x" * 60, "'", "\\", " ", "NA"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    return [*out, *NA_TOKENS, None, "", '"', "\n", "line\n" * 400, "q" * 3000 + '"' + "\n" * 50]


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("quote_all", [True, False])
@pytest.mark.parametrize("split", [64, 500, 1 << 20])
def test_ranges_give_what_one_task_gives(spark, tmp_path, split, quote_all):
    df = spark.createDataFrame([(i, t, f"c{i}") for i, t in enumerate(texts())], "id long, text string, `other, one` string")
    path = str(tmp_path / "x")
    write_csv(df, path, quote_all=quote_all, single_file=True)
    for missing in (True, False):
        want = read_csv(spark, path, missing_tokens=missing)
        got = read_csv_ranges(spark, path, missing_tokens=missing, split_bytes=split)
        assert got.columns == want.columns
        assert bag(got) == bag(want)


def test_positions_follow_the_file(spark, tmp_path):
    rows = texts(300)
    path = str(tmp_path / "x")
    write_csv(spark.createDataFrame(list(enumerate(rows)), "id long, text string").coalesce(1), path, single_file=True)
    got = read_csv_ranges(spark, path, split_bytes=200, position="position").orderBy("position").collect()
    assert [int(r.id) for r in got] == list(range(len(rows)))
    assert len({r.position for r in got}) == len(rows)


def test_listings_and_reviews_by_ranges(spark, tmp_path):
    rows = [(f"{{'country': 'Canada', 'n': {i}}}", f"[{{'comments': 'a\\n{i}'}}, {{'comments': \"b, \"}}]", "{'review_scores_value': 9.5}") for i in range(80)]
    path = str(tmp_path / "x")
    write_csv(spark.createDataFrame(rows, "address string, reviews string, review_scores string"), path, single_file=True)
    out = run_extract(spark, path, str(tmp_path / "out"), split_bytes=300)
    got = out.reviews.orderBy("listing_id", "review_pos").collect()
    assert [r.Review for r in got] == [x for i in range(80) for x in (f"a\n{i}", "b, ")] and out.rows_written == 160
    write_csv(out.reviews.orderBy("listing_id", "review_pos").select("Review", "Review_Score"), str(tmp_path / "r"), quote_all=True, single_file=True)
    back = load_reviews(spark, str(tmp_path / "r"), split_bytes=200)
    assert [r.Review for r in back.orderBy("listing_id").collect()] == [r.Review for r in got] and back.schema["review_pos"].dataType.simpleString() == "int"


def test_one_file_is_read_in_many_tasks(spark, tmp_path):
    path = str(tmp_path / "x")
    write_csv(spark.createDataFrame(list(enumerate(texts())), "id long, text string"), path, single_file=True)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    session.conf.set("spark.sql.files.openCostInBytes", 0)
    session.conf.set("spark.sql.files.minPartitionNum", 1)
    assert session.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 10


@pytest.mark.parametrize("split", [3, 7, 1 << 20])
def test_files_written_elsewhere(spark, tmp_path, split):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "a.csv").write_bytes('id,text\r\n1,"a\r\nb"\r\n\r\n2,"c""d"\r\n3,\r\n4,""'.encode())
    (folder / "b.csv").write_bytes('id,text\n5,"x,\n\ny"\n'.encode())
    (folder / "c.csv").write_bytes(b"id,text\n")
    got = read_csv_ranges(spark, str(folder), missing_tokens=False, split_bytes=split)
    assert bag(got) == [("1", "a\r\nb"), ("2", 'c"d'), ("3", None), ("4", None), ("5", "x,\n\ny")]
    # the reader of whole files makes LF of CRLF within quotes, as it is the file's line end
    assert bag(got) == [(i, t if i != "1" else t.replace("\n", "\r\n")) for i, t in bag(read_csv(spark, str(folder), missing_tokens=False))]
    typed = read_csv_ranges(spark, str(folder), schema="id int, text string", split_bytes=split)
    assert sorted(r.id for r in typed.collect()) == [1, 2, 3, 4, 5]
