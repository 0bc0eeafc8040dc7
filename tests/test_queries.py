"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ["customer", "documents", "events", "labels", "conversations", "embeddings", "pages"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# A trained model is judged where its held-out part has some rows of each class.
SF = {"classifier_metrics": "/root/testdata/sf0.01"}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, name):
    sf_dir = SF.get(name, sf_small)
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck(sf_dir).execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _bag(rows, df.columns) == _bag(res.fetchall(), cols)


def test_every_query_has_an_oracle_or_a_reason():
    # training-data operators: learned, tokenised or iterative, see tests/llm
    assert {q for q in set(entry.queries()) - set(entry.oracle_sql()) if not q.startswith("op")} <= {"pipeline"}


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0].n_test > 0


def test_every_method_on_the_same_rows(spark, sf_small):
    from revlens.plans.queries import compare_all

    rows = {r.method: r for r in compare_all(spark, sf_small).collect()}
    assert set(rows) == {"svm", "random_forest", "generative"}
    assert len({(r.n_test, r.majority) for r in rows.values()}) == 1
    for r in rows.values():
        assert r.f1 is not None and r.seconds > 0
