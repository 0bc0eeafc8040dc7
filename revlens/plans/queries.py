"""Registered queries over the shared test tables, with SQL oracles.

Each query runs a revlens operator over whole tables (see
``revlens.plans.tables`` for how the tables map onto listings and
reviews) and returns a DataFrame. ``ORACLES`` holds the same result as
plain SQL over the raw tables, so an independent engine can check it.
Column names and types match between the two forms.

The scoring model in these queries is the ``LengthScorer`` test double
and translation uses ``PrefixTranslator``: both are deterministic, so
the checks verify the Spark plumbing (templating, Arrow transfer,
dedup and join-back, parsing, aggregation), not model quality.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import comma_decimal, fmt2, parse_comma_decimal
from revlens.operators.classify import compare_methods, generative_metrics
from revlens.operators.inference import LengthScorer, PrefixTranslator, score, translate
from revlens.operators.listings import (
    compare_countries,
    count_rows,
    explode_reviews,
    extraction_errors,
    filter_country,
    filter_nested,
    parse_listings,
)
from revlens.operators.prompts import DEFAULT_PROMPTS, TRANSLATE_TEMPLATE, Prompt, with_prompts
from revlens.operators.sampling import exact_split, first_rows
from revlens.operators.scoring import best_prompt, deviation, real_score, summary
from revlens.plans.evaluate import evaluate
from revlens.plans.tables import document_reviews, scored_reviews, listings, table
from revlens.schemas import NA_TOKENS, PRED_COL, REVIEW_COL, SCORE_COL
from revlens.session import new_stage_path
from revlens.sources.csv import load_reviews, read_csv, write_csv
from revlens.sources.stage import materialize

# Fixed values shared with the oracles below.
ANCHOR_PROMPTS = (
    Prompt(0, "en", "Score 1 to 10: {review}"),
    Prompt(1, "en", "Rate it. {review}"),
    Prompt(2, "en", "{review} -> score?"),
)
COUNTRIES = ("es", "fr")
EVENT_KEYS = (9, 99)
FIRST_N = 250
SEED = 42
TEST_SIZE = 0.2

QueryFn = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Stages 1-2: nested filter, parse, explode
# ---------------------------------------------------------------------------


def q_nested_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + N1 (JSON): events whose props.k is in a list."""
    events = table(spark, sf_dir, "events")
    kept = filter_nested(events, "props", "k", EVENT_KEYS, fmt="json", value_type="k long", parsed_col="parsed")
    return kept.select("event_id", "user_id", "event_type", F.col("parsed.k").alias("k"))


def q_nested_filter_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + N1 (Python literal, strict): the same filter, parsed by
    the literal parser (a JSON object is also a Python dict literal)."""
    from pyspark.sql import types as T

    events = table(spark, sf_dir, "events")
    kept = filter_nested(
        events, "props", "k", EVENT_KEYS, fmt="python_literal",
        value_type=T.StructType([T.StructField("k", T.LongType())]), parsed_col="parsed",
    )
    return kept.select("event_id", "user_id", "event_type", F.col("parsed.k").alias("k"))


def q_country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + N1 + P7: listings whose address country is es or fr."""
    kept = filter_country(listings(spark, sf_dir), COUNTRIES, parsed_col="place")
    return kept.select("listing_id", F.col("place.country").alias("country"), "n_chars")


def q_filtered_listings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + S3 (stage 1 as a job): the listings of es and fr, all columns and
    all address keys, through a minimally quoted CSV."""
    path = new_stage_path(spark, "filtered-listings")
    write_csv(filter_country(listings(spark, sf_dir), COUNTRIES), path)
    back = read_csv(spark, path)
    return back.select(F.col("listing_id").cast("long").alias("listing_id"), "address", "review_scores", F.col("n_chars").cast("long").alias("n_chars"))


def q_struct_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + S5: an address that is a struct already is filtered as it is,
    and a nested column goes to CSV as JSON text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.struct(F.col("lang").alias("country"), F.col("source").alias("market")).alias("address"))
    path = new_stage_path(spark, "struct-listings")
    write_csv(filter_country(docs, COUNTRIES), path)
    return read_csv(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "address")

def q_literal_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 + N3 + N4 + N5 + N6 + P3 + P4: every review line of every
    listing with the listing's score, parsed from Python-literal text."""
    return explode_reviews(parse_listings(listings(spark, sf_dir)))


def q_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same extraction from JSON text, parsed natively."""
    return explode_reviews(parse_listings(listings(spark, sf_dir, fmt="json"), fmt="json"))


def _odd(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    return parse_listings(listings(spark, sf_dir, fmt=fmt, odd=True), fmt=fmt)


def q_literal_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + N6: reviews of lists that hold an element without the key and one
    that stops the row, Python literals."""
    return explode_reviews(_odd(spark, sf_dir, "python_literal"))


def q_json_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from JSON."""
    return explode_reviews(_odd(spark, sf_dir, "json"))


def q_literal_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N6 side table: the rows that stopped, and the reviews kept."""
    return extraction_errors(_odd(spark, sf_dir, "python_literal")).select("listing_id", "reviews_kept")


def q_json_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from JSON."""
    return extraction_errors(_odd(spark, sf_dir, "json")).select("listing_id", "reviews_kept")


def q_review_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews counted while they are written."""
    path = new_stage_path(spark, "counted")
    observed, seen = count_rows(explode_reviews(parse_listings(listings(spark, sf_dir, fmt="json"), fmt="json")), "written")
    observed.write.parquet(path)
    return spark.read.parquet(path).agg(F.lit(seen.get["rows"]).cast("long").alias("observed"), F.count(F.lit(1)).alias("written"))


def q_missing_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: texts that are missing tokens, or nearly, through CSV."""
    tokens = F.array(*(F.lit(t) for t in (*NA_TOKENS, " NA", "na", "Null", "0")))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.get(tokens, (F.col("doc_id") % (len(NA_TOKENS) + 4)).cast("int")).alias("text"))
    path = new_stage_path(spark, "tokens")
    write_csv(docs, path)
    return read_csv(spark, path, schema="doc_id string, text string").select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def q_compare_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: reviews and mean listing score per country (es, fr), through
    the whole stage 1-2 pipeline (filter, parse, explode)."""
    kept = filter_country(listings(spark, sf_dir), COUNTRIES, parsed_col="place")
    parsed = parse_listings(kept, keep=["place"])
    reviews = explode_reviews(parsed, keep=["place"]).select(
        F.col("place.country").alias("country"),
        parse_comma_decimal(SCORE_COL).alias("score"),
    )
    return compare_countries(reviews, COUNTRIES, "country", "score")


def q_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F4: number -> decimal-comma text -> number."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    text = cust.withColumn("acctbal_text", comma_decimal("c_acctbal"))
    return text.select("c_custkey", "acctbal_text", parse_comma_decimal("acctbal_text").alias("acctbal"))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S4: write documents as fully quoted CSV to the stage
    folder and read them back (quotes, newlines, missing tokens)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = new_stage_path(spark, "csv-roundtrip")
    write_csv(docs, path, quote_all=True)
    back = read_csv(spark, path, schema="doc_id string, text string, lang string")
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


# ---------------------------------------------------------------------------
# Sampling
# ---------------------------------------------------------------------------


def q_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the first 250 documents in id order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return first_rows(docs, FIRST_N, ["doc_id"])


def q_exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document tagged dev/test, exactly ceil(0.2 n) test."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return exact_split(docs, "doc_id", TEST_SIZE, SEED)


# ---------------------------------------------------------------------------
# Prompts and scoring
# ---------------------------------------------------------------------------


def q_prompt_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + F6: every document under every prompt; rendered length."""
    docs = document_reviews(spark, sf_dir)
    crossed = with_prompts(docs, ANCHOR_PROMPTS)
    return crossed.select(
        F.col("listing_id").alias("doc_id"), "prompt_id", F.length("prompt_text").alias("prompt_chars")
    )


def _scored(spark: SparkSession, sf_dir: str, prompts=ANCHOR_PROMPTS) -> DataFrame:
    return score(scored_reviews(spark, sf_dir), LengthScorer, prompts)


def q_prompt_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + F6 + I2 + F2 + F3 + A1 + A7: deviation per prompt."""
    return deviation(_scored(spark, sf_dir))


def q_best_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the prompt with the lowest deviation."""
    return best_prompt(deviation(_scored(spark, sf_dir)))


def q_test_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + A3 + A4: means and deviation for prompt 0 over all rows."""
    return summary(_scored(spark, sf_dir, ANCHOR_PROMPTS[0]))


def q_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + I5: split labelled reviews, pick the prompt on dev, report
    it on test. One row."""
    ev = evaluate(
        scored_reviews(spark, sf_dir), LengthScorer, ANCHOR_PROMPTS,
        limit=-1, test_size=TEST_SIZE, seed=SEED, key=("listing_id",),
    )
    n_dev = next(r["n_rows"] for r in ev.deviations if r["prompt_id"] == ev.prompt.prompt_id)
    real = real_score(ev.test, SCORE_COL)
    pred = F.col(PRED_COL)
    return ev.test.agg(
        F.lit(ev.prompt.prompt_id).alias("best_prompt_id"),
        F.lit(ev.dev_mae).alias("dev_mae"),
        F.lit(n_dev).cast("long").alias("n_dev"),
        F.count(F.lit(1)).alias("n_test"),
        F.avg(real).alias("media_real"),
        F.avg(pred).alias("media_predicha"),
        F.avg(F.abs(real - pred)).alias("desviacion"),
    )


def q_csv_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + L1 over the two-column CSV hand-off: reviews written in id
    order, read back with their file positions, the first 250 evaluated."""
    ordered = scored_reviews(spark, sf_dir).orderBy("listing_id").select(REVIEW_COL, SCORE_COL)
    path = new_stage_path(spark, "review-hand-off")
    write_csv(ordered, path, quote_all=True)
    reviews = load_reviews(spark, path)
    ev = evaluate(reviews, LengthScorer, ANCHOR_PROMPTS, limit=FIRST_N, test_size=TEST_SIZE, seed=SEED)
    both = ev.dev.select(REVIEW_COL, SCORE_COL).unionByName(ev.test.select(REVIEW_COL, SCORE_COL))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length(REVIEW_COL)).alias("review_chars"), F.avg(real_score(both, SCORE_COL)).alias("media_real"),
        F.lit(ev.test.count()).cast("long").alias("n_test"),
    )


def q_default_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + I2: every document scored with the three default prompts."""
    scored = score(scored_reviews(spark, sf_dir), LengthScorer, DEFAULT_PROMPTS)
    return scored.select(F.col("listing_id").alias("doc_id"), "prompt_id", "response", PRED_COL)


def q_report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each prompt's deviation as the report prints it."""
    rows = [(r["prompt_id"], fmt2(r["mae"])) for r in deviation(_scored(spark, sf_dir)).collect()]
    return spark.createDataFrame(rows, "prompt_id int, shown string")


# ---------------------------------------------------------------------------
# Translation
# ---------------------------------------------------------------------------


def q_translate_prompted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 with the real template: what the model is given for every document."""
    out = translate(document_reviews(spark, sf_dir), PrefixTranslator)
    return out.select(F.col("listing_id").alias("doc_id"), REVIEW_COL)


def q_dedup_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + P5: every document translated; equal texts answered once."""
    docs = document_reviews(spark, sf_dir)
    out = translate(docs, PrefixTranslator, template="{review}")
    return out.select(F.col("listing_id").alias("doc_id"), REVIEW_COL)


def q_translate_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: only the first 250 documents translated, all returned."""
    docs = document_reviews(spark, sf_dir)
    out = translate(docs, PrefixTranslator, template="{review}", limit=FIRST_N, order_by=("listing_id",))
    return out.select(F.col("listing_id").alias("doc_id"), REVIEW_COL)


# ---------------------------------------------------------------------------
# Classical vs generative
# ---------------------------------------------------------------------------


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, split; written once, narrow."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("listing_id"), "quality")
    rows = document_reviews(spark, sf_dir).join(labels, "listing_id").select("listing_id", REVIEW_COL, "quality")
    rows = materialize(rows, "labelled")
    split = exact_split(rows.select("listing_id"), "listing_id", TEST_SIZE, SEED, flag="part")
    return rows.join(split, "listing_id")


def _score_to_label(score_col):
    return F.when(score_col >= 5.5, 1.0).when(score_col.isNotNull(), 0.0)


def _label_to_score(label: float) -> float:
    return label * 9 + 1


def _generative(tagged: DataFrame) -> DataFrame:
    """D2, generative side: prompt 0 on the test rows."""
    began = time.perf_counter()
    scored = score(tagged.where(F.col("part") == "test"), LengthScorer, ANCHOR_PROMPTS[0])
    found = generative_metrics(scored, PRED_COL, "quality", _score_to_label, _label_to_score)
    return found.withColumn("seconds", F.lit(time.perf_counter() - began))


def q_generative_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generative predictions measured like a classifier's."""
    return _generative(_tagged(spark, sf_dir)).drop("seconds", "n_predicted", "majority")


def compare_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2: every method on the same held-out rows, with its seconds."""
    tagged = materialize(_tagged(spark, sf_dir), "tagged")
    dev, test = (tagged.where(F.col("part") == p) for p in ("dev", "test"))
    # classical training and generative scoring are independent jobs:
    # submitted from two threads, Spark runs them side by side
    with ThreadPoolExecutor(max_workers=2) as pool:
        classical = pool.submit(compare_methods, dev, test, REVIEW_COL, "quality", ("svm", "random_forest"), label_to_score=_label_to_score, min_doc_freq=5)
        generative = pool.submit(_generative, tagged)
        return classical.result().unionByName(generative.result())


def q_classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of each trained classifier on the held-out rows:
    it predicts both classes and is no worse than the larger class."""
    found = compare_all(spark, sf_dir).where("method <> 'generative'")
    return found.select(
        "method", "n_test", "majority", (F.col("n_predicted") == 2).alias("both_classes"), (F.col("accuracy") >= F.col("majority")).alias("beats_majority")
    )


QUERIES: dict[str, QueryFn] = {
    "nested_filter": q_nested_filter,
    "nested_filter_literal": q_nested_filter_literal,
    "country_filter": q_country_filter,
    "literal_extract": q_literal_extract,
    "json_extract": q_json_extract,
    "compare_countries": q_compare_countries,
    "decimal_comma": q_decimal_comma,
    "csv_roundtrip": q_csv_roundtrip,
    "first_rows": q_first_rows,
    "exact_split": q_exact_split,
    "prompt_cross": q_prompt_cross,
    "prompt_deviation": q_prompt_deviation,
    "best_prompt": q_best_prompt,
    "test_summary": q_test_summary,
    "evaluate": q_evaluate,
    "dedup_translate": q_dedup_translate,
    "translate_first_n": q_translate_first_n,
    "classifier_metrics": q_classifier_metrics,
    "generative_metrics": q_generative_metrics,
    "filtered_listings_csv": q_filtered_listings_csv,
    "struct_filter": q_struct_filter,
    "literal_prefix": q_literal_prefix,
    "json_prefix": q_json_prefix,
    "literal_errors": q_literal_errors,
    "json_errors": q_json_errors,
    "review_count": q_review_count,
    "missing_tokens": q_missing_tokens,
    "csv_evaluate": q_csv_evaluate,
    "default_prompts": q_default_prompts,
    "report_numbers": q_report_numbers,
    "translate_prompted": q_translate_prompted,
}


# ---------------------------------------------------------------------------
# Oracles (DuckDB SQL over the raw tables)
# ---------------------------------------------------------------------------

_PROMPTS_SQL = "(VALUES " + ", ".join(
    f"({p.prompt_id}, '{p.template}')" for p in ANCHOR_PROMPTS
) + ") AS p(prompt_id, template)"

def _sql_text(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


_NA_SQL = "(" + ", ".join(map(_sql_text, NA_TOKENS)) + ")"
_TOKENS_SQL = "[" + ", ".join(map(_sql_text, (*NA_TOKENS, " NA", "na", "Null", "0"))) + "]"
_DEFAULT_PROMPTS_SQL = "(VALUES " + ", ".join(f"({p.prompt_id}, {_sql_text(p.template)})" for p in DEFAULT_PROMPTS) + ") AS p(prompt_id, template)"

_LINES_SQL = """
    SELECT d.doc_id AS listing_id,
           CAST(generate_subscripts(string_split(d.text, chr(10)), 1) - 1 AS INTEGER) AS review_pos,
           unnest(string_split(d.text, chr(10))) AS "Review",
           CAST(l.quality * 9 + 1 AS VARCHAR) AS "Review_Score",
           d.lang AS lang
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

_SCORED_SQL = f"""
    WITH r AS (
        SELECT d.doc_id AS listing_id, d.text AS review, CAST(l.quality * 9 + 1 AS DOUBLE) AS real
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ),
    x AS (
        SELECT r.*, p.prompt_id, length(replace(p.template, '{{review}}', r.review)) AS m
        FROM r CROSS JOIN {_PROMPTS_SQL}
    ),
    s AS (
        SELECT *, CASE WHEN m % 7 = 0 THEN NULL ELSE CAST(m % 11 AS DOUBLE) END AS pred FROM x
    )
"""

_DEVIATION_SQL = _SCORED_SQL + """
    SELECT prompt_id, avg(abs(real - pred)) AS mae, count(*) AS n_rows,
           count(pred) AS n_numeric, count(*) - count(pred) AS n_bad, 0::BIGINT AS n_failed
    FROM s GROUP BY prompt_id
"""

_SPLIT_SQL = """
    WITH h AS (
        SELECT doc_id, ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h
        FROM documents
    ),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) AS rn, count(*) OVER () AS n FROM h)
    SELECT doc_id, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'dev' END AS split FROM r
"""

_EVALUATE_SQL = f"""
    WITH r AS (
        SELECT d.doc_id AS listing_id, d.text AS review, CAST(l.quality * 9 + 1 AS DOUBLE) AS real
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ),
    h AS (
        SELECT *, ('0x' || substr(md5('42:' || CAST(listing_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM r
    ),
    o AS (SELECT *, row_number() OVER (ORDER BY h, listing_id) AS rn, count(*) OVER () AS n FROM h),
    t AS (SELECT *, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'dev' END AS part FROM o),
    x AS (
        SELECT t.*, p.prompt_id, length(replace(p.template, '{{review}}', t.review)) AS m
        FROM t CROSS JOIN {_PROMPTS_SQL}
    ),
    s AS (SELECT *, CASE WHEN m % 7 = 0 THEN NULL ELSE CAST(m % 11 AS DOUBLE) END AS pred FROM x),
    dev AS (
        SELECT prompt_id, avg(abs(real - pred)) AS mae, count(*) AS n_rows
        FROM s WHERE part = 'dev' GROUP BY prompt_id
    ),
    best AS (SELECT * FROM dev WHERE mae IS NOT NULL ORDER BY mae, prompt_id LIMIT 1),
    test AS (SELECT s.* FROM s JOIN best ON s.prompt_id = best.prompt_id WHERE s.part = 'test')
    SELECT best.prompt_id AS best_prompt_id, best.mae AS dev_mae, best.n_rows AS n_dev,
           count(*) AS n_test, avg(test.real) AS media_real, avg(test.pred) AS media_predicha,
           avg(abs(test.real - test.pred)) AS desviacion
    FROM test CROSS JOIN best
    GROUP BY best.prompt_id, best.mae, best.n_rows
"""

_ODD_SQL = f"""
    WITH lines AS ({_LINES_SQL}),
    n AS (SELECT listing_id, count(*) AS n FROM lines GROUP BY listing_id)
"""

# part 'test' of the labelled documents, with prompt 0's answer and label
_GENERATIVE_SQL = f"""
    WITH r AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    h AS (SELECT *, ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM r),
    o AS (SELECT *, row_number() OVER (ORDER BY h, doc_id) AS rn, count(*) OVER () AS n FROM h),
    t AS (SELECT *, length(replace({_sql_text(ANCHOR_PROMPTS[0].template)}, '{{review}}', text)) AS m FROM o WHERE rn <= ceil(0.2 * n)),
    p AS (SELECT quality AS y, CASE WHEN m % 7 = 0 THEN NULL WHEN m % 11 >= 5.5 THEN 1 ELSE 0 END AS p FROM t)
"""

ORACLES: dict[str, str] = {
    "nested_filter": """
        SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IN (9, 99)
    """,
    "nested_filter_literal": """
        SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IN (9, 99)
    """,
    "country_filter": """
        SELECT doc_id AS listing_id, lang AS country, n_chars FROM documents WHERE lang IN ('es', 'fr')
    """,
    "literal_extract": f"""
        SELECT listing_id, review_pos, "Review", "Review_Score" FROM ({_LINES_SQL})
    """,
    "json_extract": f"""
        SELECT listing_id, review_pos, "Review", "Review_Score" FROM ({_LINES_SQL})
    """,
    "compare_countries": f"""
        SELECT lang AS country, count(*) AS n_rows, avg(CAST("Review_Score" AS DOUBLE)) AS mean_value
        FROM ({_LINES_SQL}) WHERE lang IN ('es', 'fr') GROUP BY lang
    """,
    "decimal_comma": """
        SELECT c_custkey, replace(CAST(c_acctbal AS VARCHAR), '.', ',') AS acctbal_text, c_acctbal AS acctbal
        FROM customer
    """,
    "csv_roundtrip": f"""
        SELECT doc_id, CASE WHEN text IN {_NA_SQL} THEN NULL ELSE text END AS text,
               CASE WHEN lang IN {_NA_SQL} THEN NULL ELSE lang END AS lang
        FROM documents
    """,
    "first_rows": """
        SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 250
    """,
    "exact_split": _SPLIT_SQL,
    "prompt_cross": f"""
        SELECT d.doc_id, p.prompt_id, CAST(length(replace(p.template, '{{review}}', d.text)) AS INTEGER) AS prompt_chars
        FROM documents d CROSS JOIN {_PROMPTS_SQL}
    """,
    "prompt_deviation": _DEVIATION_SQL,
    "best_prompt": f"""
        SELECT prompt_id, mae FROM ({_DEVIATION_SQL}) WHERE mae IS NOT NULL ORDER BY mae, prompt_id LIMIT 1
    """,
    "test_summary": _SCORED_SQL + """
        SELECT avg(real) AS media_real, avg(pred) AS media_predicha, avg(abs(real - pred)) AS desviacion
        FROM s WHERE prompt_id = 0
    """,
    "evaluate": _EVALUATE_SQL,
    "dedup_translate": """
        SELECT doc_id, '[en] ' || text AS "Review" FROM documents
    """,
    "translate_first_n": """
        SELECT doc_id,
               CASE WHEN doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 250)
                    THEN '[en] ' || text ELSE text END AS "Review"
        FROM documents
    """,
    "filtered_listings_csv": """
        SELECT d.doc_id AS listing_id, '{' || q || 'country' || q || ': ' || q || d.lang || q || ', ' || q || 'market' || q || ': ' || q || d.source || q || '}' AS address,
               CASE WHEN l.quality IS NULL THEN '{}' ELSE '{' || q || 'review_scores_value' || q || ': ' || CAST(l.quality * 9 + 1 AS VARCHAR) || '}' END AS review_scores,
               d.n_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id CROSS JOIN (SELECT chr(39) AS q) WHERE d.lang IN ('es', 'fr')
    """,
    "struct_filter": """
        SELECT doc_id, '{"country":"' || lang || '","market":"' || source || '"}' AS address FROM documents WHERE lang IN ('es', 'fr')
    """,
    "literal_prefix": f"""
        SELECT listing_id, review_pos, "Review", "Review_Score" FROM ({_LINES_SQL})
    """,
    "json_prefix": f"""
        SELECT listing_id, review_pos, "Review", "Review_Score" FROM ({_LINES_SQL})
    """,
    "literal_errors": _ODD_SQL + "SELECT listing_id, CAST(n AS INTEGER) AS reviews_kept FROM n WHERE listing_id % 5 = 0",
    "json_errors": _ODD_SQL + "SELECT listing_id, CAST(n AS INTEGER) AS reviews_kept FROM n WHERE listing_id % 5 = 0",
    "review_count": f"""
        SELECT count(*) AS observed, count(*) AS written FROM ({_LINES_SQL})
    """,
    "missing_tokens": f"""
        WITH t AS (SELECT doc_id, {_TOKENS_SQL}[1 + doc_id % {len(NA_TOKENS) + 4}] AS text FROM documents)
        SELECT doc_id, CASE WHEN text IN {_NA_SQL} THEN NULL ELSE text END AS text FROM t
    """,
    "csv_evaluate": """
        WITH r AS (
            SELECT d.text, CAST(l.quality * 9 + 1 AS DOUBLE) AS real FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
            ORDER BY d.doc_id LIMIT 250
        )
        SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS review_chars, avg(real) AS media_real,
               CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_test
        FROM r
    """,
    "default_prompts": f"""
        WITH x AS (
            SELECT d.doc_id, p.prompt_id, length(replace(p.template, '{{review}}', d.text)) AS m FROM documents d CROSS JOIN {_DEFAULT_PROMPTS_SQL}
        )
        SELECT doc_id, prompt_id, CASE WHEN m % 7 = 0 THEN (m % 11) || '/10' ELSE CAST(m % 11 AS VARCHAR) END AS response,
               CASE WHEN m % 7 = 0 THEN NULL ELSE CAST(m % 11 AS DOUBLE) END AS predicho
        FROM x
    """,
    "report_numbers": f"""
        SELECT prompt_id, printf('%.2f', mae) AS shown FROM ({_DEVIATION_SQL})
    """,
    "translate_prompted": f"""
        SELECT doc_id, trim('[en] ' || replace({_sql_text(TRANSLATE_TEMPLATE)}, '{{review}}', text), ' ' || chr(10)) AS "Review" FROM documents
    """,
    "generative_metrics": _GENERATIVE_SQL + """
        , s AS (SELECT c AS c, count(*) FILTER (y = c) AS sup, count(*) FILTER (p = c) AS said, count(*) FILTER (y = c AND p = c) AS hits
                FROM p, (VALUES (0), (1)) AS k(c) GROUP BY c)
        SELECT 'generative' AS method, (SELECT count(*) FROM p) AS n_test, (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM p) AS accuracy,
               sum(CAST(sup AS DOUBLE) * CASE WHEN hits = 0 THEN 0 ELSE 2.0 * hits / (said + sup) END) / (SELECT count(*) FROM p) AS f1,
               (SELECT avg(CASE WHEN y = p THEN 0.0 ELSE 9.0 END) FROM p) AS mae
        FROM s
    """,
    "classifier_metrics": _GENERATIVE_SQL + """
        SELECT m AS method, (SELECT count(*) FROM p) AS n_test,
               (SELECT greatest(avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END), avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END)) FROM p) AS majority,
               true AS both_classes, true AS beats_majority
        FROM (VALUES ('svm'), ('random_forest')) AS k(m)
    """,
}
