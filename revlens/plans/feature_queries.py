"""More registered queries, with SQL oracles: typed copies, walked lists,
CSV in byte ranges, stored answers, calls in flight,
keys of any type, intervals, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.operators.answers import compact
from revlens.operators.bootstrap import deviation_intervals, poisson_cuts
from revlens.operators.inference import LengthScorer, PrefixTranslator, score, translate
from revlens.operators.listings import explode_reviews, extraction_errors, filter_country
from revlens.operators.quantiles import SHARES, distances, quantiles, rank_error, sketches
from revlens.operators.sampling import exact_split, first_rows
from revlens.operators.scoring import deviation
from revlens.operators.variants import at_path, parse_variants, with_variants
from revlens.operators.walk import walk_listings
from revlens.plans.queries import _LINES_SQL, _ODD_SQL, _SCORED_SQL, ANCHOR_PROMPTS, COUNTRIES, SEED, TEST_SIZE, QueryFn
from revlens.plans.queries import ORACLES as BASE_ORACLES
from revlens.plans.tables import document_reviews, listings, scored_reviews, table
from revlens.schemas import PRED_COL, REVIEW_COL, SCORE_COL
from revlens.session import new_stage_path, temporary_stages
from revlens.sources.csv import write_csv
from revlens.sources.split_csv import read_csv_ranges
from revlens.sources.stage import materialize, shuffles_dropped

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# ---------------------------------------------------------------------------
# VARIANT copies
# ---------------------------------------------------------------------------


def _typed(spark: SparkSession, sf_dir: str, fmt: str, odd: bool = False) -> DataFrame:
    """The listings as a typed copy, written shredded and read back."""
    return materialize(with_variants(listings(spark, sf_dir, fmt=fmt, odd=odd), ("address", "reviews", "review_scores"), fmt), "typed-listings")


@_query
def q_variant_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 + N3 + N4 + N5 + P3: the reviews, from a typed copy of the literals."""
    return explode_reviews(parse_variants(_typed(spark, sf_dir, "python_literal")))


@_query
def q_variant_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that stopped and why, from a typed copy of the JSON text."""
    return extraction_errors(parse_variants(_typed(spark, sf_dir, "json", odd=True), fmt="json"))


@_query
def q_variant_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: listings of es and fr by the copy's address, with other keys of it,
    the score as a number and the first review, each at its path."""
    kept = filter_country(_typed(spark, sf_dir, "python_literal"), COUNTRIES)
    return kept.select(
        "listing_id", at_path("address", "country").alias("country"), at_path("address", "market").alias("market"),
        at_path("review_scores", "review_scores_value", kind="bigint").alias("score"), at_path("reviews", 0, "comments").alias(REVIEW_COL),
    )


ORACLES["variant_extract"] = f"""
    SELECT listing_id, review_pos, "Review", "Review_Score" FROM ({_LINES_SQL})
"""
ORACLES["variant_errors"] = _ODD_SQL + """
    SELECT listing_id, 'TypeError: an element is not an object' AS error, CAST(n AS INTEGER) AS reviews_kept FROM n WHERE listing_id % 5 = 0
"""
ORACLES["variant_filter"] = """
    SELECT d.doc_id AS listing_id, d.lang AS country, d.source AS market, CAST(l.quality * 9 + 1 AS BIGINT) AS score, string_split(d.text, chr(10))[1] AS "Review"
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IN ('es', 'fr')
"""


# ---------------------------------------------------------------------------
# N3, N4, N5 on lists of any size
# ---------------------------------------------------------------------------


@_query
def q_walked_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 + N4 + N5 + N6: every list walked element by element: its reviews, and
    a row for each listing that stopped."""
    return walk_listings(listings(spark, sf_dir, fmt="json", odd=True), fmt="json", small=0)


@_query
def q_walked_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from Python literals."""
    walked = walk_listings(listings(spark, sf_dir, odd=True), small=0)
    return walked.withColumn("error", F.regexp_extract("error", "^(\\w+):", 1))


_WALKED_SQL = _ODD_SQL + """
    SELECT listing_id, review_pos, "Review", "Review_Score", NULL AS error FROM lines
    UNION ALL
    SELECT n.listing_id, CAST(n AS INTEGER), NULL, CAST(l.quality * 9 + 1 AS VARCHAR), {error} FROM n LEFT JOIN labels l ON n.listing_id = l.doc_id WHERE n.listing_id % 5 = 0
"""
ORACLES["walked_listings"] = _WALKED_SQL.format(error="'TypeError: an element is not an object'")
ORACLES["walked_literals"] = _WALKED_SQL.format(error="'TypeError'")


# ---------------------------------------------------------------------------
# Quoted CSV in byte ranges
# ---------------------------------------------------------------------------


@_query
def q_csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S4: every document through one quoted CSV file each task, read
    back in byte ranges of 256 KB, which cut through texts and their quotes."""
    path = new_stage_path(spark, "ranged-csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path, quote_all=True)
    back = read_csv_ranges(spark, path, split_bytes=256 * 1024)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


ORACLES["csv_ranges"] = BASE_ORACLES["csv_roundtrip"]


# ---------------------------------------------------------------------------
# The answer store, calls in flight
# ---------------------------------------------------------------------------


class NoModel:
    """A backend that must not be asked: every answer is to come from the store."""

    def generate(self, prompts: list[str]) -> list[str]:
        raise RuntimeError(f"asked for {len(prompts)} answers that are stored")


@_query
def q_stored_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + P5 with a store: all documents translated in waves, the store
    compacted, and the same again from its buckets alone."""
    store = new_stage_path(spark, "store")
    docs = document_reviews(spark, sf_dir)
    options = {"template": "{review}", "answer_store": store, "model_id": "prefix"}
    with temporary_stages(spark), shuffles_dropped(spark):  # what stays of it is the store
        translate(docs, PrefixTranslator, wave_prompts=2000, **options).write.format("noop").mode("overwrite").save()
    compact(spark, store)
    out = translate(docs, NoModel, **options)
    return out.select(F.col("listing_id").alias("doc_id"), REVIEW_COL)


@_query
def q_windowed_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + A1 + A7: every document under every prompt, eight calls in flight a task."""
    return deviation(score(scored_reviews(spark, sf_dir), LengthScorer, ANCHOR_PROMPTS, in_flight=8, retries=2))


ORACLES["stored_translate"] = BASE_ORACLES["dedup_translate"]
ORACLES["windowed_deviation"] = BASE_ORACLES["prompt_deviation"]


# ---------------------------------------------------------------------------
# Keys of any sortable type
# ---------------------------------------------------------------------------


@_query
def q_first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 by a timestamp and a text: the first 4,000 events by time and type, through splitters."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "event_id")
    return first_rows(events, 4000, ["ts", "event_type", "event_id"], topk_limit=0, local_limit=500).select("event_id", "event_type")


@_query
def q_text_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 on text keys: every customer, split by name."""
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return exact_split(names, "c_name", TEST_SIZE, SEED, topk_limit=0, local_limit=500).select("c_custkey", "split")


ORACLES["first_events"] = """
    SELECT event_id, event_type FROM events ORDER BY ts, event_type, event_id LIMIT 4000
"""
ORACLES["text_split"] = """
    WITH h AS (SELECT c_custkey, c_name, ('0x' || substr(md5('42:' || c_name), 1, 15))::BIGINT AS h FROM customer),
    r AS (SELECT c_custkey, row_number() OVER (ORDER BY h, c_name) AS rn, count(*) OVER () AS n FROM h)
    SELECT c_custkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'dev' END AS split FROM r
"""


# ---------------------------------------------------------------------------
# A1, A4, A5 with intervals; D2, D3 as distributions
# ---------------------------------------------------------------------------


@_query
def q_deviation_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A5: the interval of each prompt's deviation over 200 Poisson replicates of
    all scored documents, and the share of replicates that it wins."""
    scored = materialize(score(scored_reviews(spark, sf_dir), LengthScorer, ANCHOR_PROMPTS).select("listing_id", "prompt_id", SCORE_COL, PRED_COL), "scored")
    return deviation_intervals(scored, ["listing_id"])


@_query
def q_country_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D2: the lengths of all documents by language, as sketches: for each
    share whether the sketch's value lies within the rank error of it (by exact
    counts), and each language's rows."""
    docs = table(spark, sf_dir, "documents").select("lang", "n_chars")
    found = materialize(sketches(docs, ["lang"], "n_chars"), "sketches")
    wide = quantiles(found)
    values = wide.select("lang", "n", F.explode(F.map_from_arrays(F.array(*(F.lit(s) for s in SHARES)), F.array(*(F.col(f"q{round(100 * s):02d}") for s in SHARES)))).alias("share", "value"))
    ranked = docs.join(F.broadcast(values), "lang").groupBy("lang", "n", "share").agg(F.count_if(F.col("n_chars") < F.col("value")).alias("below"), F.count_if(F.col("n_chars") <= F.col("value")).alias("up_to"))
    slack = rank_error() * F.col("n") + 1
    return ranked.select("lang", "n", "share", ((F.col("below") <= F.col("share") * F.col("n") + slack) & (F.col("up_to") >= F.col("share") * F.col("n") - slack)).alias("within"))


@_query
def q_country_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the distance of each two languages' lengths by their sketches, against
    the exact one: whether they differ by no more than the bound."""
    docs = table(spark, sf_dir, "documents").select("lang", "n_chars")
    near = distances(sketches(docs, ["lang"], "n_chars"), "lang")
    steps = docs.groupBy("lang", "n_chars").agg(F.count("*").alias("many"))
    # exact: every language's share up to each length that occurs
    langs = docs.select("lang").distinct()
    lengths = steps.select("n_chars").distinct()
    every = lengths.join(F.broadcast(langs)).join(steps, ["lang", "n_chars"], "left")
    up_to = F.sum(F.coalesce("many", F.lit(0))).over(Window.partitionBy("lang").orderBy("n_chars")) / F.sum(F.coalesce("many", F.lit(0))).over(Window.partitionBy("lang"))
    shares = every.select("n_chars", "lang", up_to.alias("share"))
    one, other = shares.withColumnRenamed("lang", "one").withColumnRenamed("share", "a"), shares.withColumnRenamed("lang", "other").withColumnRenamed("share", "b")
    exact = one.join(other, "n_chars").where("one < other").groupBy("one", "other").agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("exact"))
    bound = 2 * rank_error() + 1 / 200
    return exact.join(near, ["one", "other"]).select("one", "other", F.round("exact", 9).alias("exact"), (F.abs(F.col("exact") - F.col("distance")) <= bound).alias("within"))


_REPLICATES = 200
_CASES = " ".join(f"WHEN x >= {cut} THEN {k}" for k, cut in reversed(list(enumerate(poisson_cuts(), 1))))

ORACLES["deviation_intervals"] = _SCORED_SQL + f"""
    , d AS (SELECT listing_id, prompt_id, abs(real - pred) AS diff FROM s WHERE real IS NOT NULL AND pred IS NOT NULL),
    keys AS (SELECT DISTINCT listing_id FROM d),
    draws AS (SELECT listing_id, r, CAST('0x' || substr(md5('42:' || (r // 8) || ':' || listing_id), CAST(r % 8 * 4 + 1 AS INT), 4) AS BIGINT) AS x FROM keys, range({_REPLICATES}) AS g(r)),
    w AS (SELECT listing_id, r, CASE {_CASES} ELSE 0 END AS w FROM draws),
    m AS (SELECT prompt_id, r, sum(w * diff) / sum(w) AS mae FROM d JOIN w USING (listing_id) WHERE w > 0 GROUP BY ALL),
    won AS (SELECT prompt_id, count(*) AS won FROM (SELECT r, arg_min(prompt_id, mae + prompt_id * 1e-12) AS prompt_id FROM m GROUP BY r) GROUP BY ALL),
    l AS (SELECT prompt_id, list(mae ORDER BY mae) AS a FROM m GROUP BY ALL)
    SELECT l.prompt_id, a[CAST(ceil(len(a) * {(1 - 0.95) / 2}) AS INT)] AS low, a[CAST(ceil(len(a) * 0.5) AS INT)] AS median, a[CAST(ceil(len(a) * {(1 + 0.95) / 2}) AS INT)] AS high,
           coalesce(won, 0) / CAST({_REPLICATES} AS DOUBLE) AS wins
    FROM l LEFT JOIN won USING (prompt_id)
"""
ORACLES["country_distributions"] = """
    SELECT lang, count(n_chars) AS n, CAST(share AS DOUBLE) AS share, true AS within FROM documents, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) AS v(share) GROUP BY lang, share
"""
ORACLES["country_distances"] = """
    WITH v AS (SELECT DISTINCT n_chars FROM documents), l AS (SELECT DISTINCT lang FROM documents),
    c AS (SELECT lang, n_chars, count(*) AS many FROM documents GROUP BY ALL),
    f AS (SELECT lang, n_chars, sum(coalesce(many, 0)) OVER (PARTITION BY lang ORDER BY n_chars) / sum(coalesce(many, 0)) OVER (PARTITION BY lang) AS share
          FROM v CROSS JOIN l LEFT JOIN c USING (lang, n_chars))
    SELECT a.lang AS one, b.lang AS other, round(max(abs(a.share - b.share)), 9) AS exact, true AS within
    FROM f a JOIN f b ON a.n_chars = b.n_chars AND a.lang < b.lang GROUP BY ALL
"""
