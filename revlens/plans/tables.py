"""The shared test tables, seen through the review data model.

The original pipeline reads listing exports that are not shipped, so the
registered queries derive the same shapes from the given tables:

* ``documents`` is a listing: ``lang`` plays the country, each line of
  ``text`` is one review, and the listing's review list and score are
  written as literal text, exactly the form the original export has.
* ``labels`` gives the real score: ``quality * 9 + 1`` (1 or 10).
* ``events.props`` is a text column holding an object (``{"k": n}``).
* ``customer.c_acctbal`` is a number for decimal-comma conversion.

Everything here is a Spark projection or join over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.schemas import REVIEW_COL, SCORE_COL
from revlens.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The needed ``documents`` columns, spread over every core when the
    file has fewer splits than the cluster has slots.

    The text is the heavy part of every query that reads it (splitting,
    hashing, templating), and the test files hold one row group each, so
    without this the work runs in one task. On large inputs the scan
    already has enough splits and nothing moves.
    """
    docs = table(spark, sf_dir, "documents")
    return spread(docs.select(*columns) if columns else docs)


def real_score_of(quality: str = "quality"):
    """The real score on a 1-10 scale from a 0/1 quality label."""
    return (F.col(quality) * 9 + 1).cast("double")


# Elements that the extraction meets besides plain reviews, by listing:
# one without the key, and one that can not be asked for it.
ODD_ELEMENTS = {"without key": 3, "not an object": 5}


def listings(spark: SparkSession, sf_dir: str, fmt: str = "python_literal", odd: bool = False) -> DataFrame:
    """``(listing_id, address, reviews, review_scores, n_chars)`` as text.

    python_literal: ``{'country': 'es'}``, ``{'review_scores_value': 10}``
    (``{}`` for an unlabelled document); the review list is written with
    JSON escaping, which is also valid Python literal syntax and keeps
    every character of every line. json: the same values as JSON.

    The address also holds the source as its market. ``odd``: listings
    whose id is divisible by 3 have, after their first line, an element
    without the key; those divisible by 5 end with a number after it and
    repeat their first line behind that.
    """
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = docs.join(labels, "doc_id", "left")
    items = F.transform(F.split(F.col("text"), "\n"), lambda line: F.struct(line.alias("comments")))
    reviews = F.to_json(items)
    if odd:
        texts = F.transform(items, lambda x: F.to_json(x))
        first = F.slice(texts, 1, 1)
        more = F.when(F.col("doc_id") % ODD_ELEMENTS["without key"] == 0, F.array(F.lit('{"id":1}'))).otherwise(F.array().cast("array<string>"))
        stop = F.when(F.col("doc_id") % ODD_ELEMENTS["not an object"] == 0, F.concat(F.array(F.lit("7")), first)).otherwise(F.array().cast("array<string>"))
        reviews = F.concat(F.lit("["), F.concat_ws(",", first, more, F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0))), stop), F.lit("]"))
    score = (F.col("quality") * 9 + 1).cast("string")
    if fmt == "python_literal":
        address = F.format_string("{'country': '%s', 'market': '%s'}", F.col("lang"), F.col("source"))
        scores = F.when(score.isNull(), F.lit("{}")).otherwise(
            F.format_string("{'review_scores_value': %s}", score)
        )
    else:
        address = F.to_json(F.struct(F.col("lang").alias("country"), F.col("source").alias("market")))
        scores = F.to_json(F.struct(score.cast("long").alias("review_scores_value")))
    return joined.select(
        F.col("doc_id").alias("listing_id"),
        address.alias("address"),
        reviews.alias("reviews"),
        scores.alias("review_scores"),
        "n_chars",
    )


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one review, with its real score where a label
    gives one (else NULL, as a listing may have no score).

    ``(listing_id, review_pos, Review, Review_Score)``. The join is an
    equi-join on ``doc_id``; AQE picks broadcast or sort-merge from the
    runtime sizes.
    """
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("listing_id"),
        F.lit(0).alias("review_pos"),
        F.col("text").alias(REVIEW_COL),
        real_score_of().alias(SCORE_COL),
    )


def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one review row (no score)."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select(
        F.col("doc_id").alias("listing_id"),
        F.lit(0).alias("review_pos"),
        F.col("text").alias(REVIEW_COL),
    )
