"""Stages 1-2: filter listings by country, extract one row per review.

``read -> S2 -> N1 + P1 -> N2/N3/N6 -> write parsed -> N4/N5/P4 -> write``.

The Python-literal parse is the only Python step; its result is written
once, and both the review table and the error side table are read from
that copy. No shuffle anywhere: every step is row-local.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from revlens.operators.listings import count_rows, explode_reviews, extraction_errors, filter_country, parse_listings
from revlens.schemas import SCORE_COL
from revlens.sources.csv import in_file_order, read_csv, write_csv
from revlens.sources.split_csv import read_csv_ranges
from revlens.sources.stage import materialize, write_stage


@dataclass
class Extraction:
    reviews: DataFrame
    errors: DataFrame
    rows_written: int | None


def load_listings(
    spark: SparkSession,
    path: str,
    input_format: str = "csv",
    id_col: str | None = None,
    partitions: int | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Read listings and make sure they carry a ``listing_id``.

    Without a caller-named key the id is assigned once at ingest and the
    table is written, so every later stage sees the same ids. ``split_bytes``
    reads CSV files in byte ranges of that size, which many tasks share.
    """
    if input_format == "csv" and split_bytes:
        df = read_csv_ranges(spark, path, split_bytes=split_bytes, position=None if id_col else "listing_id")
        named = df.withColumnRenamed(id_col, "listing_id") if id_col else df
        return named.repartition(partitions) if partitions else named
    if input_format == "csv":
        df = read_csv(spark, path)
    else:
        df = spark.read.parquet(path)
    if id_col:
        named = df.withColumnRenamed(id_col, "listing_id") if id_col != "listing_id" else df
    else:
        named = materialize(in_file_order(df, "listing_id"), "listings")
    return named.repartition(partitions) if partitions else named


def extract(
    listings: DataFrame,
    countries: Sequence[str] | None = ("Canada",),
    fmt: str = "python_literal",
    keep: Sequence[str] = (),
) -> Extraction:
    """P1 (when ``countries`` is given) then review extraction."""
    if countries is not None:
        listings = filter_country(listings, countries, fmt=fmt)
    parsed = materialize(parse_listings(listings, fmt=fmt, keep=keep), "parsed-listings")
    return Extraction(explode_reviews(parsed, keep=keep), extraction_errors(parsed), None)


def run_extract(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    countries: Sequence[str] | None = ("Canada",),
    *,
    fmt: str = "python_literal",
    input_format: str = "csv",
    output_format: str = "parquet",
    id_col: str | None = None,
    errors_path: str | None = None,
    filtered_path: str | None = None,
    split_bytes: int | None = None,
) -> Extraction:
    """Whole stage 1-2 job. ``filtered_path``: also write the listings that
    pass the filter, all columns and all address keys, as CSV (stage 1). CSV output quotes every field (S4) and writes
    the score with a decimal comma (F1); Parquet keeps types (S6).
    ``split_bytes``: see :func:`load_listings`."""
    listings = load_listings(spark, input_path, input_format, id_col, split_bytes=split_bytes)
    if countries is not None:
        listings = filter_country(listings, countries, fmt=fmt)
    if filtered_path:
        # read by two jobs: written once, so that no address is parsed twice
        listings = materialize(listings, "filtered-listings")
        write_csv(listings, filtered_path)
    result = extract(listings, None, fmt)
    observed, obs = count_rows(result.reviews, "reviews")
    if output_format == "csv":
        write_csv(observed, output_path, quote_all=True, comma_columns={SCORE_COL: SCORE_COL})
    else:
        write_stage(observed, output_path)
    if errors_path:
        write_stage(result.errors, errors_path)
    rows = obs.get.get("rows")
    return Extraction(spark.read.parquet(output_path) if output_format != "csv" else result.reviews, result.errors, rows)
