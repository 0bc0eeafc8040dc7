"""Stages 1-2 on arriving files (Structured Streaming).

New listing files dropped into a folder are filtered, parsed and
exploded with exactly the batch operators. Each micro-batch parses once
(persisted for the two writes), then writes its reviews and its error
rows under ``batch=<id>`` with overwrite: a replayed batch after a
failure rewrites the same folder, so the output holds every batch
exactly once. Progress lives in a checkpoint folder beside that output
(unless another is named), so each output has its own. Listings whose
address can not be read go to ``bad_addresses/batch=<id>`` instead of
stopping the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revlens.operators.listings import PROBLEM_COL, address_problems, explode_reviews, extraction_errors, parse_listings
from revlens.sources.csv import CSV_OPTIONS, normalise_missing

_PLACE = "__place"

LISTINGS_TEXT_SCHEMA = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("address", T.StringType()),
        T.StructField("reviews", T.StringType()),
        T.StructField("review_scores", T.StringType()),
    ]
)


def read_listing_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LISTINGS_TEXT_SCHEMA,
    input_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of listing rows from files arriving under ``path``.

    File streams need a declared schema; it must hold ``listing_id``.
    """
    if "listing_id" not in schema.fieldNames():
        raise ValueError("streamed listings must carry a listing_id column")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if input_format == "csv":
        return normalise_missing(reader.options(**CSV_OPTIONS).csv(path))
    return reader.parquet(path)


def _write_batch(
    output_dir: str,
    countries: Sequence[str] | None,
    fmt: str,
):
    def run(batch: DataFrame, batch_id: int) -> None:
        listings = batch
        if countries is not None:
            checked = address_problems(batch, fmt=fmt, parsed_col=_PLACE).persist(StorageLevel.MEMORY_AND_DISK)
            bad = checked.where(F.col(PROBLEM_COL).isNotNull()).drop(_PLACE).withColumnRenamed(PROBLEM_COL, "error")
            bad.write.mode("overwrite").parquet(f"{output_dir}/bad_addresses/batch={batch_id}")
            # by what the check read: no address is parsed twice
            listings = checked.where(F.col(PROBLEM_COL).isNull() & F.col(_PLACE)["country"].isin(list(countries))).drop(PROBLEM_COL, _PLACE)
        parsed = parse_listings(listings, fmt=fmt).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            explode_reviews(parsed).write.mode("overwrite").parquet(f"{output_dir}/reviews/batch={batch_id}")
            extraction_errors(parsed).write.mode("overwrite").parquet(f"{output_dir}/errors/batch={batch_id}")
        finally:
            parsed.unpersist()
            if countries is not None:
                checked.unpersist()

    return run


def start_extract_stream(
    spark: SparkSession,
    listings_path: str,
    output_dir: str,
    countries: Sequence[str] | None = ("Canada",),
    *,
    fmt: str = "python_literal",
    input_format: str = "parquet",
    schema: T.StructType = LISTINGS_TEXT_SCHEMA,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental extraction; returns the running query.

    ``available_now`` processes what is there and stops (scheduled
    runs); otherwise it polls every ``processing_time``.
    """
    stream = read_listing_stream(spark, listings_path, schema, input_format, max_files_per_trigger)
    out = output_dir.rstrip("/")
    writer = (
        stream.writeStream.foreachBatch(_write_batch(out, countries, fmt))
        .option("checkpointLocation", checkpoint or f"{out}/_checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
