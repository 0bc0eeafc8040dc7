"""Stage 3: translate reviews to English.

``read -> flag first n -> distinct texts -> model -> join back -> write``.
With an ``answer_store`` the model's answers are committed wave by wave,
so a run after a failure asks only for what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from revlens.operators.inference import BackendFactory, translate
from revlens.operators.prompts import TRANSLATE_TEMPLATE
from revlens.sources.csv import load_reviews, write_csv
from revlens.sources.stage import write_stage


def run_translate(
    spark: SparkSession,
    reviews: DataFrame | str,
    output_path: str,
    factory: BackendFactory,
    *,
    limit: int = -1,
    template: str = TRANSLATE_TEMPLATE,
    order_by: Sequence[str] = ("listing_id", "review_pos"),
    output_format: str = "parquet",
    input_format: str = "parquet",
    **generate_options,
) -> DataFrame:
    df = load_reviews(spark, reviews, input_format) if isinstance(reviews, str) else reviews
    out = translate(df, factory, template=template, limit=limit, order_by=order_by, **generate_options)
    if output_format == "csv":
        write_csv(out, output_path)
        return out
    write_stage(out, output_path)
    return spark.read.parquet(output_path)
