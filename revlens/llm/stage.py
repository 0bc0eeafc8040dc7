"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import textscan
from revlens.plans.tables import table
from revlens.session import bound_batches, ship_package
from revlens.sources.stage import materialize

__all__ = ["appended", "documents", "materialize", "tuned", "with_uid"]


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(*columns) if columns else docs


def with_uid(df: DataFrame, name: str = "uid") -> DataFrame:
    """A row number that is unique. It is stable only once ``df`` is written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def tuned(df: DataFrame) -> DataFrame:
    """``df`` unchanged, with the package shipped to the workers first and batches of a bounded size."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df


def appended(df: DataFrame, text_col: str, found_of: Callable, fields: T.StructType) -> DataFrame:
    """(row, found): every row of ``df`` as a struct, with what ``found_of``
    says of its text. ``found_of`` takes a slice of texts and returns one
    array a field. As a struct, the row's own names clash with nothing.
    """
    source = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            for text in textscan.slices(row.field(text_col)):
                found = pa.StructArray.from_arrays([pa.array(x) for x in found_of(text)], names=fields.names)
                yield pa.RecordBatch.from_arrays([row.slice(text.first, text.rows), found], names=["row", "found"])

    schema = T.StructType([source.schema["row"], T.StructField("found", fields)])
    return tuned(source).mapInArrow(run, schema)
