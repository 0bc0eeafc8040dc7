"""Stage hand-off (S6): Parquet between stages, written to shared storage.

Parquet keeps types and nesting, and a written table cuts the lineage:
a lost executor re-reads files instead of re-running model calls.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from revlens.session import new_stage_path

# Spark's switch, and how many of the blocks that set it are open.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OPEN: dict[str, int] = {}
_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Actions begun within it drop their shuffle files when they end. Else
    these stay until the driver collects its garbage, so a job of many stages
    would hold the shuffles of all of them."""
    key = spark.sparkContext.applicationId
    with _LOCK:
        if not _OPEN.get(key):
            _OPEN[f"{key} before"] = spark.conf.get(_DROP_SHUFFLES, "false")
            spark.conf.set(_DROP_SHUFFLES, "true")
        _OPEN[key] = _OPEN.get(key, 0) + 1
    try:
        yield
    finally:
        with _LOCK:
            _OPEN[key] -= 1
            if not _OPEN[key]:
                spark.conf.set(_DROP_SHUFFLES, _OPEN.pop(f"{key} before"))


def write_stage(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None, compression: str | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str, path: str | None = None, *, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the stage folder and return a scan of it.

    Use before a result feeds more than one consumer, so expensive work
    (model calls, literal parsing) runs exactly once.
    """
    spark = df.sparkSession
    target = path or new_stage_path(spark, name)
    write_stage(df, target, compression=compression)
    return read_stage(spark, target)


# Catalog entries of bucketed stages begin with this.
TABLE_PREFIX = "revlens_stage_"


def materialize_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """As :func:`materialize`, dealt into buckets by ``keys``: one file a bucket,
    sorted. Joins of such stages on these keys move no rows, as both sides
    lie in the same buckets (by default as many as shuffle partitions).

    Spark knows of buckets through its catalog only, so the stage is a table
    there (over files of the stage folder) until :func:`forget_bucketed`.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{TABLE_PREFIX}{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", new_stage_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def forget_bucketed(spark: SparkSession) -> int:
    """Take the bucketed stages out of the catalog (their files stay with the
    stage folder); returns how many there were."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(TABLE_PREFIX)]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return len(names)
