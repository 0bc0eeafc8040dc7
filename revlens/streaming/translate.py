"""Stage 3 on arriving reviews: each text is asked once.

Reviews that arrive in files are grouped by the hash of their text, and the
model's answer is kept as state of that group: a text that an earlier
micro-batch had answered is not asked again, also after a restart, until its
answer is older than ``ttl_hours``. State is spread over the tasks and kept
below the stream's checkpoint, in RocksDB, so it need not fit in memory.

Within a micro-batch the texts of a task are asked one after another. A
micro-batch that was stopped before it was committed is run again and asks
its new texts again (at least once); what is written holds every row once.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from revlens.functions.text import strip
from revlens.operators.inference import BackendFactory, _answer_all, _backend_for, factory_key
from revlens.operators.prompts import TRANSLATE_TEMPLATE, Prompt, with_prompt
from revlens.schemas import ERROR_COL, REVIEW_COL
from revlens.session import ship_package

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

REVIEWS_SCHEMA = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("review_pos", T.IntegerType()),
        T.StructField(REVIEW_COL, T.StringType()),
        T.StructField("Review_Score", T.StringType()),
    ]
)
_STATE = T.StructType([T.StructField("answer", T.StringType()), T.StructField("when", T.LongType())])


def _keeper(factory: BackendFactory, columns: list[str], ttl_ms: int | None, on_error: str, clean_up: bool):
    """The function of one text's rows and state ``(answer, when)``."""
    backend_key = factory_key(factory)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = int(time.time() * 1000)
        answer, error, reused = None, None, False
        if state.exists:
            answer, since = state.get
            reused = ttl_ms is None or now - since < ttl_ms
        asked = reused
        for pdf in frames:
            if not asked:
                ((answer, error),) = _answer_all(_backend_for(backend_key, factory), [pdf["__prompt"].iloc[0]], on_error)
                asked = True
                if error is None:
                    # a failure is not kept: the text is asked again when it next arrives
                    state.update((answer, now))
                    if clean_up:
                        state.setTimeoutDuration(ttl_ms)
            yield pdf[columns].assign(**{"__answer": answer, ERROR_COL: error, "reused": reused})

    return run


def translate_stream(
    stream: DataFrame, factory: BackendFactory, review_col: str = REVIEW_COL, template: str = TRANSLATE_TEMPLATE, *, ttl_hours: float | None = None, on_error: str = "fail", clean_up: bool = False,
) -> DataFrame:
    """P5 on a stream: ``review_col`` replaced by its translation, with
    ``answer_error`` and ``reused`` (an earlier micro-batch had the answer).
    A NULL review stays NULL and has no group. ``clean_up`` also removes expired
    answers whose text does not come again; it takes a stream that keeps
    running, as Spark then goes on with batches that hold no rows."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    ship_package(spark)
    columns = stream.columns
    prompted = with_prompt(stream, Prompt(0, "", template), review_col, "__prompt").drop("prompt_id")
    kind = T.StructType(
        [*stream.schema.fields, T.StructField("__answer", T.StringType()), T.StructField(ERROR_COL, T.StringType()), T.StructField("reused", T.BooleanType())]
    )
    ttl = None if ttl_hours is None else int(ttl_hours * 3_600_000)
    keyed = prompted.where(F.col("__prompt").isNotNull()).withColumn("__key", F.sha2("__prompt", 256))
    answered = keyed.groupBy("__key").applyInPandasWithState(
        _keeper(factory, columns, ttl, on_error, bool(ttl and clean_up)), kind, _STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout if ttl and clean_up else GroupStateTimeout.NoTimeout,
    )
    without = prompted.where(F.col("__prompt").isNull()).drop("__prompt").select(
        "*", F.lit(None).cast("string").alias("__answer"), F.lit(None).cast("string").alias(ERROR_COL), F.lit(False).alias("reused")
    )
    return answered.unionByName(without).withColumn(review_col, F.coalesce(strip("__answer"), F.col(review_col))).drop("__answer")


def start_translate_stream(
    spark: SparkSession, reviews_path: str, output_dir: str, factory: BackendFactory, *, schema: T.StructType = REVIEWS_SCHEMA,
    template: str = TRANSLATE_TEMPLATE, ttl_hours: float | None = None, on_error: str = "fail", checkpoint: str | None = None,
    available_now: bool = True, processing_time: str | None = None, max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Translate the reviews that arrive as Parquet under ``reviews_path`` and add
    them to ``output_dir``; returns the running query. ``available_now``
    processes what is there and stops, else it polls."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = output_dir.rstrip("/")
    translated = translate_stream(reader.parquet(reviews_path), factory, template=template, ttl_hours=ttl_hours, on_error=on_error, clean_up=not available_now)
    writer = translated.writeStream.format("parquet").option("path", f"{out}/translated").option("checkpointLocation", checkpoint or f"{out}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
