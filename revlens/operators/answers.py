"""A store of model answers, hashed into key buckets.

A store is a folder of runs, ``run=b<buckets>-<id>/bucket=<k>/``, in Parquet:
``model``, ``prompt_sha256``, ``answer``. A prompt's place follows from its key
alone, so

* looking prompts up reads the buckets that they fall in, once, and gives
  both what is known and what is not (:func:`look_up`);
* a wave of new prompts is a range of places: it is written to a folder of
  its own, read once, and adds to its own buckets (:func:`add`);
* :func:`compact` turns many runs into one, sorted by key within a bucket, so
  that later look-ups open a file a bucket.

Runs are only ever added, each by one writer; compacting writes the merged
run before it removes what it merged, so a stop in between leaves
duplicates, which every reader ignores. Runs of the older form (no buckets)
are rewritten when a job first uses the store (:func:`upgrade`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import child_folders, new_stage_path, remove_folder
from revlens.sources.stage import write_stage

# Places of keys; a bucket or a wave is a range of them.
PLACES = 1 << 20
BUCKETS = 256
# Prompts and answers are written once and read once or twice: smaller files before faster ones.
COMPRESSION = "zstd"

_FIELDS = [T.StructField(c, T.StringType()) for c in ("model", "prompt_sha256", "answer")]
FILE_SCHEMA = T.StructType(_FIELDS)
STORE_SCHEMA = T.StructType([*_FIELDS, T.StructField("bucket", T.IntegerType())])


def place_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(PLACES)).cast("int")


def part_of(key: str, parts: int) -> Column:
    """The bucket or wave, of ``parts``, that a key's place falls in."""
    return F.floor(place_of(key).cast("bigint") * parts / PLACES).cast("int")


def _runs(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The store's run folders by their number of buckets (0: none). Runs
    without an answer, as of a wave whose prompts all failed, are left out."""
    found: dict[int, list[str]] = {}
    for name in child_folders(spark, path):
        if name.startswith("run="):
            form, folder = name.removeprefix("run=").split("-")[0], f"{path.rstrip('/')}/{name}"
            buckets = int(form[1:]) if form[:1] == "b" and form[1:].isdigit() else 0
            if not buckets or child_folders(spark, folder):
                found.setdefault(buckets, []).append(folder)
    return found


def _read(spark: SparkSession, path: str, model_id: str, runs: dict[int, list[str]], prompts: DataFrame | None) -> DataFrame:
    """(prompt_sha256, answer) of one model; with ``prompts`` (prompt_sha256) only
    of the buckets that hold one of them, whose numbers (at most as many as
    there are buckets) come to the driver."""
    out = spark.createDataFrame([], STORE_SCHEMA)
    for buckets, folders in sorted(runs.items()):
        if not buckets:
            out = out.unionByName(spark.read.schema(FILE_SCHEMA).parquet(*folders).withColumn("bucket", F.lit(0)))
            continue
        some = spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*(f"{f}/bucket=*" for f in folders))
        if prompts is not None:
            wanted = [r[0] for r in prompts.select(part_of("prompt_sha256", buckets)).distinct().collect()]
            some = some.where(F.col("bucket").isin(wanted)) if wanted else some.limit(0)
        out = out.unionByName(some.select(*STORE_SCHEMA.fieldNames()))
    return out.where(F.col("model") == model_id).select("prompt_sha256", "answer")


def look_up(spark: SparkSession, path: str, model_id: str, prompts: DataFrame) -> DataFrame:
    """``prompts`` (prompt_sha256, ...), a written table of distinct keys, with
    ``known`` and ``answer``."""
    runs = _runs(spark, path)
    stored = _read(spark, path, model_id, runs, prompts)
    # two runs may have stored one prompt; any of them has a valid answer
    once = stored.groupBy("prompt_sha256").agg(F.min("answer").alias("answer"), F.lit(True).alias("known"))
    return prompts.join(once, "prompt_sha256", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def add(answers: DataFrame, path: str, model_id: str, buckets: int = BUCKETS) -> str:
    """Store (prompt_sha256, answer) as a run of its own; returns its folder."""
    return _write(answers.withColumn("model", F.lit(model_id)), path, buckets)


def _write(answers: DataFrame, path: str, buckets: int) -> str:
    target = f"{path.rstrip('/')}/run=b{buckets}-{uuid.uuid4().hex}"
    placed = answers.withColumn("bucket", part_of("prompt_sha256", buckets)).select(*STORE_SCHEMA.fieldNames())
    dealt = placed.repartition("bucket").sortWithinPartitions("bucket", "prompt_sha256")
    return write_stage(dealt, target, mode="error", partition_by=["bucket"], compression=COMPRESSION)


def upgrade(spark: SparkSession, path: str) -> None:
    """Bucket the runs of the older form, if there are any."""
    if old := _runs(spark, path).get(0):
        _merge(spark, path, {0: old}, BUCKETS)


def compact(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int:
    """Merge all runs into one of ``buckets`` buckets, every model's; returns how
    many runs there were. Answers that are added meanwhile stay as they are;
    look-ups that read the old runs meanwhile fail and can be repeated."""
    runs = _runs(spark, path)
    many = sum(map(len, runs.values()))
    if many > 1 or (many and buckets not in runs):
        _merge(spark, path, runs, buckets)
    return many


def _merge(spark: SparkSession, path: str, runs: dict[int, list[str]], buckets: int) -> None:
    every = spark.createDataFrame([], FILE_SCHEMA)
    for form, some in runs.items():
        read = spark.read.schema(FILE_SCHEMA)
        every = every.unionByName(read.parquet(*(some if not form else (f"{f}/bucket=*" for f in some))))
    _write(every.groupBy("model", "prompt_sha256").agg(F.min("answer").alias("answer")), path, buckets)
    for folder in (f for some in runs.values() for f in some):
        remove_folder(spark, folder)


def wave_folders(prompts: DataFrame, waves: int, name: str = "prompts-new") -> list[str]:
    """A folder of prompts for each wave that has any. Waves are ranges of places,
    as buckets are.

    The prompts are dealt by waves, or by equal parts of them when there are
    fewer than shuffle partitions, so there is a file a part and not one for
    every wave in every task."""
    spark = prompts.sparkSession
    waves = max(1, waves)
    parts = waves * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // waves)
    dealt = prompts.withColumn("__wave", part_of("prompt_sha256", waves)).repartition(part_of("prompt_sha256", parts))
    written = write_stage(dealt, new_stage_path(spark, name), partition_by=["__wave"], compression=COMPRESSION)
    present = set(child_folders(spark, written))
    return [f"{written}/__wave={w}" for w in range(waves) if f"__wave={w}" in present]


def by_wave(prompts: DataFrame, waves: int, name: str = "prompts-new") -> list[DataFrame]:
    """The prompts of each wave, from its folder: written once, and each wave's read once."""
    return [prompts.sparkSession.read.schema(prompts.schema).parquet(folder) for folder in wave_folders(prompts, waves, name)]
