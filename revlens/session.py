"""Session defaults and the shared stage folder.

Materialised stages (model answers, predictions, parsed listings) are
written as Parquet under the folder named by ``spark.checkpoint.dir`` so
they survive executor loss. On a cluster that setting names a shared
file system; we only fill it in ourselves when it is unset (local runs
and tests).
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every revlens job relies on. AQE re-plans joins and splits
# skewed partitions at runtime; Arrow carries batches to Python workers.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reviews can be 20,000 words: bound each Arrow batch sent to a
    # Python worker by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "revlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with revlens defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control
    of it on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    stage_root(spark)
    ship_package(spark)
    return spark


# Most bytes of an Arrow batch of texts, and the ways to write Spark's own bound.
BATCH_BYTES = 4 * 1024 * 1024
_SPARKS_BATCH_BYTES = {"67108864b", "67108864", "64m", "64mb"}


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` in a session that has Spark's bound of 64 MB.

    A batch lies in the executor's direct memory and again in its Python
    worker, once for each running task. A session with a bound of its own
    keeps it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "64m").lower() in _SPARKS_BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def stage_root(spark: SparkSession) -> str:
    """Folder for materialised stages: ``spark.checkpoint.dir``.

    When a local-mode session has none (local runs, tests) a fresh local
    folder is created and recorded in the session so later calls agree.
    On a cluster a machine-local folder would be invisible to the other
    executors and lost with them, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder on shared storage: revlens writes "
                "model answers and other stages there"
            )
        root = tempfile.mkdtemp(prefix="revlens-stage-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_root(spark: SparkSession) -> str:
    """This application's own folder below the stage folder."""
    return f"{stage_root(spark)}/run-{spark.sparkContext.applicationId}"


# The stages made so far in each open ``temporary_stages`` block of a thread.
_TEMPORARY = threading.local()


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for one materialised stage of this application."""
    path = f"{run_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if getattr(_TEMPORARY, "made", None) and name != PACKAGE_STAGE:
        _TEMPORARY.made[-1].append(path)
    return path


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Stages that this thread makes within it are removed at its end: for work
    whose result is written elsewhere by then."""
    _TEMPORARY.made = [*getattr(_TEMPORARY, "made", []), []]
    try:
        yield
    finally:
        for path in _TEMPORARY.made.pop():
            remove_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) as Spark resolves it: a path without a scheme
    is on the cluster's default file system, not on the driver's disk."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is only reachable here
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it is missing)."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def remove_run(spark: SparkSession) -> None:
    """Delete every stage of this application. Call it when all results are
    written elsewhere: frames that read a stage can not be read after."""
    remove_folder(spark, run_root(spark))
    _SHIPPED.discard(spark.sparkContext.applicationId)


# A frame is spread when it would use under one in this many slots.
FEW_SPLITS = 4


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition when ``df`` would keep most of the cluster
    idle (under a quarter of the slots), so a Python-heavy stage uses every
    core.

    Small inputs stored in a few files/row groups otherwise run their
    Python step in a few tasks; others are returned untouched, as a
    shuffle of whole rows costs more than some idle slots.
    """
    if df.isStreaming or moves_data(df):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * FEW_SPLITS > target:
        return df
    return df.repartition(target)


def moves_data(df) -> bool:
    """Whether the physical plan holds an exchange (shuffle or broadcast).

    Such a frame is already partitioned by a shuffle sized for the job;
    asking it for its partition count would also run those stages right
    away (adaptive execution plans stage by stage), and the real job would
    run them again. Reading the plan only plans it.
    """
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001 - plan text only
    except Exception:  # noqa: BLE001 - plan not reachable: do not touch the frame
        return True
    # by the names of the plan's nodes alone: a column may hold the word too
    return re.search(r"(?m)^[\s:+*\-()\d]*\w*Exchange\b", plan) is not None


# The stage that holds the package's zip: it is read as long as the application runs.
PACKAGE_STAGE = "pyfiles"
# SparkContexts that already received the package, by their application id.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> str | None:
    """Make ``revlens`` importable in the Python workers, as
    ``spark-submit --py-files revlens.zip`` would.

    Python UDFs and ``mapInPandas`` functions are unpickled in worker
    processes, which do not see the driver's ``sys.path``. The package is
    zipped once per application into the stage folder (shared storage on
    a cluster) and added with ``addPyFile``; Spark ships it to every
    executor. Returns the zip's path, or None when already shipped.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return None
    target = f"{new_stage_path(spark, PACKAGE_STAGE)}/revlens.zip"
    data = package_zip()
    fs, hadoop_path = _file_system(spark, target)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
    return target


def package_zip() -> bytes:
    """A zip holding every module of the package, built in memory."""
    package = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(package)))
    return buffer.getvalue()
