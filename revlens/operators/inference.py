"""Model inference as Spark jobs.

A backend turns a batch of prompt texts into answers. It is built once
per Python worker from a picklable factory (a class, ``functools.partial``
...) and called on small batches inside ``mapInPandas``, so Arrow moves
the texts and no row is sent on its own.

Equal prompt texts are answered once: the texts are reduced to distinct
sha-256 keys with their row counts (combined map-side, so a text
repeated in a third of the rows costs one call and one shuffled row per
task), answered, written to the stage folder, and joined back. In the
join-back a text holding many rows is salted: its answer is copied to
several buckets and its rows spread over them, so no task receives a
third of the data. Dedup is valid because the model runs at
temperature 0.

A retried task of the answering stage calls the backend again
(at-least-once); once written, answers are never recomputed.
"""

from __future__ import annotations

import hashlib
import json
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.text import parse_number, strip
from revlens.operators import answers as answers_store
from revlens.operators.prompts import DEFAULT_PROMPTS, TRANSLATE_TEMPLATE, Prompt, as_prompts, with_prompt, with_prompts
from revlens.operators.sampling import first_rows_flag
from revlens.operators.window import Windowed
from revlens.schemas import ERROR_COL, PRED_COL, REVIEW_COL
from revlens.session import new_stage_path, path_exists, remove_folder, spread
from revlens.sources.stage import materialize, write_stage

ON_ERROR = ("fail", "null")


class Backend(Protocol):
    """Answers a batch of prompts, one answer per prompt, same order."""

    def generate(self, prompts: list[str]) -> list[str]: ...


BackendFactory = Callable[[], Backend]


# ---------------------------------------------------------------------------
# Backends
# ---------------------------------------------------------------------------


class LengthScorer:
    """Deterministic test double for a scoring model.

    The answer depends only on the prompt's length n (in code points):
    ``'<n % 11>/10'`` when n is a multiple of 7 (a non-numeric answer),
    else ``' <n % 11> '`` (a number wrapped in spaces). It checks the
    plumbing, not model quality.
    """

    def generate(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            n = len(p)
            out.append(f"{n % 11}/10" if n % 7 == 0 else f" {n % 11} ")
        return out


class PrefixTranslator:
    """Deterministic test double for a translation model: '[en] ' + text."""

    def __init__(self, prefix: str = "[en] ") -> None:
        self.prefix = prefix

    def generate(self, prompts: list[str]) -> list[str]:
        return [self.prefix + p for p in prompts]


class HttpGenerateBackend:
    """Client for a model server speaking the common ``/api/generate``
    JSON protocol (model, prompt, options.temperature, stream=false).

    The server is the user's; revlens never starts one. One request per
    prompt, as such servers take a single prompt per call; concurrency
    comes from the number of tasks.
    """

    def __init__(self, url: str, model: str, temperature: float = 0.0, timeout: float = 120.0) -> None:
        self.url = url
        self.model = model
        self.temperature = temperature
        self.timeout = timeout

    def _one(self, prompt: str) -> str:
        body = json.dumps(
            {
                "model": self.model,
                "prompt": prompt,
                "stream": False,
                "options": {"temperature": self.temperature},
            }
        ).encode("utf-8")
        req = urllib.request.Request(self.url, data=body, headers={"Content-Type": "application/json"})
        with urllib.request.urlopen(req, timeout=self.timeout) as resp:  # noqa: S310 - user-given URL
            return json.loads(resp.read().decode("utf-8"))["response"]

    def generate(self, prompts: list[str]) -> list[str]:
        return [self._one(p) for p in prompts]


# ---------------------------------------------------------------------------
# The mapInPandas kernel
# ---------------------------------------------------------------------------

# Backends built in this Python worker, by factory fingerprint.
_WORKER_BACKENDS: dict[str, Backend] = {}


def _backend_for(key: str, factory: BackendFactory) -> Backend:
    backend = _WORKER_BACKENDS.get(key)
    if backend is None:
        backend = factory()
        _WORKER_BACKENDS[key] = backend
    return backend


def factory_key(factory: BackendFactory) -> str:
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()[:16]


def _windowed(factory: BackendFactory, in_flight: int, retries: int) -> BackendFactory:
    return factory if in_flight == 1 and not retries else partial(Windowed, factory, in_flight, retries)


def _answer_all(backend: Backend, texts: list[str], on_error: str) -> list[tuple[str | None, str | None]]:
    """(answer, error) for every prompt. A batch that fails is asked again
    one prompt at a time, so one bad prompt costs no other its answer; a
    windowed backend tells each prompt's failure itself."""
    if isinstance(backend, Windowed):
        found = backend.generate_each(texts)
        for _, error in found:
            if error is not None and on_error == "fail":
                raise error
        return [(None if x is None else str(x), None if e is None else f"{type(e).__name__}: {e}") for x, e in found]
    try:
        got = backend.generate(texts)
        if len(got) != len(texts):
            raise RuntimeError(f"backend returned {len(got)} answers for {len(texts)} prompts")
    except Exception as exc:
        if len(texts) > 1:
            return [x for t in texts for x in _answer_all(backend, [t], on_error)]
        if on_error == "fail":
            raise
        return [(None, f"{type(exc).__name__}: {exc}")]
    return [(None if x is None else str(x), None) for x in got]


def _answer_batches(
    factory: BackendFactory,
    key: str,
    text_col: str,
    out_col: str,
    err_col: str,
    batch_size: int,
    on_error: str,
    drop_text: bool,
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = _backend_for(key, factory)
        for pdf in batches:
            texts = pdf[text_col].tolist()
            answers: list[str | None] = [None] * len(texts)
            errors: list[str | None] = [None] * len(texts)
            todo = [i for i, t in enumerate(texts) if t is not None]
            # a window slides over all of them: no batch waits for its slowest call
            step = len(todo) or 1 if isinstance(backend, Windowed) else batch_size
            for start in range(0, len(todo), step):
                idx = todo[start : start + step]
                for i, (answer, error) in zip(idx, _answer_all(backend, [texts[i] for i in idx], on_error), strict=True):
                    answers[i], errors[i] = answer, error
            if drop_text:
                pdf = pdf.drop(columns=[text_col])
            yield pdf.assign(**{out_col: answers, err_col: errors})

    return run


# A text is "hot" when its rows hold more bytes than this share of one
# task's fair load; its answer is replicated over salt buckets for the
# join-back.
HOT_SHARE = 4
MIN_HOT_BYTES = 64 * 1024 * 1024
# Most keys that the hot-key table may have to be broadcast.
MAX_HOT_KEYS = 100_000


def _salted_join_back(keyed: DataFrame, answers: DataFrame, hot_rows: int | None, total: int, top: int) -> DataFrame:
    """Join answers back to the rows, splitting hot texts over tasks.

    ``answers`` is a written table ``(__k, __n, __b, answer columns...)``:
    rows and bytes of each text; ``total`` and ``top`` are the sum and the
    largest of the measure that decides (bytes, or rows when ``hot_rows``
    is given), observed while it was written. There are at most
    total/threshold hot keys; their table is broadcast only when that is
    within ``MAX_HOT_KEYS``, and joined as any other table beyond. Each hot
    key gets ``ceil(measure / threshold)`` salt buckets (at most the number
    of shuffle partitions): its answer row is copied once per bucket and
    its rows are spread over the buckets by a hash of their own columns,
    which a re-run of a lost task repeats exactly.

    Rows without a text have no answer and take no part in the join.
    """
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    measure = F.col("__n" if hot_rows else "__b")
    threshold = hot_rows or max(MIN_HOT_BYTES, -(-total // (HOT_SHARE * parts)))
    if top <= threshold:
        return keyed.join(answers.drop("__n", "__b"), "__k", "left").drop("__k")
    hot = (
        answers.where(measure > threshold)
        .groupBy("__k")
        .agg(F.least(F.lit(parts), F.ceil(F.max(measure) / F.lit(threshold))).cast("int").alias("__salts"))
    )
    if total // threshold <= MAX_HOT_KEYS:
        hot = F.broadcast(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in keyed.columns])
    left = (
        keyed.join(hot, "__k", "left")
        .withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col("__salts"))))
        .drop("__salts")
    )
    right = (
        answers.drop("__n", "__b")
        .join(hot, "__k", "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
        .drop("__salts")
    )
    return left.join(right, ["__k", "__salt"], "left").drop("__k", "__salt")


def _distinct_texts(keyed: DataFrame, text_col: str, out: str) -> DataFrame:
    """(__k, out, __n, __b): each text once, its rows and their bytes. The
    text is a grouping key, so the count is a hash aggregate with a partial
    step in the map tasks and no sort."""
    grouped = keyed.groupBy("__k", F.col(text_col).alias(out)).agg(F.count(F.lit(1)).alias("__n"))
    return grouped.withColumn("__b", F.col("__n") * F.coalesce(F.octet_length(out), F.lit(0)))


def _answered(rows: DataFrame, text_col: str, out_col: str, err_col: str, factory: BackendFactory, hot_rows: int | None, **call) -> tuple[DataFrame, int, int]:
    """The answers, written once; total and largest of the hot measure. (A
    retried task may add its share twice: the figures only steer salting.)"""
    counts = Observation(f"answers-{uuid.uuid4().hex[:12]}")
    measure = "__n" if hot_rows else "__b"
    answered = _call_model(rows, text_col, out_col, err_col, factory, **call).observe(
        counts, F.sum(measure).alias("total"), F.max(measure).alias("top")
    )
    answers = materialize(answered, "answers", compression=answers_store.COMPRESSION)
    seen = counts.get
    return answers, seen.get("total") or 0, seen.get("top") or 0


def model_tasks(spark) -> int:
    """Tasks for a model stage: every slot busy, and never fewer than the
    shuffle partitions the job is sized for."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, shuffle)


# Prompts asked between two commits to an answer store.
WAVE_PROMPTS = 50_000
# Batches that a task of a wave is to have before more tasks share the wave.
TASK_BATCHES = 32


def wave_tasks(spark, wave_prompts: int, batch_size: int) -> int:
    """Tasks for one wave: every slot busy, and more (up to :func:`model_tasks`)
    only if each has ``TASK_BATCHES`` batches. A small wave in as many tasks as
    a whole job would spend its time on starting them."""
    share = -(-wave_prompts // (TASK_BATCHES * batch_size))
    return min(model_tasks(spark), max(spark.sparkContext.defaultParallelism, share))


def _call_model(
    rows: DataFrame,
    text_col: str,
    out_col: str,
    err_col: str,
    factory: BackendFactory,
    *,
    batch_size: int,
    on_error: str,
    concurrency: int | None,
    answer_store: str | None,
    model_id: str | None,
    wave_prompts: int,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Answer ``text_col`` for every row: all other columns, ``out_col``
    and ``err_col``. NULL texts are not sent.

    ``answer_store``: a store of earlier answers (``operators.answers``), keyed by
    ``model_id`` and the prompt's sha-256. The prompts are looked up by key, in
    the buckets that they fall in; known ones are not sent again. The rest
    is asked in waves of about ``wave_prompts`` prompts, each read from a folder
    of its own, and every wave's answers are stored before the next begins:
    a job that fails or is stopped has to repeat one wave at most. What a wave
    read and wrote beside the store is then removed, and the answers are taken
    from the store at the end, so the texts lie there about once. Failed
    prompts are reported but not stored, so the next run retries them; with
    ``on_error="fail"`` the job fails after the wave's good answers are stored.
    """
    key = factory_key(factory)
    if answer_store is None:
        kernel = _answer_batches(factory, key, text_col, out_col, err_col, batch_size, on_error, True)
        schema = T.StructType(
            [
                *[f for f in rows.schema.fields if f.name != text_col],
                T.StructField(out_col, T.StringType()),
                T.StructField(err_col, T.StringType()),
            ]
        )
        # Model calls cost per prompt, not per byte: AQE would coalesce a
        # few MB of prompts into one or two tasks. An explicit round-robin
        # count keeps at least one task per slot (a hash exchange on __k
        # with the aggregate's own count would be dropped as redundant).
        return rows.repartition(concurrency or model_tasks(rows.sparkSession)).mapInPandas(kernel, schema, profile=profile)

    if not model_id:
        raise ValueError("an answer store needs a model_id: the name under which its answers are kept")
    kernel = _answer_batches(factory, key, text_col, out_col, err_col, batch_size, "null", True)
    spark = rows.sparkSession
    # The texts lie in one stage at a time: here, then in the waves' folders, which
    # go one by one as their answers are stored. All else works on keys.
    path = new_stage_path(spark, "prompts")
    written = materialize(rows.withColumn("prompt_sha256", F.sha2(F.col(text_col), 256)), "prompts", path, compression=answers_store.COMPRESSION)
    keyed = materialize(written.drop(text_col), "prompt-keys")
    asked = keyed.where(F.col("prompt_sha256").isNotNull()).select("prompt_sha256")
    every = asked.count()
    answers_store.upgrade(spark, answer_store)
    seen = materialize(answers_store.look_up(spark, answer_store, model_id, asked.distinct()).select("prompt_sha256", "known"), "prompts-seen")
    counted = seen.groupBy("known").count().collect()
    unknown = sum(r["count"] for r in counted if not r["known"])
    new = written.where(F.col("prompt_sha256").isNotNull()).select("prompt_sha256", text_col)
    if unknown < sum(r["count"] for r in counted):
        new = new.join(seen.where(~F.col("known")), "prompt_sha256", "left_semi")
    if every > sum(r["count"] for r in counted):
        new = new.distinct()
    waves = answers_store.wave_folders(new, -(-unknown // wave_prompts)) if unknown else []
    remove_folder(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("prompt_sha256", out_col, err_col)])
    given, failures = new_stage_path(spark, "answers-new"), new_stage_path(spark, "answers-failed")
    tasks = concurrency or wave_tasks(spark, wave_prompts, batch_size)
    for wave, folder in enumerate(waves):
        # there may be very many waves: a wave takes no jobs beyond its two writes
        failed = Observation(f"failed-{uuid.uuid4().hex[:12]}")
        chosen = spark.read.schema(new.schema).parquet(folder)
        asked_now = chosen.repartition(tasks).mapInPandas(kernel, schema, profile=profile).observe(failed, F.count(err_col).alias("n"))
        fresh = spark.read.schema(schema).parquet(write_stage(asked_now, f"{given}/wave={wave}", compression=answers_store.COMPRESSION))
        good = fresh.where(F.col(err_col).isNull()).select("prompt_sha256", F.col(out_col).alias("answer"))
        answers_store.add(good, answer_store, model_id)
        if failed.get.get("n"):
            bad = fresh.where(F.col(err_col).isNotNull())
            if on_error == "fail" and (first := bad.first()) is not None:
                raise RuntimeError(f"the model failed on a prompt (answers so far are stored): {first[err_col]}")
            write_stage(bad.select("prompt_sha256", err_col), f"{failures}/wave={wave}")
        remove_folder(spark, f"{given}/wave={wave}")
        remove_folder(spark, folder)
    # every answer is in the store now, except for those that failed
    stored = answers_store.look_up(spark, answer_store, model_id, asked.distinct()).select("prompt_sha256", F.col("answer").alias(out_col), "known")
    if path_exists(spark, failures):
        bad = spark.read.schema(T.StructType([schema["prompt_sha256"], schema[err_col]])).parquet(f"{failures}/wave=*")
        stored = stored.join(bad, "prompt_sha256", "left").withColumn(err_col, F.when(~F.col("known"), F.col(err_col)))
    else:
        stored = stored.withColumn(err_col, F.lit(None).cast("string"))
    return keyed.join(stored.drop("known"), "prompt_sha256", "left").drop("prompt_sha256").select(*(c for c in rows.columns if c != text_col), out_col, err_col)


def generate(
    df: DataFrame,
    text_col: str,
    out_col: str,
    factory: BackendFactory,
    *,
    dedup: bool = True,
    batch_size: int = 16,
    on_error: str = "fail",
    concurrency: int | None = None,
    error_col: str | None = None,
    hot_rows: int | None = None,
    answer_store: str | None = None,
    model_id: str | None = None,
    wave_prompts: int = WAVE_PROMPTS,
    in_flight: int = 1,
    retries: int = 0,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out_col``: the backend's answer to ``text_col`` (raw text).

    * NULL texts are not sent; their answer is NULL.
    * ``dedup``: equal texts are answered once. The distinct texts and
      their row counts come from a map-side-combined aggregate; answers
      are written to the stage folder right away (model calls are never
      repeated by a retry downstream), then joined back with hot texts
      salted over several tasks (``hot_rows`` overrides the threshold).
      Without dedup the rows go through the model where they are, with
      no shuffle.
    * ``on_error``: ``"fail"`` fails the task (and the job after Spark's
      retries), ``"null"`` keeps going with a NULL answer and the error
      text in ``error_col``.
    * ``concurrency``: spread the prompts over exactly that many tasks
      (bounds the parallel calls a model server sees); by default the
      distinct prompts get :func:`model_tasks` tasks, and each wave of an
      answer store :func:`wave_tasks`.
    * ``answer_store``: reuse and extend a folder of earlier answers kept
      under the name ``model_id`` (see :func:`_call_model`); dedup path only.
    * ``in_flight``: single-prompt calls that a task keeps running at once, with
      ``retries`` more attempts at each and a shared back-off (``operators.window``).
      The server sees at most tasks x ``in_flight``.
    * ``profile``: a ``ResourceProfile`` for the model stage alone, so that it runs
      with other cores, memory or devices a task than the stages around it.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    factory = _windowed(factory, in_flight, retries)
    err_col = error_col or f"__{out_col}_error"
    key = factory_key(factory)
    if dedup:
        keyed = df.withColumn("__k", F.sha2(F.col(text_col), 256))
        texts = _distinct_texts(keyed.where(F.col("__k").isNotNull()), text_col, "__text")
        answers, total, top = _answered(
            texts, "__text", out_col, err_col, factory, hot_rows, batch_size=batch_size, on_error=on_error,
            concurrency=concurrency, answer_store=answer_store, model_id=model_id, wave_prompts=wave_prompts, profile=profile,
        )
        # rows without a text are not joined: they would all meet on one NULL key
        without = keyed.where(F.col("__k").isNull()).drop("__k")
        out = _salted_join_back(keyed.where(F.col("__k").isNotNull()), answers, hot_rows, total, top).unionByName(
            without.withColumn(out_col, F.lit(None).cast("string")).withColumn(err_col, F.lit(None).cast("string"))
        )
    else:
        src = df.repartition(concurrency) if concurrency else spread(df)
        schema = T.StructType(
            [
                *src.schema.fields,
                T.StructField(out_col, T.StringType()),
                T.StructField(err_col, T.StringType()),
            ]
        )
        out = src.mapInPandas(
            _answer_batches(factory, key, text_col, out_col, err_col, batch_size, on_error, False), schema, profile=profile
        )
    if error_col is None:
        out = out.drop(err_col)
    return out


# ---------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------


def score(
    df: DataFrame,
    factory: BackendFactory,
    prompts: Sequence[Prompt | str] | Prompt = DEFAULT_PROMPTS,
    review_col: str = REVIEW_COL,
    **generate_options,
) -> DataFrame:
    """Score every review with every prompt.

    Adds ``prompt_id``, ``response`` (the stripped answer, F2) and
    ``predicho`` (F3: the answer as a number, NULL when it is not one), and
    ``answer_error`` (or ``error_col``): why a call failed, else NULL.
    A single :class:`Prompt` scores with that prompt only (J2).
    """
    generate_options["error_col"] = generate_options.get("error_col") or ERROR_COL
    if isinstance(prompts, Prompt):
        prompted = with_prompt(df, prompts, review_col, "__prompt_text")
        answered = generate(prompted, "__prompt_text", "__answer", factory, **generate_options)
    elif generate_options.get("dedup", True):
        answered = _answers_by_review(df, factory, as_prompts(prompts), review_col, **generate_options)
    else:
        prompted = with_prompts(df, prompts, review_col, "__prompt_text")
        answered = generate(prompted, "__prompt_text", "__answer", factory, **generate_options)
    return (
        answered.withColumn("response", strip("__answer"))
        .withColumn(PRED_COL, parse_number("response"))
        .drop("__prompt_text", "__answer")
    )


def _answers_by_review(
    df: DataFrame,
    factory: BackendFactory,
    prompts: list[Prompt],
    review_col: str,
    *,
    dedup: bool = True,
    batch_size: int = 16,
    on_error: str = "fail",
    concurrency: int | None = None,
    error_col: str | None = None,
    hot_rows: int | None = None,
    answer_store: str | None = None,
    model_id: str | None = None,
    wave_prompts: int = WAVE_PROMPTS,
    in_flight: int = 1,
    retries: int = 0,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Every row under every prompt, answered once per distinct review.

    The prompts are applied after the dedup, not before: the distinct
    step shuffles each review text once (not once per prompt), and the
    model sees one row per (distinct review, prompt). The answers table
    holds one row per prompt for each review, so the join-back moves each
    input row once and the rows multiply by the prompt count only in the
    join's output, after the exchange. NULL reviews are set beside the
    join. Output as :func:`generate` over :func:`with_prompts`:
    the input columns, ``prompt_id``, ``__answer`` and ``error_col`` when
    asked for.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    spark = df.sparkSession
    factory = _windowed(factory, in_flight, retries)
    err_col = error_col or "__answer_error"
    keyed = df.withColumn("__k", F.sha2(F.col(review_col), 256))
    with_text = keyed.where(F.col("__k").isNotNull())
    prompted = with_prompts(_distinct_texts(with_text, review_col, "__review"), prompts, "__review", "__prompt_text").select(
        "__k", "__n", "__b", "prompt_id", "__prompt_text"
    )
    answers, total, top = _answered(
        prompted, "__prompt_text", "__answer", err_col, factory, hot_rows, batch_size=batch_size, on_error=on_error,
        concurrency=concurrency, answer_store=answer_store, model_id=model_id, wave_prompts=wave_prompts, profile=profile,
    )
    # every review was answered once per prompt
    out = _salted_join_back(with_text, answers, hot_rows, total // len(prompts), top)
    # a missing review has no answer under any prompt, and no part in the join
    without = with_prompts(keyed.where(F.col("__k").isNull()).drop("__k"), prompts, review_col, "__answer")
    out = out.unionByName(without.withColumn("__answer", F.lit(None).cast("string")).withColumn(err_col, F.lit(None).cast("string")))
    return out if error_col else out.drop(err_col)


# ---------------------------------------------------------------------------
# translation
# ---------------------------------------------------------------------------


def translate(
    df: DataFrame,
    factory: BackendFactory,
    review_col: str = REVIEW_COL,
    template: str = TRANSLATE_TEMPLATE,
    limit: int = -1,
    order_by: Sequence[str] = ("listing_id", "review_pos"),
    **generate_options,
) -> DataFrame:
    """I1 + P5: replace ``review_col`` by its translation.

    L2: with ``limit = n`` only the first n rows (in ``order_by`` order)
    are translated and every row is returned; ``-1`` translates all.
    Untranslated rows never reach a Python worker. A NULL review stays
    NULL. With ``on_error="null"`` a failed row keeps its original text.
    """
    prompt = Prompt(0, "", template)

    def _translated(rows: DataFrame) -> DataFrame:
        prompted = with_prompt(rows, prompt, review_col, "__prompt_text").drop("prompt_id")
        answered = generate(prompted, "__prompt_text", "__answer", factory, **generate_options)
        return answered.withColumn(
            review_col, F.coalesce(strip("__answer"), F.col(review_col))
        ).drop("__prompt_text", "__answer")

    if limit == -1:
        return _translated(df)
    flagged = first_rows_flag(df, limit, order_by, flag="__selected")
    chosen = _translated(flagged.where(F.col("__selected")))
    rest = flagged.where(~F.col("__selected"))
    return chosen.unionByName(rest).drop("__selected")
