"""Exact, repeatable row selection: L1 first rows and X1 dev/test split.

Both reduce to one question: which key tuple is the k-th smallest? The
answer (the *cut*) turns selection into a plain filter ``key <= cut``:
no rows move, no window runs in one task, and the result is the same
however the data is partitioned.

The cut is found by histogram refinement over integral key columns: one
aggregate per step counts rows per value bucket (at most ``buckets``
rows reach the driver), the bucket holding rank k becomes the new range,
and once the candidates are few their keys are collected and sorted.
Keys of other sortable types (text, timestamps, doubles ...) are narrowed
by splitters instead: a sample of the candidates, in Spark's own order, cuts
them into as many intervals, one aggregate counts them, and the interval of
rank k is next. A single key value that holds a third of all rows is handled by moving
on to the next key column, never by loading it into one task.
For small k the cut comes from ``orderBy(keys).limit(k)``, whose per-task
top-k keeps at most k keys per task; since every task sends those to the
driver, that path is taken only while k times the partition count is
within ``TOPK_BUDGET``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import moves_data
from revlens.sources.stage import materialize

# The top-k path is used for k up to this many rows, and only while k
# times the number of input partitions stays within TOPK_BUDGET: every
# task sends its own k smallest keys to the driver for the final merge.
TOPK_LIMIT = 10_000
TOPK_BUDGET = 2_000_000
# Candidates at or below this count are collected and sorted on the driver.
LOCAL_LIMIT = 50_000
BUCKETS = 4_096
# Intervals that one pass over keys of other types counts.
SPLITTERS = 32

_PLAIN = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.BooleanType, T.BinaryType)


def sortable(df: DataFrame, name: str) -> Column:
    """A key column as a value that Python and SQL literals carry exactly, in
    the same order: timestamps as microseconds, others as they are."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(kind, T.StringType) and kind.simpleString() == "string":
        return c
    if isinstance(kind, T.FloatType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, _PLAIN):
        return c
    raise TypeError(f"key {name} of type {kind.simpleString()} has no order that is the same for all (cast it first)")


def _all_integral(df: DataFrame, keys: Sequence[str]) -> bool:
    return all(isinstance(df.schema[k].dataType, T.IntegralType) for k in keys)


def _lex_le(keys: Sequence[str | Column], cut: Sequence, equal: bool = True) -> Column:
    """``(k1, k2, ...) <= (c1, c2, ...)`` in lexicographic order; ``equal``
    False: ``<``."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    expr = keys[-1] <= F.lit(cut[-1]) if equal else keys[-1] < F.lit(cut[-1])
    for c, value in zip(reversed(keys[:-1]), reversed(cut[:-1]), strict=True):
        expr = (c < F.lit(value)) | ((c == F.lit(value)) & expr)
    return expr


def _up_to(df: DataFrame, keys: Sequence[str], cut: Sequence) -> Column:
    """The rows of ``df`` up to a cut that :func:`cut_key` gave."""
    return _lex_le([sortable(df, k) for k in keys], cut)


def _bucket(c: Column, lo: int, hi: int, buckets: int) -> Column:
    """Monotone bucket number in [0, buckets) for lo <= c <= hi."""
    span = hi - lo + 1
    width = -(-span // buckets)
    if span < 2**62:
        return ((c - F.lit(lo)) / F.lit(width)).cast("long")
    # very wide ranges: doubles keep the order (rounding is monotone)
    return F.least(
        ((c.cast("double") - float(lo)) / float(width)).cast("long"), F.lit(buckets - 1)
    )


def _partitions(df: DataFrame) -> int:
    """Input partitions of ``df`` without running anything: behind an
    exchange the shuffle partition setting, else the scan's splits."""
    if moves_data(df):
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.rdd.getNumPartitions()


def cut_key(
    df: DataFrame,
    keys: Sequence[str],
    k: int,
    *,
    topk_limit: int = TOPK_LIMIT,
    topk_budget: int = TOPK_BUDGET,
    local_limit: int = LOCAL_LIMIT,
    buckets: int = BUCKETS,
) -> tuple:
    """Exact k-th smallest (1-based) tuple of the sortable columns ``keys``
    (each as :func:`sortable` has it), or None when ``df`` has fewer than k rows.

    Order is Spark's: text by its UTF-8 bytes (so '10' comes before '9': cast
    numbers first), NaN after all other doubles. Whichever way the cut is
    found, the same is checked: keys without an order (maps, intervals,
    collated text) are a TypeError, NULL keys and rows that tie with the cut
    beyond rank k are a ValueError.
    """
    keys = list(keys)
    if k < 1:
        raise ValueError("k must be at least 1")
    integral = _all_integral(df, keys)
    df = df.select(*(sortable(df, name).alias(name) for name in keys))
    cut = _find_cut(df, keys, k, topk_limit, topk_budget, local_limit, buckets, integral)
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(name).isNull()
    within = _lex_le(keys, cut) if cut is not None else F.lit(False)
    nulls, selected = df.agg(F.count_if(missing), F.count_if(within)).first()
    if nulls:
        raise ValueError(f"{nulls} rows have a NULL in key {tuple(keys)}")
    if cut is not None and selected != k:
        raise ValueError(f"key {tuple(keys)} is not unique: {selected} rows up to the cut at rank {k}")
    return cut


def _find_cut(df: DataFrame, keys: list[str], k: int, topk_limit: int, topk_budget: int, local_limit: int, buckets: int, integral: bool = True) -> tuple | None:
    """The k-th smallest key, NULLs set aside."""
    some = F.lit(True)
    for name in keys:
        some = some & F.col(name).isNotNull()
    cur = df.where(some)  # not dropna(): that drops NaN too, which is a value here
    if k <= topk_limit and k * _partitions(cur) <= topk_budget:
        rows = cur.orderBy(*keys).limit(k).collect()
        return tuple(rows[-1]) if len(rows) == k else None
    # several passes follow: scan a narrow written copy of the keys, not
    # the (possibly joined, parsed) source each time
    cur = materialize(cur, "cut-keys")
    if not integral:
        return _find_cut_by_splitters(cur, keys, k, local_limit)

    cond = F.lit(True)
    level = 0
    first = keys[0]
    stats = cur.agg(F.count(F.lit(1)), F.min(first), F.max(first)).first()
    n, lo, hi = stats[0], stats[1], stats[2]
    if k > n:
        return None
    while True:
        if n <= local_limit:
            rows = cur.where(cond).orderBy(*keys).collect()
            return tuple(rows[k - 1])
        name = keys[level]
        c = F.col(name)
        if lo == hi:
            # one value holds all candidates: fix it, refine the next key
            cond = cond & (c == F.lit(lo))
            level += 1
            if level >= len(keys):  # more than local_limit equal keys
                return tuple(cur.where(cond).first())
            nxt = keys[level]
            stats = cur.where(cond).agg(F.count(F.lit(1)), F.min(nxt), F.max(nxt)).first()
            n, lo, hi = stats[0], stats[1], stats[2]
            continue
        hist = (
            cur.where(cond)
            .groupBy(_bucket(c, lo, hi, buckets).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi"))
            .collect()
        )
        seen = 0
        for row in sorted(hist, key=lambda r: r["b"]):
            if seen + row["n"] >= k:
                k -= seen
                n, lo, hi = row["n"], row["lo"], row["hi"]
                break
            seen += row["n"]
        cond = cond & (c >= F.lit(lo)) & (c <= F.lit(hi))


def _interval(keys: Sequence[str], splitters: list[tuple]) -> Column:
    """2i for keys between splitters i - 1 and i, 2i + 1 for keys equal to
    splitter i: a binary search, as nested conditions."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        mid = (low + high) // 2
        equal = F.lit(True)
        for name, value in zip(keys, splitters[mid], strict=True):
            equal = equal & (F.col(name) == F.lit(value))
        return F.when(_lex_le(keys, splitters[mid], equal=False), within(low, mid)).when(equal, F.lit(2 * mid + 1)).otherwise(within(mid + 1, high))

    return within(0, len(splitters))


def _find_cut_by_splitters(cur: DataFrame, keys: list[str], k: int, local_limit: int) -> tuple | None:
    """The k-th smallest key of a written table, for keys of any order.

    Each pass samples rows (so a key that holds a third of them is a
    splitter, and its equals are counted apart), sorts the sample in Spark,
    and counts the intervals. Only counts and splitters reach the driver.
    """
    cond, n, turn = F.lit(True), cur.count(), 0
    if k > n:
        return None
    while True:
        if n <= local_limit:
            return tuple(cur.where(cond).orderBy(*keys).limit(k).collect()[-1])
        turn += 1
        share = min(1.0, 4 * SPLITTERS / n)
        sample = cur.where(cond).sample(fraction=share, seed=turn).distinct().orderBy(*keys).limit(64 * SPLITTERS).collect()
        if not sample:
            sample = cur.where(cond).limit(1).collect()
        step = max(1, len(sample) // SPLITTERS)
        splitters = [tuple(r) for r in sample[step // 2 :: step]]
        counts = cur.where(cond).groupBy(_interval(keys, splitters).alias("i")).count().collect()
        seen = 0
        for row in sorted(counts, key=lambda r: r["i"]):
            if seen + row["count"] >= k:
                break
            seen += row["count"]
        i, at = row["i"], row["i"] // 2
        if i % 2:
            return splitters[at]
        k, n = k - seen, row["count"]
        if at > 0:
            cond = cond & ~_lex_le(keys, splitters[at - 1])
        if at < len(splitters):
            cond = cond & _lex_le(keys, splitters[at], equal=False)


# ---------------------------------------------------------------------------
# L1: first n rows
# ---------------------------------------------------------------------------


def first_rows(df: DataFrame, n: int, order_by: Sequence[str], **cut_options) -> DataFrame:
    """L1: the first ``n`` rows in ``order_by`` order; ``n = -1`` keeps all.

    ``order_by`` plays the role of file order (for example
    ``listing_id, review_pos``, or a timestamp and a name) and must be a
    unique key of sortable columns (see :func:`cut_key`).
    Other negative values are rejected. Only key columns are ranked; the
    rows themselves are kept by a filter, so wide rows never meet in one
    task. The result is a set (use ``orderBy`` to display it in order).
    """
    if n == -1:
        return df
    if n < 0:
        raise ValueError("limit must be -1 (all rows) or >= 0")
    if n == 0:
        return df.limit(0)
    order_by = list(order_by)
    cut = cut_key(df, order_by, n, **cut_options)
    return df if cut is None else df.where(_up_to(df, order_by, cut))


def first_rows_flag(df: DataFrame, n: int, order_by: Sequence[str], flag: str = "selected", **cut_options) -> DataFrame:
    """L2 helper: flag the first ``n`` rows instead of dropping the rest."""
    if n == -1:
        return df.withColumn(flag, F.lit(True))
    if n < 0:
        raise ValueError("limit must be -1 (all rows) or >= 0")
    if n == 0:
        return df.withColumn(flag, F.lit(False))
    order_by = list(order_by)
    cut = cut_key(df, order_by, n, **cut_options)
    if cut is None:
        return df.withColumn(flag, F.lit(True))
    return df.withColumn(flag, _up_to(df, order_by, cut))


# ---------------------------------------------------------------------------
# Exact seeded split
# ---------------------------------------------------------------------------


def split_hash(keys: str | Sequence[str | Column], seed: int) -> Column:
    """Order of the split: the first 60 bits of md5('<seed>:<k1>[:<k2>...]')."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws(":", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def n_test_rows(n: int, test_size: float) -> int:
    """Rows in the test part: ceil(test_size * n), as scikit-learn sizes it."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be between 0 and 1")
    return math.ceil(test_size * n)


def exact_split(
    df: DataFrame,
    key: str | Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    flag: str = "split",
    **cut_options,
) -> DataFrame:
    """Tag every row 'test' or 'dev'; exactly ceil(test_size*n) test.

    Rows are ordered by a seeded hash of the unique ``key`` (sortable columns,
    timestamps by their microseconds); the smallest ceil(test_size*n) are test. Membership depends only on key
    and seed, so it is the same after any repartition, and a re-run
    gives the same split. Spark's ``randomSplit`` is neither exact nor
    partition-independent, so it is not used. ``key`` may be several
    columns (for example ``listing_id, review_pos``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_split_h", split_hash([sortable(df, k) for k in keys], seed))
    n = hashed.count()
    if n == 0:
        return df.withColumn(flag, F.lit(None).cast("string"))
    k = n_test_rows(n, test_size)
    cut = cut_key(hashed, ["_split_h", *keys], k, **cut_options)
    is_test = _up_to(hashed, ["_split_h", *keys], cut)
    return hashed.withColumn(flag, F.when(is_test, F.lit("test")).otherwise(F.lit("dev"))).drop("_split_h")


def dev_test(df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = 42, **cut_options) -> tuple[DataFrame, DataFrame]:
    """X1 as two frames (dev, test)."""
    tagged = exact_split(df, key, test_size, seed, flag="_part", **cut_options)
    dev = tagged.where(F.col("_part") == "dev").drop("_part")
    test = tagged.where(F.col("_part") == "test").drop("_part")
    return dev, test
