"""Distributions compared by mergeable quantile sketches.

Means hide how scores are spread. Each group's values are summarised by a
KLL sketch: a few kilobytes whatever the number of rows, built in the map
tasks and merged, also with sketches that were written on other days. From
two sketches the distance of the distributions follows.

A sketch with parameter ``k`` answers ranks within ``rank_error(k)`` of all
rows (1.33 % for the default of 200, at 99 % confidence). So the value
given for a quantile q is an exact quantile of some q' within that of q, and
the distance (largest difference of the two cumulative shares, as
Kolmogorov and Smirnov have it) is within twice that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 200
SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def rank_error(k: int = K) -> float:
    """Error of a rank, as a share of the rows, at 99 % confidence (published
    figure of the KLL sketch for single ranks)."""
    return 2.296 / k**0.9021


def sketches(df: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """(*by, sketch, n): a sketch of ``value`` for each group. NULL and NaN are
    left out. Written as Parquet, they can be merged later (:func:`merged`)."""
    number = F.col(value).cast("double")
    given = df.where(number.isNotNull() & ~F.isnan(number))
    return given.groupBy(*by).agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"), F.count("*").alias("n"))


def merged(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of the same group from several tables, as one."""
    return found.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def quantiles(found: DataFrame, shares: Sequence[float] = SHARES) -> DataFrame:
    """(*by, n, q05, q25, ...): the value at each share, within the rank error."""
    named = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(f"q{round(100 * s):02d}") for s in shares]
    return found.select(*(c for c in found.columns if c != "sketch"), *named)


def distances(found: DataFrame, by: str, points: int = 199) -> DataFrame:
    """(one, other, distance) for each two groups: the largest difference of
    their cumulative shares, each read from ``points`` quantiles (which adds
    1 / (points + 1) to the error). Groups are countries or methods: this
    compares all of them with each other, on one row a pair."""
    shares = F.array(*(F.lit((i + 1) / (points + 1)) for i in range(points)))
    curves = found.select(by, F.kll_sketch_get_quantile_double("sketch", shares).alias("curve"))
    one, other = (curves.select(F.col(by).alias(c), F.col("curve").alias(f"{c}_curve")) for c in ("one", "other"))
    pairs = one.join(other, F.col("one") < F.col("other"))
    at = pairs.select("*", F.explode(F.array_distinct(F.concat("one_curve", "other_curve"))).alias("value"))
    below = lambda c: F.size(F.filter(f"{c}_curve", lambda x: x <= F.col("value"))) / (points + 1)
    return at.groupBy("one", "other").agg(F.max(F.abs(below("one") - below("other"))).alias("distance"))
