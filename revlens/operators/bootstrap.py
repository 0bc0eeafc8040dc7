"""Intervals of the deviations by a Poisson bootstrap (A1, A4, A5).

The prompt of lowest mean deviation is chosen on one set of reviews; on
another the order might differ. Every replicate weighs each review by a
Poisson(1) number, as often as resampling with replacement would draw it,
and all replicates are sums of one aggregate: weights come from a hash of
the review's key and the replicate, so they need no shuffle, no random
state and no pass of their own, and a re-run task repeats them. A review has
the same weight under every prompt, so replicates compare prompts on the
same draw.

From the replicates: an interval of each prompt's deviation, and the share
of replicates in which it would have been chosen (A5's rule: lowest
deviation, ties to the lower id).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import abs_diff
from revlens.operators.sampling import sortable
from revlens.operators.scoring import real_score
from revlens.schemas import PRED_COL, SCORE_COL

REPLICATES = 200
# One md5 gives eight numbers of 16 bits.
_A_HASH, _BITS = 8, 16


def poisson_cuts(bits: int = _BITS) -> list[int]:
    """The numbers below 2**bits from which a Poisson(1) weight is 1, 2, ..."""
    cuts, p, total = [], math.exp(-1), 0.0
    for k in range(1, 20):
        total += p
        p /= k
        cut = math.floor(total * (1 << bits))
        if cut >= (1 << bits) - 1:
            break
        cuts.append(cut)
    return cuts


def _weight(number: Column) -> Column:
    out = F.lit(0)
    for k, cut in enumerate(poisson_cuts(), 1):
        out = F.when(number >= cut, F.lit(k)).otherwise(out)
    return out


def with_weights(df: DataFrame, key: Sequence[str], replicates: int = REPLICATES, seed: int = 42) -> DataFrame:
    """``df`` times replicates: ``replicate`` (from 0) and ``weight`` above 0.

    The number of replicate r is the (r % 8)-th group of four hex digits of
    md5('<seed>:<r // 8>:<k1>[:<k2>...]').
    """
    text = F.concat_ws(":", *(sortable(df, k).cast("string") for k in key))
    hashes = -(-replicates // _A_HASH)
    drawn = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("__c"), text.alias("__key"))
    drawn = drawn.withColumn("__hex", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__c").cast("string"), "__key")))
    places = F.explode(F.sequence(F.lit(0), F.lit(_A_HASH - 1))).alias("__i")
    drawn = drawn.select(*df.columns, "__c", "__hex", places)
    number = F.conv(F.substring(F.col("__hex"), F.col("__i") * 4 + 1, F.lit(4)), 16, 10).cast("int")
    out = drawn.select(*df.columns, (F.col("__c") * _A_HASH + F.col("__i")).alias("replicate"), _weight(number).alias("weight"))
    return out.where((F.col("weight") > 0) & (F.col("replicate") < replicates))


def replicate_deviations(
    preds: DataFrame, key: Sequence[str] = ("listing_id", "review_pos"), real_col: str = SCORE_COL, pred_col: str = PRED_COL,
    by: str = "prompt_id", replicates: int = REPLICATES, seed: int = 42,
) -> DataFrame:
    """(by, replicate, mae): each replicate's mean deviation; one aggregate of
    prompts x replicates groups, combined in the map tasks. Pairs with a
    missing side are skipped before anything is drawn."""
    diff = abs_diff(real_score(preds, real_col), F.col(pred_col))
    pairs = preds.select(by, *key, diff.alias("__diff")).where(F.col("__diff").isNotNull())
    weighed = with_weights(pairs, key, replicates, seed)
    sums = weighed.groupBy(by, "replicate").agg(F.sum(F.col("weight") * F.col("__diff")).alias("total"), F.sum("weight").alias("rows"))
    return sums.select(by, "replicate", (F.col("total") / F.col("rows")).alias("mae"))


def deviation_intervals(
    preds: DataFrame, key: Sequence[str] = ("listing_id", "review_pos"), real_col: str = SCORE_COL, pred_col: str = PRED_COL,
    by: str = "prompt_id", replicates: int = REPLICATES, seed: int = 42, level: float = 0.95,
) -> DataFrame:
    """(by, low, median, high, wins): the interval of the deviation between the
    nearest ranks of (1 - level) / 2 and (1 + level) / 2, and the share of
    replicates that the prompt wins. Replicates x prompts rows are all that
    this works on after the one aggregate."""
    if not 0 < level < 1:
        raise ValueError("level must be between 0 and 1")
    found = replicate_deviations(preds, key, real_col, pred_col, by, replicates, seed)
    won = found.groupBy("replicate").agg(F.min(F.struct("mae", F.col(by))).alias("best")).select(F.col(f"best.{by}").alias(by)).groupBy(by).agg(F.count("*").alias("won"))
    ranked = found.groupBy(by).agg(F.sort_array(F.collect_list("mae")).alias("all"))
    at = lambda share: F.get("all", F.greatest(F.ceil(F.size("all") * F.lit(share)), F.lit(1)).cast("int") - 1)
    total = found.select(F.countDistinct("replicate").alias("drawn"))
    return ranked.join(won, by, "left").crossJoin(F.broadcast(total)).select(
        by, at((1 - level) / 2).alias("low"), at(0.5).alias("median"), at((1 + level) / 2).alias("high"), (F.coalesce("won", F.lit(0)) / F.col("drawn")).alias("wins")
    )
