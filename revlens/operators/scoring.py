"""Evaluation aggregates (A1-A5, A7) over scored reviews.

All are global or per-prompt: a handful of groups, combined map-side,
so the shuffle carries one partial row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.text import abs_diff, parse_comma_decimal
from revlens.schemas import ERROR_COL, PRED_COL, SCORE_COL


def real_score(df: DataFrame, col: str = SCORE_COL) -> Column:
    """the real score as a double, whether stored as text (maybe with
    a decimal comma) or as a number. NaN becomes NULL."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        value = parse_comma_decimal(F.col(col))
    else:
        value = F.col(col).cast("double")
    return F.when(~F.isnan(value), value)


def deviation(
    preds: DataFrame,
    real_col: str = SCORE_COL,
    pred_col: str = PRED_COL,
    by: tuple[str, ...] = ("prompt_id",),
) -> DataFrame:
    """A1 + A7: mean absolute deviation per group, pairs with a missing
    side skipped; plus how many answers were numeric, how many were not,
    and how many calls failed.

    Output ``(*by, mae, n_rows, n_numeric, n_bad, n_failed)``; ``mae`` is
    NULL when no pair is complete.
    """
    real = real_score(preds, real_col)
    pred = F.col(pred_col)
    answered = F.col("response").isNotNull() if "response" in preds.columns else F.lit(True)
    return preds.groupBy(*by).agg(
        F.avg(abs_diff(real, pred)).alias("mae"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(pred).alias("n_numeric"),
        F.count_if(pred.isNull() & answered).alias("n_bad"),
        F.count(F.col(ERROR_COL) if ERROR_COL in preds.columns else F.lit(None)).alias("n_failed"),
    )


def best_prompt(dev_deviation: DataFrame) -> DataFrame:
    """A5: the prompt with the lowest deviation; a tie goes to the lower
    prompt id (list order). Prompts whose deviation is NULL never win.

    One row ``(prompt_id, mae)``, or none when every deviation is NULL.
    """
    ranked = dev_deviation.where(F.col("mae").isNotNull())
    return ranked.agg(
        F.min_by("prompt_id", F.struct("mae", "prompt_id")).alias("prompt_id"),
        F.min("mae").alias("mae"),
    ).where(F.col("prompt_id").isNotNull())


def pick_best(rows) -> tuple[int, float]:
    """A5 over already collected deviation rows (same rule as
    :func:`best_prompt`)."""
    ranked = sorted((r["mae"], r["prompt_id"]) for r in rows if r["mae"] is not None)
    if not ranked:
        raise ValueError("no prompt produced a numeric answer; nothing to choose")
    mae, prompt_id = ranked[0]
    return int(prompt_id), float(mae)


def summary(test_preds: DataFrame, real_col: str = SCORE_COL, pred_col: str = PRED_COL) -> DataFrame:
    """A2 + A3 + A4 on the test rows: mean real score, mean predicted
    score (each over its own non-missing rows) and mean absolute
    deviation over complete pairs."""
    real = real_score(test_preds, real_col)
    pred = F.col(pred_col)
    return test_preds.agg(
        F.avg(real).alias("media_real"),
        F.avg(pred).alias("media_predicha"),
        F.avg(abs_diff(real, pred)).alias("desviacion"),
    )
