"""Stage 4: choose a prompt on dev, evaluate it on test.

``read -> L1 -> X1 -> dev x prompts -> model -> write -> A1 -> A5 ->
test x best -> model -> write -> A2..A4``.

Two inference jobs, each written once to the stage folder; every later
step reads those files, so no model call is repeated when a result is
used twice or an executor is lost. Reviews and predictions are written in
buckets of the review key, so joining them moves no rows. The only driver round-trip between
them is the per-prompt deviation table (a row a prompt).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from revlens.functions.text import fmt2
from revlens.operators.inference import BackendFactory, score
from revlens.operators.prompts import DEFAULT_PROMPTS, Prompt, as_prompts
from revlens.operators.sampling import exact_split, first_rows
from revlens.operators.scoring import deviation, pick_best, summary
from revlens.schemas import REVIEW_COL, SCORE_COL
from revlens.sources.csv import write_csv
from revlens.sources.stage import materialize, materialize_bucketed


@dataclass
class Evaluation:
    prompt: Prompt
    dev_mae: float
    deviations: list[Row]
    dev: DataFrame
    test: DataFrame
    summary: DataFrame

    def report(self) -> str:
        """the printed summary, two decimals."""
        s = self.summary.first()
        lines = [f"prompt {r['prompt_id']}: deviation {fmt2(r['mae'])}" for r in self.deviations]
        lines.append(f"best prompt: {self.prompt.prompt_id}")
        lines.append(f"mean real: {fmt2(s['media_real'])}")
        lines.append(f"mean predicted: {fmt2(s['media_predicha'])}")
        lines.append(f"mean deviation: {fmt2(s['desviacion'])}")
        return "\n".join(lines)


def evaluate(
    reviews: DataFrame,
    factory: BackendFactory,
    prompts: Sequence[Prompt | str] = DEFAULT_PROMPTS,
    *,
    limit: int = 250,
    test_size: float = 0.2,
    seed: int = 42,
    key: Sequence[str] = ("listing_id", "review_pos"),
    output_dir: str | None = None,
    **generate_options,
) -> Evaluation:
    """I4 + I5 over a review table ``(key..., Review, Review_Score)``.

    ``limit``: first n reviews in key order (L1), -1 for all.
    ``output_dir``: also write ``dev`` / ``test`` predictions as CSV (S3).
    """
    prompts = as_prompts(prompts)
    keys = list(key)
    # One scan of the source: the rows are written once, and everything
    # after reads (key, Review, Review_Score) or less from that copy.
    rows = materialize(reviews, "reviews")
    rows = first_rows(rows, limit, keys)
    tagged = materialize_bucketed(exact_split(rows, keys, test_size, seed, flag="__part"), "tagged", keys)
    narrow = tagged.select(*keys, REVIEW_COL, SCORE_COL, "__part")
    dev = narrow.where(F.col("__part") == "dev").drop("__part")
    test = narrow.where(F.col("__part") == "test").drop("__part")

    # predictions carry the key, not the text: it is the same for each prompt
    dev_preds = materialize_bucketed(score(dev, factory, prompts, **generate_options).drop(REVIEW_COL), "dev-predictions", keys)
    # a row a prompt; A5 (lowest deviation, ties to the lower id, NULL
    # never wins) is applied to the collected rows
    deviations = sorted(deviation(dev_preds).collect(), key=lambda r: r["prompt_id"])
    best_id, best_mae = pick_best(deviations)
    best = next(p for p in prompts if p.prompt_id == best_id)

    test_preds = materialize_bucketed(score(test, factory, best, **generate_options).drop(REVIEW_COL), "test-predictions", keys)
    whole = tagged.drop(SCORE_COL, "__part")
    dev_best = whole.join(dev_preds.where(F.col("prompt_id") == best_id), keys)
    test_preds = whole.join(test_preds, keys)
    if output_dir:
        write_csv(dev_best, f"{output_dir.rstrip('/')}/dev_predictions")
        write_csv(test_preds, f"{output_dir.rstrip('/')}/test_predictions")
    return Evaluation(best, best_mae, deviations, dev_best, test_preds, summary(test_preds))
