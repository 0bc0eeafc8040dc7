"""Prompt sets and their application to review rows.

A prompt set is a driver-side list. Applying it to reviews is a Generate
(``explode`` of a literal array) inside the scan's pipeline: every review
row yields one row per prompt, no join and no shuffle. Only a set too
large for a literal is joined as a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import SLOT, render
from revlens.schemas import REVIEW_COL

# A prompt set travels in the plan as a literal. Above this many
# characters in all it is joined as a small table instead.
LITERAL_CHARS = 256 * 1024


PROMPT_TABLE = "__at int, __prompt struct<prompt_id: int, template: string>"


@dataclass(frozen=True)
class Prompt:
    prompt_id: int
    lang: str
    template: str

    def __post_init__(self) -> None:
        if SLOT not in self.template:
            raise ValueError(f"prompt {self.prompt_id} has no {SLOT} slot")


# Three ways to ask for a score: a rubric, a comparison, and a bare order.
DEFAULT_PROMPTS: tuple[Prompt, ...] = (
    Prompt(
        0,
        "es",
        "{review}\n---\nLo anterior lo escribió un huésped. Guía de notas: 1-3 queja, 4-6 tibio, 7-8 contento, "
        "9-10 entusiasmado. ¿Qué nota entera le corresponde? Escribe la cifra sin más.",
    ),
    Prompt(
        1,
        "es",
        "Imagina diez comentarios ordenados del más descontento (1) al más feliz (10). "
        "¿En qué puesto iría este?\n«{review}»\nPuesto:",
    ),
    Prompt(2, "en", "text: {review}\nsatisfaction (integer, 1 = low, 10 = high):"),
)

TRANSLATE_TEMPLATE = "Source (any language):\n{review}\n\nSame message in plain English, nothing added:"


def as_prompts(prompts: Sequence[Prompt | str]) -> list[Prompt]:
    """Normalise a prompt list; plain strings get ids in list order."""
    out = [p if isinstance(p, Prompt) else Prompt(i, "", p) for i, p in enumerate(prompts)]
    if not out:
        raise ValueError("at least one prompt is needed")
    if len({p.prompt_id for p in out}) != len(out):
        raise ValueError("prompt ids must be unique")
    return out


def _prompt_array(prompts: Sequence[Prompt]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(p.prompt_id).alias("prompt_id"), F.lit(p.template).alias("template"))
            for p in prompts
        ]
    )


def with_prompts(
    df: DataFrame,
    prompts: Sequence[Prompt | str] = DEFAULT_PROMPTS,
    review_col: str = REVIEW_COL,
    text_col: str = "prompt_text",
) -> DataFrame:
    """J1 + F6: one row per (review, prompt) with the rendered prompt.

    Adds ``prompt_id`` and ``text_col``; a NULL review renders NULL.
    """
    prompts = as_prompts(prompts)
    tmp = "__prompt"
    if sum(len(p.template) for p in prompts) <= LITERAL_CHARS:
        each = df.withColumn(tmp, F.explode(_prompt_array(prompts)))
    else:
        # too large for the plan: rows are numbered by prompt, then matched
        table = df.sparkSession.createDataFrame([(i, (p.prompt_id, p.template)) for i, p in enumerate(prompts)], PROMPT_TABLE)
        each = df.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(len(prompts) - 1)))).join(table, "__at").drop("__at")
    return (
        each
        .withColumn("prompt_id", F.col(f"{tmp}.prompt_id"))
        .withColumn(text_col, render(F.col(f"{tmp}.template"), F.col(review_col)))
        .drop(tmp)
    )


def with_prompt(
    df: DataFrame,
    prompt: Prompt | str,
    review_col: str = REVIEW_COL,
    text_col: str = "prompt_text",
) -> DataFrame:
    """J2 + F6: a single prompt applied to every row (a projection)."""
    p = prompt if isinstance(prompt, Prompt) else Prompt(0, "", prompt)
    return df.withColumn("prompt_id", F.lit(p.prompt_id)).withColumn(
        text_col, render(F.lit(p.template), F.col(review_col))
    )
