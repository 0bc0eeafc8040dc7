"""Toxicity categories by a classifier chain of linear models.

The categories are predicted one after another. Each is a logistic model
over words, which also takes the probabilities of the categories before
it. In training those probabilities are out of fold: a row's come from
models that did not see the row, so a later model learns how far to trust
an earlier one. In use they come from the models fitted on all rows.

Models are fitted on at most about ``max_labelled`` labelled rows, chosen
by a hash of their id; the words that tell the classes apart are chosen
on those rows. Scoring is one pass over whole texts, on word spans.

A word counts as present or absent (ASCII lower case, marks set apart), so
repetition does not move a verdict; the first 4, 5 and 6 bytes of a longer
word count as words too, for stems that take many endings.

Cases: a null or empty text has no words and gets the models' intercepts;
repeated rows are scored alike; an id labelled twice takes the larger
label; without labels, or where a category has one class only, its
probability is that class; extra columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import chunks, textscan
from revlens.llm.stage import appended

MAX_LABELLED = 6_000
WORD_BITS = 20
MAX_WORDS = 2_048
FOLDS = 3
STEMS = (4, 5, 6)
# Rows that a word must occur in to be chosen.
LEAST_ROWS = 3


def _word_rows(text: textscan.Text) -> tuple[np.ndarray, np.ndarray]:
    """(row, number below 2**WORD_BITS) of the distinct words and stems of each row."""
    start, end, first = chunks.bare_words(text)
    if not len(start):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty
    low = textscan.lower_ascii(text).data
    row, parts = textscan.row_of(first), []
    for size in (0, *STEMS):
        longer = np.flatnonzero(end - start > size)
        stop = start[longer] + size if size else end[longer]
        word = textscan.span_hash(low, start[longer], stop)
        if size:
            word = textscan.mix(word + np.uint64(size))
        parts.append((row[longer] << WORD_BITS) | (word >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    keys = np.unique(np.concatenate(parts))
    return keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)


class Linear(NamedTuple):
    """Weights of the chosen words and of the earlier categories' probabilities."""

    words: np.ndarray
    before: np.ndarray
    intercept: float

    def score(self, row: np.ndarray, word: np.ndarray, rows: int, before: np.ndarray) -> np.ndarray:
        z = np.bincount(row, weights=self.words[word], minlength=rows) + before @ self.before + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Chain(NamedTuple):
    """``place`` maps a word number to its column, -1 where it tells nothing."""

    categories: tuple[str, ...]
    place: np.ndarray
    models: tuple[Linear, ...]

    def probabilities(self, row: np.ndarray, word: np.ndarray, rows: int) -> np.ndarray:
        column = self.place[word]
        row, column = row[column >= 0], column[column >= 0]
        out = np.zeros((rows, 0))
        for model in self.models:
            out = np.column_stack([out, model.score(row, column, rows, out)])
        return out


def _fit_one(row, column, rows: int, width: int, before: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 120) -> Linear:
    """Logistic regression by accelerated gradient descent on sparse rows."""
    if not rows or y.min() == y.max():
        only = float(y[0]) if rows else 0.0
        return Linear(np.zeros(width), np.zeros(before.shape[1]), 30.0 if only else -30.0)
    words, extra = np.zeros(width), np.zeros(before.shape[1])
    intercept = float(np.log(y.mean() / (1 - y.mean())))
    # diagonal bound on the curvature, one step size a column
    per_row = np.bincount(row, minlength=rows) + 1 + before.shape[1]
    step_word = 1 / (np.bincount(column, weights=per_row[row], minlength=width) / 4 + penalty)
    step_extra = 1 / ((before**2 * per_row[:, None]).sum(axis=0) / 4 + penalty)
    step_zero = 4 / per_row.sum()
    w, e, b = words.copy(), extra.copy(), intercept
    for t in range(steps):
        z = np.bincount(row, weights=w[column], minlength=rows) + before @ e + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        w1 = w - step_word * (np.bincount(column, weights=error[row], minlength=width) + penalty * w)
        e1 = e - step_extra * (before.T @ error + penalty * e)
        b1 = b - step_zero * error.sum()
        ahead = t / (t + 3)
        w, e, b = w1 + ahead * (w1 - words), e1 + ahead * (e1 - extra), b1 + ahead * (b1 - intercept)
        words, extra, intercept = w1, e1, b1
    return Linear(words, extra, float(intercept))


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(np.where(x > 0, x, 1.0))


def _telling(row, word, rows: int, labels: np.ndarray, max_words: int) -> np.ndarray:
    """Columns of the words that tell some category's classes apart best, by
    likelihood ratio; beyond what chance gives the best of so many words."""
    size = 1 << WORD_BITS
    seen = np.bincount(word, minlength=size)
    worth = np.zeros(size)
    for y in labels.T:
        p = y.mean() if rows else 0.0
        if 0 < p < 1:
            hits = np.bincount(word, weights=y[row], minlength=size)
            ratio = hits * _log(hits / np.maximum(seen * p, 1e-9)) + (seen - hits) * _log((seen - hits) / np.maximum(seen * (1 - p), 1e-9))
            worth = np.maximum(worth, 2 * ratio)
    worth[worth < 2 * np.log(max((seen > 0).sum(), 2))] = 0
    best = np.argsort(-worth, kind="stable")[:max_words]
    best = best[worth[best] > 0]
    place = np.full(size, -1, dtype=np.int64)
    place[best] = np.arange(len(best))
    return place


def learn(row, word, labels: np.ndarray, fold: np.ndarray, categories: tuple[str, ...], *, max_words: int = MAX_WORDS, folds: int = FOLDS) -> Chain:
    """A chain from the distinct words of labelled rows; ``labels`` has one column a category."""
    rows = len(labels)
    place = _telling(row, word, rows, labels, max_words)
    width = int((place >= 0).sum())
    column = place[word]
    row, column = row[column >= 0], column[column >= 0]
    models, before = [], np.zeros((rows, 0))
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        models.append(_fit_one(row, column, rows, width, before, y))
        out_of_fold = np.zeros(rows)
        if k + 1 < len(categories):
            for f in range(folds):
                out = fold == f
                number = np.cumsum(~out) - 1
                kept = ~out[row]
                part = _fit_one(number[row[kept]], column[kept], int((~out).sum()), width, before[~out], y[~out])
                number = np.cumsum(out) - 1
                out_of_fold[out] = part.score(number[row[~kept]], column[~kept], int(out.sum()), before[out])
        before = np.column_stack([before, out_of_fold])
    return Chain(tuple(categories), place, tuple(models))


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", *, max_labelled: int = MAX_LABELLED) -> Chain:
    """A chain over ``categories`` (name -> SQL condition on the labels, in chain order)."""
    names = tuple(categories)
    known = labels.filter(f"{id_col} is not null").groupBy(F.col(id_col).alias("_id")).agg(
        *(F.max(F.coalesce(F.expr(c).cast("int"), F.lit(0))).alias(n) for n, c in categories.items())
    )
    total = known.count()
    if not total:
        return learn(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, len(names))), np.zeros(0), names)
    limit = F.lit(int(min(1.0, max_labelled / total) * (1 << 20)))
    chosen = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < limit

    def distinct(text: textscan.Text):
        row, word = _word_rows(text)
        return [textscan.as_arrow_lists(word, np.bincount(row, minlength=text.rows), pa.int32())]

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(chosen)
    fields = T.StructType([T.StructField("words", T.ArrayType(T.IntegerType()))])
    found = appended(source, "_text", distinct, fields).select("row._id", "found.words")
    rows = found.join(known.filter(chosen), "_id").limit(2 * max_labelled).toPandas()
    rows = rows.assign(_n=[len(w) for w in rows["words"]]).sort_values(["_id", "_n"], kind="stable")
    fold = (textscan.mix(np.arange(len(rows), dtype=np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
    y, every = rows[list(names)].to_numpy(dtype=float), rows.pop("words").tolist()
    del rows
    # words seen in few rows can not be chosen: set them aside row by row
    seen = np.zeros(1 << WORD_BITS, dtype=np.int32)
    for w in every:
        seen[w] += 1
    every = [np.asarray(w, dtype=np.int32)[seen[w] >= LEAST_ROWS] for w in every]
    row = np.repeat(np.arange(len(every), dtype=np.int32), [len(w) for w in every])
    return learn(row, np.concatenate([*every, np.zeros(0, dtype=np.int32)]), y, fold, names)


def with_probabilities(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """(row, found): each row, and a probability for each category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = T.StructType([T.StructField(c, T.DoubleType()) for c in chain.categories])

    def score(text: textscan.Text):
        row, word = _word_rows(text)
        return list(shared.value.probabilities(row, word, text.rows).T.copy())

    return appended(docs, text_col, score, fields)
