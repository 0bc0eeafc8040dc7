"""Decision lists for text quality, learned by sequential covering.

Every text gets statistics; a list of rules is learned from labelled
ones. A rule is a conjunction of thresholds that calls a text bad. Rules
are grown one condition at a time on two thirds of the labelled rows by
information gain, pruned from the end on the other third, kept if they
are precise there, and the rows they cover are set aside before the next
one. The list becomes an ordered Spark conditional (first rule that holds
decides, otherwise good), so judging is a column expression.

Statistics cover all rows. The list is fitted on at most ``max_labelled``
labelled rows, chosen by a hash of their id.

Cases: a null or empty text has no words and fails the base rule; ties
between conditions go to the earlier statistic and the wider gap between values;
repeated rows are judged alike; a row labelled twice counts as bad if any
label says so; without labels (or with one class) the list is empty and
the base rule alone decides; extra columns pass through, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import textscan
from revlens.llm.stage import appended

WINDOW = 5
MAX_LABELLED = 20_000

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
_SHARES = {
    "symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"), "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}
STATISTICS = (*_SHARES, "n_words")
_FIELDS = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS])

_SYMBOL, _UPPER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b"!?;:")] = True


def _per_row(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marked) + 1, dtype=np.int64)
    np.cumsum(marked, out=total[1:])
    return np.diff(total[offsets])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs again anywhere; whether it occurred before."""
    _, first, at, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    before = np.ones(len(keys), dtype=bool)
    before[first] = False
    return n[at] > 1, before


def count_text(text: textscan.Text) -> list[np.ndarray]:
    """The counts of ``_COUNTS`` for each row of a slice."""
    w = textscan.words(text)
    filled = ~textscan._SPACE[text.data]
    n_words = w.counts
    point = (text.data & 0xC0) != 0x80
    # lines: cut at newlines and row starts
    cut = np.zeros(len(text.data) + 1, dtype=bool)
    cut[1:][text.data == 10] = True
    cut[text.offsets] = True
    start = np.flatnonzero(cut)
    start, end = start[:-1], start[1:]
    line_row = np.searchsorted(text.offsets, start, side="right") - 1
    end = end - (text.data[end - 1] == 10) if len(end) else end
    has_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, line_row = start[has_word], end[has_word], line_row[has_word]
    line = textscan.mix(textscan.span_hash(text.data, start, end) + textscan.mix(line_row.astype(np.uint64)))
    n_lines, n_dup = np.bincount(line_row, minlength=text.rows), np.zeros(text.rows, dtype=np.int64)
    if len(line):
        n_dup = np.bincount(line_row[_repeats(line)[1]], minlength=text.rows)
    n_repeat = np.zeros(text.rows, dtype=np.int64)
    at = textscan.inside(w.first, WINDOW)
    if len(at):
        row = textscan.row_of(w.first)
        window = textscan.window_hash(textscan.span_hash(text.data, w.start, w.end), WINDOW)[at]
        found = at[_repeats(textscan.mix(window + textscan.mix(row[at].astype(np.uint64))))[0]]
        covered = np.zeros(len(row) + WINDOW, dtype=bool)
        for k in range(WINDOW):
            covered[found + k] = True
        n_repeat = np.bincount(row[covered[: len(row)]], minlength=text.rows)
    counted = [_per_row(m, text.offsets) for m in (filled & point, _SYMBOL[text.data])]
    more = [_per_row(m[text.data], text.offsets) for m in (_UPPER, _DIGIT, _MARK)]
    return [x.astype(np.int64) for x in (n_words, *counted, n_dup, n_repeat, n_lines, *more)]


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, found): each row, and its counts."""
    return appended(df, text_col, count_text, _FIELDS)


def statistic(name: str) -> Column:
    """A statistic of ``found`` as a number between rows of any length (0 for no words)."""
    if name in _SHARES:
        part, whole = _SHARES[name]
        return F.coalesce(F.col(f"found.{part}") / F.nullif(F.col(f"found.{whole}"), F.lit(0)), F.lit(0.0))
    return F.col(f"found.{name}").cast("double")


def base_failed() -> Column:
    return (F.col("found.n_words") < 10) | (100 * F.col("found.n_repeat_words") > 20 * F.col("found.n_words"))


class Condition(NamedTuple):
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = statistic(self.name)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.threshold if self.above else values[self.name] <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(values.values()))), dtype=bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _conditions(values: np.ndarray, name: str, cuts: int) -> Iterator[Condition]:
    """Thresholds half way between neighbouring values, the widest gaps first,
    and evenly spaced ones among the values."""
    known = np.unique(values)
    if len(known) < 2:
        return
    gaps = np.diff(known)
    spaced = np.linspace(0, len(gaps) - 1, cuts).astype(np.int64)
    for at in dict.fromkeys([*np.argsort(-gaps, kind="stable")[: cuts // 4].tolist(), *spaced.tolist()]):
        cut = float((known[at] + known[at + 1]) / 2)
        yield Condition(name, True, cut)
        yield Condition(name, False, cut)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int, cuts: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < max_conditions and bad[inside].any() and not bad[inside].all():
        p, n = bad[inside].sum(), inside.sum()
        best, best_gain = None, 1e-9
        for name in values:
            for condition in _conditions(values[name][inside], name, cuts):
                now = inside & condition.holds(values)
                p1, n1 = bad[now].sum(), now.sum()
                gain = p1 * (np.log2(p1 / n1) - np.log2(p / n)) if p1 else 0.0
                if gain > best_gain:
                    best, best_gain = condition, gain
        if best is None:
            break
        rule, inside = (*rule, best), inside & best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(part: Rule) -> float:
        covered = _covers(part, values)
        p, n = bad[covered].sum(), (~bad[covered]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def learn(values: dict[str, np.ndarray], bad: np.ndarray, *, max_rules: int = 12, max_conditions: int = 4, cuts: int = 40, precision: float = 0.95, support: int = 3) -> list[Rule]:
    """Sequential covering over labelled rows; row order decides the folds."""
    rules: list[Rule] = []
    fold = np.arange(len(bad)) % 3
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < max_rules:
        grow, hold = left & (fold < 2), left & (fold == 2)
        if bad[grow].sum() < support or bad[hold].sum() < 1:
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow], max_conditions, cuts)
        if not rule:
            break
        rule = _prune(rule, {k: v[hold] for k, v in values.items()}, bad[hold])
        covered = _covers(rule, values) & left
        seen = [bad[covered & side] for side in (grow, hold)]
        if bad[covered].sum() < support or any(len(x) and x.mean() < precision for x in seen):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional: true is good."""
    if not rules:
        return F.lit(True)
    conjunction = []
    for rule in rules:
        one = rule[0].column()
        for condition in rule[1:]:
            one = one & condition.column()
        conjunction.append(one)
    out = F.when(conjunction[0], F.lit(False))
    for one in conjunction[1:]:
        out = out.when(one, F.lit(False))
    return out.otherwise(F.lit(True))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, found): the counts of every row, without its text."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return with_statistics(source, "_text").select("row._id", "found")


def fit(found: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", *, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules from the ``statistics`` whose label is 0 (bad) or 1 (good).

    Joins narrow rows only. About ``max_labelled`` labelled ids are chosen
    by hash, and no more than twice as many rows reach the driver.
    """
    known = labels.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label")).filter("_label is not null and _id is not null")
    total = known.count()
    if not total:
        return []
    share = min(1.0, max_labelled / total)
    chosen = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = (
        found.filter(~base_failed()).join(chosen, "_id").select("_id", "_label", *(statistic(c).alias(c) for c in STATISTICS))
        .limit(2 * max_labelled).toPandas().sort_values(["_id", *STATISTICS], kind="stable")
    )
    if rows.empty:
        return []
    rows = rows.iloc[np.argsort(textscan.mix(np.arange(len(rows), dtype=np.uint64)), kind="stable")]
    return learn({c: rows[c].to_numpy(dtype=float) for c in STATISTICS}, rows["_label"].to_numpy() == 0)


def judge(found: DataFrame, rules: list[Rule], id_col: str = "doc_id") -> DataFrame:
    """(id, counts, base_failed, kept) for every row of ``statistics``."""
    return found.select(
        F.col("_id").alias(id_col), *(F.col(f"found.{c}").alias(c) for c in _COUNTS[:5]),
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the list, all columns."""
    return with_statistics(docs, text_col).filter(~base_failed() & verdict(rules)).select("row.*")
