"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words whose smallest period is q (words
q apart are identical), at least max(``LEAST``, ``TIMES`` * q) words long,
that no neighbouring word extends with the same period.

* Splitting: every word of a run occurs at least ``TIMES`` times in it. So
  a word that occurs less often within its segment lies in no run, and
  splits the segment. What remains is counted anew, until no segment has
  such a word. Segments too short for a run go. Splitting only sets aside
  words that can't matter, so it may end early (``ROUNDS``) on texts made
  to be split one word at a time; the scan below is exact on any segment.
* Lag scan: lags up to ``SHORT`` are compared word by word. A longer lag q
  shows as the distance from a window of W >= q > W / 2 words (W a power of
  two) to its next occurrence, since the windows of a run recur at its
  smallest period and not before. Equal distances of neighbouring windows
  give the run's two ends, which are then compared word by word. So a
  segment of n words takes some n log n steps for each power of two, however
  long its periods may be.

A word is dropped if a run holds it after the run's first q words.

Cases: a null or empty text, or one without words, has no run (n_runs 0,
nulls, hashes of the empty string); very long texts are scanned whole, in
a slice of their own; of runs of greatest length the first start, then the
smallest period counts; repeated rows are answered alike, a null id too;
extra columns are ignored whatever their names; an empty table gives an
empty result. Nothing is shuffled: rows are independent.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textscan
from revlens.llm.stage import tuned

LEAST = 6
TIMES = 4
ROUNDS = 64
SHORT = 16


class Runs(NamedTuple):
    """Runs of flat words by start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def segments(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment of each): the words that splitting leaves, in order.
    ``names`` are dense numbers of words, ``row`` tells the rows apart."""
    at, seg = np.arange(len(names)), row.astype(np.int64)
    done_at, done_seg, base = [], [], 0
    width = int(names.max()) + 1 if len(names) else 1
    for turn in range(ROUNDS + 1):
        if not len(at):
            break
        # neighbours in a segment stay neighbours in the text
        new = np.ones(len(at), dtype=bool)
        new[1:] = (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + 1)
        seg = np.cumsum(new) - 1
        size = np.bincount(seg)
        alive = size[seg] >= LEAST
        at, seg = at[alive], seg[alive]
        if turn == ROUNDS:
            rare = np.zeros(len(at), dtype=bool)
        else:
            _, of, n = np.unique(seg * width + names[at], return_inverse=True, return_counts=True)
            rare = n[of] < TIMES
        split = np.bincount(seg, weights=rare, minlength=len(size)) > 0
        stable = ~split[seg]
        done_at.append(at[stable])
        done_seg.append(seg[stable] + base)
        base += len(size)
        keep = ~stable & ~rare
        at, seg = at[keep], seg[keep]
    if not done_at:
        return at, seg
    at, seg = np.concatenate(done_at), np.concatenate(done_seg)
    order = np.argsort(at, kind="stable")
    return at[order], seg[order]


def _stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, one past the last) of each stretch of True."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _short_lags(words: np.ndarray, seg: np.ndarray) -> list[np.ndarray]:
    """(start, length, period) rows of the runs of period up to ``SHORT``."""
    out, same = [], {}
    for q in range(1, min(SHORT, len(words) // TIMES) + 1):
        hit = (words[:-q] == words[q:]) & (seg[:-q] == seg[q:])
        same[q] = np.concatenate([[0], np.cumsum(hit)])
        a, b = _stretches(hit)
        long = b - a + q >= max(LEAST, TIMES * q)
        a, b = a[long], b[long]
        # a stretch of period q has a smaller one exactly if a divisor of q is one
        for d in range(1, q // 2 + 1):
            if q % d == 0 and len(a):
                own = same[d][a + q] - same[d][a] < q
                a, b = a[own], b[own]
        out.append(np.stack([a, b - a + q, np.full(len(a), q)], axis=1))
    return out


def _long_lags(words: np.ndarray, hashes: np.ndarray, seg: np.ndarray) -> list[np.ndarray]:
    """The same for longer periods, by the next occurrence of windows."""
    out, size, at = [], 2 * SHORT, np.arange(len(words))
    while True:
        # segments that can hold a run of a period above size / 2
        new = np.diff(seg, prepend=seg[0] - 1 if len(seg) else 0) != 0
        many = np.bincount(np.cumsum(new) - 1) if len(seg) else np.zeros(0, dtype=np.int64)
        long = np.repeat(many >= TIMES * (size // 2 + 1), many)
        at, words, hashes, seg = at[long], words[long], hashes[long], seg[long]
        if len(words) < 2 * size:
            return out
        window = textscan.window_hash(hashes, size)
        inner = seg[: len(window)] == seg[size - 1 :]
        place = np.flatnonzero(inner)
        place = place[np.argsort(window[place], kind="stable")]
        first, then = place[:-1], place[1:]
        ok = (window[first] == window[then]) & (seg[first] == seg[then])
        gap = np.zeros(len(window), dtype=np.int64)
        gap[first[ok]] = then[ok] - first[ok]
        gap[(gap <= size // 2) | (gap > size)] = 0
        edge = np.flatnonzero(np.diff(gap, prepend=0, append=0) != 0)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            q = int(gap[a])
            length = b - a + size - 1 + q
            if q and length >= max(LEAST, TIMES * q) and (words[a : a + length - q] == words[a + q : a + length]).all():
                out.append(np.array([[at[a], length, q]]))
        size *= 2


def find(hashes: np.ndarray, row: np.ndarray) -> Runs:
    """All runs of the words with these hashes; ``row`` tells the rows apart."""
    blank = np.zeros(0, dtype=np.int64)
    if not len(hashes):
        return Runs(blank, blank, blank)
    _, names = np.unique(hashes, return_inverse=True)
    at, seg = segments(names, row)
    if not len(at):
        return Runs(blank, blank, blank)
    words, hashes = names[at], hashes[at]
    found = np.concatenate([np.zeros((0, 3), dtype=np.int64), *_short_lags(words, seg), *_long_lags(words, hashes, seg)])
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return Runs(at[found[:, 0]], found[:, 1], found[:, 2])


def dropped(runs: Runs, n: int) -> np.ndarray:
    """The words that lie in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs.start + runs.period, 1)
    np.add.at(edge, runs.start + runs.length, -1)
    return np.cumsum(edge[:-1]) > 0


def joined(text: textscan.Text, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> list[bytes]:
    """The words [start, end) of each row, joined by one space."""
    length = end - start
    at = textscan.gather_ranges(start, length + 1)
    data = np.append(text.data, np.uint8(32))[at]
    stop = np.cumsum(length + 1)
    data[stop - 1] = 32
    n = np.bincount(row, minlength=text.rows)
    last = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(n)])]
    whole = data.tobytes()
    return [whole[a : max(a, b - 1)] for a, b in zip(last[:-1].tolist(), last[1:].tolist())]


Rewrite = Callable[[list, np.ndarray], np.ndarray]


def planted(ids: list, first: np.ndarray) -> np.ndarray:
    """Which original word stands at each place once every tenth text (by the
    crc32 of its id) repeats from some word on with some period. A null id
    leaves its text alone."""
    out = np.arange(int(first[-1]))
    for k, doc in enumerate(ids):
        n = int(first[k + 1] - first[k])
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        out[first[k] + a : first[k + 1]] = first[k] + a + np.arange(n - a) % p
    return out


_FIELDS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rewrite: Rewrite | None = None, with_text: bool = False) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256[, runs, collapsed]) for every row.

    The four numbers are those of the longest run. ``with_text`` adds the
    runs themselves and the collapsed text. ``rewrite`` (ids, first words)
    names the original word that is to stand at each place, to plant runs.
    """
    tuned(docs)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                ids = batch.column("_id").slice(text.first, text.rows)
                w = textscan.words(text)
                row = textscan.row_of(w.first)
                hashes = textscan.span_hash(text.data, w.start, w.end)
                start, end = w.start, w.end
                if rewrite is not None:
                    source_of = rewrite(ids.to_pylist(), w.first)
                    hashes, start, end = hashes[source_of], start[source_of], end[source_of]
                runs = find(hashes, row)
                keep = ~dropped(runs, len(hashes))
                plain = joined(text, start[keep], end[keep], row[keep])
                of = row[runs.start]
                n = np.bincount(of, minlength=text.rows)
                offset = runs.start - w.first[of]
                said = [f"{s},{m},{q}\n" for s, m, q in zip(offset.tolist(), runs.length.tolist(), runs.period.tolist())]
                stop = np.concatenate([[0], np.cumsum(n)])
                best = np.lexsort((runs.period, runs.start, -runs.length, of))
                top = [int(best[a]) if a < b else None for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())]
                lists = [said[a:b] for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())]

                def of_top(values: np.ndarray) -> pa.Array:
                    return pa.array([None if t is None else int(values[t]) for t in top], pa.int64())

                columns = {
                    "_id": ids, "n_runs": pa.array(n, pa.int64()), "start": of_top(offset), "length": of_top(runs.length), "period": of_top(runs.period),
                    "exponent_milli": of_top(1000 * runs.length // np.maximum(runs.period, 1)),
                    "runs_sha256": pa.array([hashlib.sha256("".join(x).encode()).hexdigest() for x in lists], pa.string()),
                    "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in plain], pa.string()),
                }
                if with_text:
                    columns |= {"runs": pa.array([[x.rstrip("\n") for x in r] for r in lists], pa.list_(pa.string())), "collapsed": pa.array([x.decode("utf-8", "replace") for x in plain], pa.string())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"_id {kind}, {_FIELDS}" + (", runs array<string>, collapsed string" if with_text else "")
    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
