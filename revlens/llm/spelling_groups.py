"""Spelling variants of words, by a trie over letter-group counts.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, lower-cased (A-Z only),
counted over the whole table: in each task first, then by Spark. Of these
the ones of at least ``LETTERS`` code points and ``TIMES`` occurrences form
the vocabulary.

Two words are near if they differ by exactly one inserted, deleted or
replaced code point. To find them:

* The letters are dealt to ``GROUPS`` groups that occur about equally often.
  A word's counts by group, one after another, are its path in a trie. One
  replaced letter raises one count and lowers another at most; an inserted
  or deleted one changes a single count.
* The first levels are walked by Spark: a word goes to every branch (prefix
  of the path) that a budget of one surplus and one deficit reaches. As many
  levels are taken as bring branches down to ``BRANCH`` words; a branch that
  is larger even so is cut into parts, and its visitors meet every part.
* Below, each task searches its branch depth first: from a node to the
  children whose count equals the word's, or exceeds it by one (spending the
  surplus) or falls short by one (the deficit). Words of one path are walked
  together, and blocks of nodes are taken from a stack, deepest first, so
  memory stays bounded.
* The words of the leaves that are reached are verified letter by letter.

A pair is found once: from the word of the smaller path (equal paths: the
smaller word). A word's form is its near word of largest n (ties: the
smallest in code-point order), if that n is at least twice its own; its root
is the end of the chain of forms, found by doubling.

Cases: a null or empty text, or one without letters, gives no words; very
long texts and runs are read whole (counts of a group end at 31, which only
lets more words through to the verification); repeated rows count as often
as they stand there; a null id stands as nothing before the colon where
letters are deleted; extra columns are ignored whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textscan
from revlens.llm.stage import materialize, tuned

LETTERS = 5
TIMES = 3
GROUPS = 12
BITS = 5
MOST = (1 << BITS) - 1
BRANCH = 1 << 16
# Distinct words that a task holds before it hands their counts on.
HELD = 500_000
# Nodes, and pairs of words, that are looked at in one go.
NODES = 1 << 18
PAIRS = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8

Mutate = Callable[[list, np.ndarray, "Runs"], np.ndarray]


class Runs:
    """The letter runs of a slice: Latin-1 codes, where each run begins (n + 1),
    the row of each, and its bytes in the slice."""

    def __init__(self, text: textscan.Text) -> None:
        low = textscan.lower_ascii(text)
        data = low.data
        lead = data == _LEAD
        after = np.zeros(len(data), dtype=bool)
        after[1:] = lead[:-1]
        inside = _LETTER[data] | lead | after
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[text.offsets] = True
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        starts, ends = edge == 1, edge == -1
        # neighbouring rows may both have a letter at their common edge
        joint = cut.copy()
        joint[0] = joint[-1] = False
        joint[1:-1] &= inside[1:] & inside[:-1]
        self.data = data
        self.start, self.end = np.flatnonzero(starts | joint), np.flatnonzero(ends | joint)
        self.row = np.searchsorted(text.offsets, self.start, side="right") - 1
        following = np.zeros(len(data), dtype=np.uint8)
        following[:-1] = data[1:]
        point = inside & ~after
        self.codes = np.where(lead, following + np.uint8(0x40), data)[point]
        before = np.concatenate([[0], np.cumsum(point)])
        self.first = np.append(before[self.start], len(self.codes))

    def __len__(self) -> int:
        return len(self.start)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CRC = _crc_table()
_BY_BYTE = 64


def crc32_after(prefix: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each span, gone on from the crc32 of what stands before it."""
    length = end - start
    out = prefix.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    for k in order[: int((length > _BY_BYTE).sum())].tolist():
        out[k] = zlib.crc32(data[start[k] : end[k]].tobytes(), int(prefix[k])) ^ 0xFFFFFFFF
    order = order[int((length > _BY_BYTE).sum()) :]
    sizes = -length[order]
    for at in range(int(-sizes[0]) if len(order) else 0):
        live = order[: int(np.searchsorted(sizes, -at))]
        state = out[live]
        out[live] = _CRC[(state ^ data[start[live] + at]) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
    return out ^ np.uint32(0xFFFFFFFF)


def misspelt(ids: list, rows: np.ndarray, runs: Runs) -> np.ndarray:
    """Which code points stay, once every 97th run (by the crc32 of id, colon
    and run) has lost one."""
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids] or [0], dtype=np.uint32)
    h = crc32_after(prefix[rows], runs.data, runs.start, runs.end).astype(np.int64)
    hit = np.flatnonzero(h % 97 == 0)
    keep = np.ones(len(runs.codes), dtype=bool)
    keep[runs.first[hit] + h[hit] % (runs.first[hit + 1] - runs.first[hit])] = False
    return keep


def _counted(docs: DataFrame, mutate: Mutate | None) -> DataFrame:
    """(word, n), combined within each task."""

    def batch_of(held: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                runs = Runs(text)
                if not len(runs):
                    continue
                keep = np.ones(len(runs.codes), dtype=bool)
                if mutate is not None:
                    keep = mutate(batch.column("_id").slice(text.first, text.rows).to_pylist(), runs.row, runs)
                first = np.concatenate([[0], np.cumsum(keep)])[runs.first]
                codes = runs.codes[keep]
                long = np.diff(first) >= LETTERS
                start, end = first[:-1][long], first[1:][long]
                _, at, n = np.unique(textscan.span_hash(codes, start, end), return_index=True, return_counts=True)
                whole = codes.tobytes()
                for a, b, many in zip(start[at].tolist(), end[at].tolist(), n.tolist()):
                    word = whole[a:b]
                    held[word] = held.get(word, 0) + many
                if len(held) > HELD:
                    yield batch_of(held)
                    held = {}
        yield batch_of(held)

    return docs.mapInArrow(run, "word string, n bigint")


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each Latin-1 code: the letters by how often the vocabulary
    holds them (at most 90 letters), each to the group that is least used."""
    found = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().filter("letter <> ''").collect()
    used = np.zeros(GROUPS, dtype=np.int64)
    out = np.zeros(256, dtype=np.int64)
    for r in sorted(found, key=lambda r: (-r["count"], r["letter"])):
        g = int(used.argmin())
        out[ord(r["letter"])] = g
        used[g] += r["count"]
    return out


def paths(codes: np.ndarray, first: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Each word's counts by group, one after another in one number."""
    n = len(first) - 1
    counts = np.bincount(np.repeat(np.arange(n), np.diff(first)) * GROUPS + group[codes], minlength=n * GROUPS).reshape(n, GROUPS)
    shift = np.arange(GROUPS - 1, -1, -1, dtype=np.int64) * BITS
    return (np.minimum(counts, MOST) << shift).sum(axis=1)


def flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first) of words of Latin-1 letters."""
    first = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in words], out=first[1:])
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8), first


def _with_path(words: DataFrame, group: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, first = flat(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(paths(codes, first, group), pa.int64())], names=["word", "n", "path"])

    return words.mapInArrow(run, "word string, n bigint, path bigint")


def _prefix(levels: int):
    return F.shiftright("path", BITS * (GROUPS - levels))


def _visited(path: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, branch): the branches at or after a path's own within the budget."""
    own = path >> (BITS * (GROUPS - levels))
    count = [(own >> (BITS * (levels - 1 - g))) & MOST for g in range(levels)]
    up = lambda g: 1 << (BITS * (levels - 1 - g))
    every = np.arange(len(path))
    at, branch = [every], [own]
    for g in range(levels):
        more = every[count[g] < MOST]
        at.append(more)
        branch.append(own[more] + up(g))
        for h in range(g + 1, levels):
            both = more[count[h][more] > 0]
            at.append(both)
            branch.append(own[both] + up(g) - up(h))
    return np.concatenate(at), np.concatenate(branch)


def reached(leaves: np.ndarray, path: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(path, leaf) places of the leaves that each path's budget reaches, in
    the trie of the sorted distinct ``leaves``: depth first, block by block."""
    blank = np.zeros(len(path), dtype=np.int64)
    stack = [(0, np.arange(len(path)), blank, blank, blank)]
    while stack:
        level, q, node, surplus, deficit = stack.pop()
        if len(q) > NODES:
            half = len(q) // 2
            stack += [(level, *(x[s] for x in (q, node, surplus, deficit))) for s in (slice(half, None), slice(half))]
            continue
        if level == GROUPS:
            yield q, np.searchsorted(leaves, node)
            continue
        rest = BITS * (GROUPS - 1 - level)
        count = (path[q] >> rest) & MOST
        parts = []
        for step, ok in ((0, None), (1, (surplus == 0) & (count < MOST)), (-1, (deficit == 0) & (count > 0))):
            at = np.arange(len(q)) if ok is None else np.flatnonzero(ok)
            child = (node[at] << BITS) | (count[at] + step)
            there = np.searchsorted(leaves, child << rest)
            there = np.minimum(there, len(leaves) - 1)
            live = (leaves[there] >> rest) == child
            at, child = at[live], child[live]
            parts.append((q[at], child, surplus[at] + (step == 1), deficit[at] + (step == -1)))
        stack.append((level + 1, *(np.concatenate(x) for x in zip(*parts))))


def differ_by_one(a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i of a and j of b differ by exactly one inserted, deleted or replaced letter."""
    la, lb = a_first[i + 1] - a_first[i], b_first[j + 1] - b_first[j]
    short = np.minimum(la, lb)
    out = np.zeros(len(i), dtype=bool)
    begin, live = np.zeros(len(i), dtype=np.int64), np.flatnonzero(np.abs(la - lb) <= 1)
    ok = live
    while len(live):
        at = begin[live]
        live = live[at < short[live]]
        at = begin[live]
        live = live[a[a_first[i[live]] + at] == b[b_first[j[live]] + at]]
        begin[live] += 1
    need = short[ok] - begin[ok] - (la[ok] == lb[ok])
    done = 0
    equal = need < 0  # the words are the same
    ok, need = ok[~equal], need[~equal]
    while len(ok):
        out[ok[need == done]] = True
        ok, need = ok[need > done], need[need > done]
        done += 1
        same = a[a_first[i[ok] + 1] - done] == b[b_first[j[ok] + 1] - done]
        ok, need = ok[same], need[same]
    return out


def _near(words: DataFrame, group: np.ndarray, branch: int) -> DataFrame:
    """(word, other, other_n): every near word of every word."""
    sized = materialize(words.groupBy("path").agg(F.count("*").alias("many")), "paths")
    largest = sized.select(*(_prefix(k).alias(f"p{k}") for k in range(1, GROUPS + 1)), "many")
    levels = next((k for k in range(1, GROUPS) if (largest.groupBy(f"p{k}").agg(F.sum("many").alias("m")).agg(F.max("m")).first()[0] or 0) <= branch), GROUPS)
    # at most one row for every ``branch`` words
    large = F.broadcast(sized.groupBy(_prefix(levels).alias("branch")).agg(F.ceil(F.sum("many") / branch).cast("int").alias("parts")).filter("parts > 1"))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, to = _visited(batch.column("path").to_numpy(zero_copy_only=False), levels)
            picked = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *(picked.column(c) for c in ("path", "word", "n"))], names=["branch", "path", "word", "n"])

    stored = words.select(_prefix(levels).alias("branch"), "path", "word", "n").join(large, "branch", "left").select(
        "branch", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"), F.lit(0).alias("role"), "path", "word", "n"
    )
    visitors = words.mapInArrow(visits, "branch bigint, path bigint, word string, n bigint").join(large, "branch", "left").select(
        "branch", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), F.lit(1).alias("role"), "path", "word", "n"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, pieces, trie = None, [], None

        def build(pieces: list[pa.RecordBatch]):
            table = pa.Table.from_batches(pieces)
            path = table.column("path").to_numpy()
            names = table.column("word").to_pylist()
            leaves, start, many = np.unique(path, return_index=True, return_counts=True)
            return leaves, start, many, path, names, *flat(names), table.column("n").to_numpy()

        def meet(own: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            leaves, begin, size, path, names, codes, first, n = trie
            q_path, q_names = own.column("path").to_numpy(zero_copy_only=False), own.column("word").to_pylist()
            q_codes, q_first = flat(q_names)
            q_n = own.column("n").to_numpy(zero_copy_only=False)
            steps, q_begin, q_size = np.unique(q_path, return_index=True, return_counts=True)
            for q, leaf in reached(leaves, steps):
                onward = leaves[leaf] >= steps[q]
                q, leaf = q[onward], leaf[onward]
                total = np.cumsum(q_size[q] * size[leaf])
                for lot in np.split(np.arange(len(q)), np.flatnonzero(np.diff(total // PAIRS)) + 1) if len(q) else ():
                    a, b = q[lot], leaf[lot]
                    # every word of the path with every word of the leaf
                    left = textscan.gather_ranges(q_begin[a], q_size[a])
                    many = np.repeat(size[b], q_size[a])
                    right = textscan.gather_ranges(np.repeat(begin[b], q_size[a]), many)
                    left = np.repeat(left, many)
                    near = differ_by_one(q_codes, q_first, codes, first, left, right)
                    left, right = left[near], right[near]
                    level = path[right] == q_path[left]
                    once = np.array([not same or q_names[x] < names[y] for same, x, y in zip(level.tolist(), left.tolist(), right.tolist())], dtype=bool)
                    left, right = left[once], right[once]
                    if len(left):
                        x, y = [q_names[k] for k in left.tolist()], [names[k] for k in right.tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x + y, pa.string()), pa.array(y + x, pa.string()), pa.array(np.concatenate([n[right], q_n[left]]), pa.int64())], names=["word", "other", "other_n"]
                        )

        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("branch", "part", "role")]
            edge = np.zeros(batch.num_rows, dtype=bool)
            edge[:1] = True
            for k in keys:
                edge[1:] |= k[1:] != k[:-1]
            start = np.flatnonzero(edge).tolist()
            for i, to in zip(start, [*start[1:], batch.num_rows]):
                if unit != (keys[0][i], keys[1][i]):
                    unit, pieces, trie = (keys[0][i], keys[1][i]), [], None
                piece = batch.slice(i, to - i)
                if keys[2][i] == 0:
                    pieces.append(piece)
                elif pieces:
                    trie = trie or build(pieces)
                    yield from meet(piece)

    dealt = stored.unionByName(visitors).repartition("branch", "part").sortWithinPartitions("branch", "part", "role", "path")
    return dealt.mapInArrow(search, "word string, other string, other_n bigint")


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of its chain, whose
    length is at most the binary logarithm of the largest n."""
    roots = materialize(formed.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, mutate: Mutate | None = None, branch: int = BRANCH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary.

    ``mutate`` (ids, row of each run, runs) names the code points that stay,
    to plant misspellings.
    """
    tuned(docs)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counted = _counted(source, mutate).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= TIMES)
    words = materialize(counted, "vocabulary")
    group = letter_groups(words)
    near = _near(materialize(_with_path(words, group), "words"), group, branch)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best")).alias("best")
    )
    formed = materialize(formed.select("word", F.col("best.other").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
