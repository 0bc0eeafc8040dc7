"""Rows that every operator has to take, and brute-force results."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

# Columns whose names clash with those that operators use inside.
CLASHING = ("uid", "n_words", "size", "row", "found", "part", "length", "shard", "kept", "e", "a", "b", "_id", "_text", "_keep", "rank", "n")


def texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(120)
    out: list[str | None] = [None, "", "   \n\t ", "one", "a b c d", "A B c D", "a b c d e", "a b c d e f", "\x0bx\x0cy\u00a0z\x1cq"]
    out += [base, base, base.upper(), base + " tail", "head " + base]
    for k in range(12):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{k}"
        out.append(" ".join(w))
    for k in range(5):  # a shared passage
        out.append(f"{prose(30)}\n{passage}\n{prose(25)}")
    out += [passage, f"{passage} {passage}", "x y z " * 40, "l1 a\nl1 a\n\nl2 #$|\nl1 a\n "]
    out += [prose(n) for n in (4, 9, 10, 13, 20, 34, 35, 36, 300)]
    for k in range(6):  # small sets, some linked
        out.append(" ".join(f"s{j}" for j in range(k % 3, 12)))
    out.append(prose(6000))
    return out


def documents(spark, rows: list[tuple] | None = None):
    """(doc_id, text) with the clashing columns; by default every edge text, two equal rows and a null id."""
    if rows is None:
        rows = list(enumerate(texts()))
        rows += [(200, "same row " * 20), (200, "same row " * 20), (None, "no id here at all")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
    return spark.createDataFrame([(i, t, *(["?"] * len(CLASHING))) for i, t in rows], schema).repartition(3)


def plain(spark, rows=None):
    """The same rows on the driver."""
    return [(r["doc_id"], r["text"]) for r in documents(spark, rows).select("doc_id", "text").collect()]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def repeats(rows, size: int):
    """(id, words, removed, kept words) of each row."""
    every = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in every for k in range(len(w) - size + 1))
    out = []
    for i, w in every:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = words(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if text else text)
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_components(rows, percent: int = 80):
    """Sorted (id, set size, smallest id reachable), comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    near = defaultdict(set)
    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                near[x].add(y)
                near[y].add(x)
    out, done = [], set()
    for x in range(len(sets)):
        if x in done:
            continue
        group, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - group:
                group.add(y)
                todo.append(y)
        done |= group
        low = min((sets[g][0] for g in group if sets[g][0] is not None), default=None)
        out += [(sets[g][0], len(sets[g][1]), low) for g in group]
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=repr)
