"""Spelling variants, SetSketch near duplicates, periodic runs: against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revlens.llm import jaccard_join, periodic_runs, queries, setsketch_dedup, sketch, spelling_groups, textscan
from revlens.llm.components import contracted, joined_by
from tests.llm import cases

# --- 11 ------------------------------------------------------------------------


def letter_runs(rows):
    """Counts of all runs after the planted misspellings."""
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelling(rows):
    vocabulary = letter_runs(rows)
    near = {w: [x for x in vocabulary if one_apart(w, x)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 2 * n else None
    out = []
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocabulary[form[w]] if form[w] else None))
    return cases.ordered(out)


def spelling_texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioubcdfgÀéÿ×") for _ in range(rng.randint(4, 8))) for _ in range(25)]
    words += ["z" * 80, "z" * 81, "z" * 79 + "y", "q" * 3000, "q" * 3001, "aaaaa", "aaaaaa", "aaaaaaa", "baaaa", "abaaa"]
    out = []
    for _ in range(60):
        line = []
        for _ in range(40):
            w = rng.choice(words[: rng.choice([5, len(words)])])
            k = rng.randrange(len(w))
            line.append(rng.choice([w, w, w.upper(), w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "y" + w[k + 1 :]]))
        out.append(rng.choice([" ", "-", "1", "…", "·"]).join(line))
    return [*out, None, "", "123 --", "x", "é" * 5, "abĀcd", *out[:3]]


@pytest.mark.parametrize("branch", [1 << 16, 4])  # whole tries; branches in parts
def test_spelling_against_brute_force(spark, branch):
    rows = [*enumerate(spelling_texts()), (None, "hello hello hello helo"), (None, None)]
    got = spelling_groups.variants(cases.documents(spark, rows), mutate=spelling_groups.misspelt, branch=branch)
    want = spelling(rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert cases.ordered(map(tuple, got.collect())) == want
    assert sum(r[1] is not None for r in want) > 50 and max(r[4] for r in want) > 5


def test_spelling_of_nothing(spark):
    assert spelling_groups.variants(cases.documents(spark, [])).collect() == []
    assert spelling_groups.variants(cases.documents(spark, [(1, None), (2, "a b")])).collect() == []


@pytest.mark.parametrize("limit", [1, 5, 1 << 20])
def test_runs_and_their_crc32(limit):
    rows = ["é", "ab", "cÉ d", None, "Zz×÷ Āx", "", "q" * 100 + " r"]
    got = []
    for text in textscan.slices(pa.array(rows), limit):
        runs = spelling_groups.Runs(text)
        names = [runs.codes[a:b].tobytes().decode("latin-1") for a, b in zip(runs.first[:-1], runs.first[1:])]
        got += [(text.first + r, w) for r, w in zip(runs.row.tolist(), names)]
        prefix = np.array([zlib.crc32(b"7:")] * len(runs), dtype=np.uint32)
        assert spelling_groups.crc32_after(prefix, runs.data, runs.start, runs.end).tolist() == [zlib.crc32(f"7:{w}".encode()) for w in names]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert got == [(i, w.translate(lower)) for i, t in enumerate(rows) for w in re.findall("[A-Za-zÀ-ÿ]+", t or "")]


def test_trie_reaches_every_path_within_the_budget():
    rng = np.random.default_rng(2)
    group = rng.integers(0, spelling_groups.GROUPS, 256)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 5, rng.integers(1, 9))) for _ in range(300)]
    path = np.unique(spelling_groups.paths(*spelling_groups.flat(words), group))
    counts = np.stack([(path >> (spelling_groups.BITS * g)) & spelling_groups.MOST for g in range(spelling_groups.GROUPS)], axis=1)
    want = {(i, j) for i in range(len(path)) for j in range(len(path)) if np.maximum(counts[j] - counts[i], 0).sum() <= 1 and np.maximum(counts[i] - counts[j], 0).sum() <= 1}
    assert {(int(a), int(b)) for q, leaf in spelling_groups.reached(path, path) for a, b in zip(q, leaf)} == want


# --- 12 ------------------------------------------------------------------------


def near_copies(seed=1, many=60):
    """Chains and stars of near copies, template texts just below the threshold, small sets."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    out, at = [], list(base)
    for k in range(many):
        edited = list(base)
        for _ in range(rng.randint(1, 16)):
            edited[rng.randrange(200)] = f"e{k}{rng.randrange(99)}"
        out.append(" ".join(edited))
        for _ in range(6):  # a chain: each is near the one before
            at[rng.randrange(200)] = f"c{k}{rng.randrange(99)}"
        out.append(" ".join(at))
    out += [" ".join(f"s{j}" for j in range(k % 4, 5 + k % 7)) for k in range(30)]
    return out


def pair_components(rows):
    """As the operator gives them, by comparing all pairs of 2-word shingle sets."""
    sets = [cases.shingle_set(t, 2) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                parent[find(x)] = find(y)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return cases.ordered((i, len(sets[k]), low.get(find(k)) if sets[k] else i, i == (low.get(find(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(setsketch_dedup, "CHUNK", 8)
    monkeypatch.setattr(setsketch_dedup, "MEMBERS", 5)
    rows = [*enumerate(cases.texts()), *enumerate(near_copies(seed), 1000), (5000, "same row " * 20), (5000, "same row " * 20), (None, "no id"), (None, None)]
    got = setsketch_dedup.groups(cases.documents(spark, rows))
    assert cases.ordered(map(tuple, got.collect())) == pair_components(rows)


def test_sets_that_link_apart_from_their_hub(spark):
    """Links among sets that do not link with the set that their buckets
    gather around: by shared words outside it, or inside it."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    out = [" ".join(base)]
    for k in range(40):
        edited = list(base)
        for _ in range(3):
            edited[rng.randrange(300)] = f"e{k}{rng.randrange(99)}"
        out.append(" ".join(edited))
    for k in range(12):  # pairs that share 16 edits and have 4 each
        both = list(base)
        for j in range(16):
            both[17 * j + k] = f"both{k}{j}"
        for side in "xy":
            edited = list(both)
            for j in range(4):
                edited[31 * j + 7 + k] = f"{side}{k}{j}"
            out.append(" ".join(edited))
    out += [" ".join(base[: 225 + k]) for k in range(-3, 6)]  # parts of the base, near each other
    rows = list(enumerate(out))
    rng.shuffle(rows)
    assert cases.ordered(map(tuple, setsketch_dedup.groups(cases.documents(spark, rows)).collect())) == pair_components(rows)


@pytest.mark.parametrize("shape", ["path", "stars", "random", "none"])
def test_contracted_components(spark, shape):
    rng = random.Random(6)
    if shape == "path":
        edges = [(i, i + 1) for i in range(60)] + [(300 - i, 299 - i) for i in range(40)]
    elif shape == "stars":
        edges = [(c, 1000 * c + i) for c in (7, 3, 5) for i in range(30)] + [(5007, 7000), (9, 9)]
    elif shape == "random":
        edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    else:
        edges = []

    def plain(edges):
        parent = {x: x for e in edges for x in e}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        return {x: find(x) for x in parent}

    df = spark.createDataFrame(edges, "a long, b long")
    got = contracted(df)
    assert {r.node: r.comp for r in got.collect()} == {x: c for x, c in plain(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
    more = [(rng.randrange(400), rng.randrange(400)) for _ in range(30)]
    both = {r.node: r.comp for r in joined_by(got, spark.createDataFrame(more, "a long, b long")).collect()}
    want = {x: c for x, c in plain(edges + more).items() if any(x in e and e[0] != e[1] for e in edges + more)}
    assert {x: c for x, c in both.items() if x in want} == want and all(c == x for x, c in both.items() if x not in want)


def test_groups_of_nothing(spark):
    assert setsketch_dedup.groups(cases.documents(spark, [])).collect() == []
    rows = [(1, None), (2, ""), (3, " ")]
    assert cases.ordered(map(tuple, setsketch_dedup.groups(cases.documents(spark, rows)).collect())) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    m = setsketch_dedup.ROWS * setsketch_dedup.BANDS
    value = textscan.mix(rng.integers(1, 1 << 62, 9000).astype(np.uint64))
    sets = [value[:4000], value[1000:5000], value[:5000], value[500:4500], value[:3], value[3:3]]
    table = setsketch_dedup.registers(np.concatenate(sets), np.array([len(s) for s in sets]), m)
    assert (np.maximum(table[0], table[1]) == table[2]).all() and not table[5].any()
    for a, b, similarity in ((0, 1, 0.6), (0, 3, 3500 / 4500), (0, 2, 0.8)):
        larger, smaller = (np.array([(x > y).sum()]) for x, y in ((table[a], table[b]), (table[b], table[a])))
        n_a, n_b = (np.array([float(len(sets[k]))]) for k in (a, b))
        grid = np.linspace(0, min(n_a[0], n_b[0]) / max(n_a[0], n_b[0]), 400)
        likely = [setsketch_dedup.likelihood(larger, smaller, m - larger - smaller, n_a, n_b, np.array([s]))[0] for s in grid]
        assert abs(grid[int(np.argmax(likely))] - similarity) < 0.07
        assert setsketch_dedup.plausible(larger, smaller, m, n_a, n_b, 80)[0] == (similarity > 0.7)


def jobs_of(spark, group, act):
    """What ``act`` returns, and how many jobs it ran."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        return act(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_sketch_is_merged_in_few_jobs(spark):
    """Not in a job for each shuffle partition, one after another."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    kind = sketch.Seen(16)
    keys = textscan.mix(np.arange(1, 3001, dtype=np.uint64))
    rows = spark.createDataFrame([(int(k),) for k in keys[:2000].view(np.int64)], "k bigint").repartition(5)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found, jobs = jobs_of(spark, "sketch", lambda: sketch.build(rows, lambda b: iter([b.column("k").to_numpy(zero_copy_only=False).view(np.uint64)]), kind))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    alone = kind.new()
    kind.add(alone, keys[:2000])
    assert (found == alone.reshape(2, -1)).all()
    assert kind.holds(found, keys[:2000]).all() and kind.holds(found, keys[2000:]).mean() < 0.05
    assert jobs <= 6


def test_estimate_of_a_crowded_leader_over_many_batches(spark, monkeypatch):
    """Every pair is judged beside its own leader, in parts and batches of any size."""
    monkeypatch.setattr(setsketch_dedup, "CHUNK", 7)
    rng, m = np.random.default_rng(3), 24
    n = rng.integers(40, 60, 80)
    value = textscan.mix(np.concatenate([np.concatenate([np.arange(1, k - 3), 10**6 * i + np.arange(4)]) for i, k in enumerate(n)]).astype(np.uint64))
    table = setsketch_dedup.registers(value, n, m)
    reps = spark.createDataFrame([(i, i + 100, i + 200, int(n[i]), bytes(table[i])) for i in range(80)], "sid bigint, k1 bigint, k2 bigint, n bigint, registers binary")
    pairs = sorted({(0, b) for b in range(1, 80)} | {(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2)) if a != b})
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "3")
    try:
        got = setsketch_dedup._estimated(spark.createDataFrame(pairs, "a bigint, b bigint"), reps, m, 80).collect()
    finally:
        spark.conf.set(size, before)
    a, b = np.array(pairs).T
    ok = setsketch_dedup.plausible((table[a] > table[b]).sum(axis=1), (table[a] < table[b]).sum(axis=1), m, n[a], n[b], 80)
    assert 0 < ok.sum() < len(pairs)
    assert {(r.a, r.sid) for r in got if r.role} == {p for p, good in zip(pairs, ok) if good}
    assert {(r.a, r.part) for r in got if r.role} == {(r.sid, r.part) for r in got if not r.role}
    assert all((r.k1, r.k2) == (r.sid + 100, r.sid + 200) for r in got)


def test_chance_of_no_common_band():
    assert setsketch_dedup.missed() < 1e-8


# --- 13 ------------------------------------------------------------------------


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_periodic(rows):
    out = []
    for doc, text in rows:
        w = cases.words(text)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return cases.ordered(out)


def repetitive_texts():
    rng = random.Random(11)
    out = ["a " * 5, "a " * 6, "a b " * 4, "a b " * 3 + "a", "x " + "a b c " * 5 + "a", "a a b " * 9, "ab ab ab ab abab " * 3]
    for _ in range(60):
        w = [rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            p = rng.randint(1, 50)
            root = [rng.choice("abcdefghijklmnop"[: rng.randint(1, 16)]) for _ in range(p)]
            at = rng.randint(0, len(w))
            w[at:at] = [root[i % p] for i in range(int(p * rng.uniform(3, 7)))]
        out.append(" ".join(w))
    return out


def test_runs_against_brute_force(spark):
    rows = [*enumerate(repetitive_texts()), *enumerate((t for t in cases.texts() if len(cases.words(t)) < 1000), 500), (None, "a b " * 20), (7, "a " * 9), (7, "a " * 9)]
    got = periodic_runs.periodic_runs(cases.documents(spark, rows), rewrite=periodic_runs.planted)
    assert cases.ordered(map(tuple, got.collect())) == brute_periodic(rows)
    assert periodic_runs.periodic_runs(cases.documents(spark, [])).collect() == []


def test_runs_themselves_are_given(spark):
    rows = [(1, "x a b a b a b a b y"), (2, None), (3, "l'a b")]
    got = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in periodic_runs.periodic_runs(cases.documents(spark, rows), with_text=True).collect()}
    assert got == {1: (["1,8,2"], "x a b y"), 2: ([], ""), 3: ([], "l'a b")}


def test_long_periods_of_long_texts():
    rng = np.random.default_rng(1)
    root = textscan.mix(rng.integers(0, 500, 20_011).astype(np.uint64))
    text = np.concatenate([textscan.mix(rng.integers(0, 500, 9000).astype(np.uint64)), np.tile(root, 5)[:90_000], textscan.mix(np.arange(10**6, 10**6 + 70, dtype=np.uint64))])
    runs = periodic_runs.find(text, np.zeros(len(text), dtype=np.int64))
    top = int(runs.length.argmax())
    assert (runs.period[top], runs.length[top]) == (20_011, 90_000) and runs.start[top] == 9000


def test_splitting_changes_no_result(monkeypatch):
    """Words set aside lie in no run, so ending early gives the same runs."""
    texts = repetitive_texts()
    text = next(textscan.slices(pa.array(texts)))
    w = textscan.words(text)
    hashes, row = textscan.span_hash(text.data, w.start, w.end), textscan.row_of(w.first)
    whole = periodic_runs.find(hashes, row)
    left = len(periodic_runs.segments(np.unique(hashes, return_inverse=True)[1], row)[0])
    monkeypatch.setattr(periodic_runs, "ROUNDS", 0)
    unsplit = periodic_runs.find(hashes, row)
    assert left < len(hashes) and all((a == b).all() for a, b in zip(whole, unsplit))


# --- queries --------------------------------------------------------------------


def test_queries_cover_their_tables(spark, sf_small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert cases.ordered(map(tuple, queries.op12_setsketch_dedup(spark, sf_small).collect())) == pair_components(docs)
    assert cases.ordered(map(tuple, queries.op11_spelling_groups(spark, sf_small).collect())) == spelling(docs)
    short = {i for i, t in docs if len(cases.words(t)) < 600}
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, sf_small).filter(F.col("doc_id").isin(list(short))).collect()]
    assert cases.ordered(got) == brute_periodic([r for r in docs if r[0] in short])


# --- 3: exact in very large sets --------------------------------------------------


@pytest.mark.parametrize("more, linked", [(375_002, True), (375_003, False)])
def test_block_links_are_exact_in_very_large_sets(more, linked):
    shared = np.arange(1_500_011, dtype=np.int64)
    larger = np.concatenate([shared, np.arange(10**7, 10**7 + more, dtype=np.int64)])
    a, b = jaccard_join.linked_in_block(np.array([1, 2]), np.concatenate([shared, larger]), np.array([len(shared), len(larger)]), 80)
    assert (100 * len(shared) >= 80 * len(larger)) == linked == (list(zip(a.tolist(), b.tolist())) == [(1, 2)])
