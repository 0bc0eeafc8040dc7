"""Shards, top-k search, url trust, toxicity: against brute force; the pipeline on small tables."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import branch_bound_topk, kd_shards, toxicity_chain, url_trust
from tests.llm import cases

# --- 1 -------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards(spark, shards):
    got = kd_shards.shard(cases.documents(spark), ["uid", "doc_id"], shards=shards).collect()
    assert cases.ordered((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in got) == cases.ordered(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", None) for i, t in cases.plain(spark)
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))


def test_shards_are_even_with_one_hot_value_and_equal_rows(spark):
    rows = [(k if k % 3 else 7, "equal text" if k % 3 == 0 else "t" * (k % 50)) for k in range(3000)]
    got = kd_shards.shard(cases.documents(spark, rows), ["uid", "doc_id"], shards=7)
    sizes = [r["s"] for r in got.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 2 * (50 + 16)


def test_shards_by_target_bytes_and_of_an_empty_table(spark):
    rows = [(k, "x" * 84) for k in range(100)]
    assert kd_shards.shard(cases.documents(spark, rows), ["doc_id"], target_bytes=1000).agg(F.countDistinct("shard")).first()[0] == 10
    assert kd_shards.shard(cases.documents(spark, []), ["doc_id"], shards=4).collect() == []


# --- 7 -------------------------------------------------------------------------


def brute_top(rows, k, every, scale=64):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for p, (i, v) in enumerate(usable):
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, u)), j) for q, (j, u) in enumerate(usable) if q != p)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return cases.ordered(out)


@pytest.mark.parametrize("dims,k", [(64, 20), (5, 3)])
def test_top_k(spark, monkeypatch, dims, k):
    monkeypatch.setattr(branch_bound_topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(branch_bound_topk, "_CHUNK", 16)
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(300, dims)) * np.exp(-np.arange(dims) / 6)).astype(np.float32).astype(float)
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (402, None), (403, []), (404, [1.0, None]), (405, [float("nan")] * dims), (406, [float("inf")] * dims), (None, rows[1][1]), (420, rows[2][1]), (420, rows[2][1])]
    df = spark.createDataFrame([(i, v, "?", "?") for i, v in rows], "vec_id long, embedding array<double>, id string, score string").repartition(3)
    got = branch_bound_topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect()
    assert cases.ordered(tuple(r) for r in got) == brute_top(rows, k, 20)


def test_top_k_fewer_rows_large_values_and_an_empty_table(spark):
    rows = [(0, [1e6, -2e6]), (1, [3e6, 1.0]), (2, [0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert cases.ordered(tuple(r) for r in branch_bound_topk.top_k(df, F.col("vec_id") % 20 == 0).collect()) == brute_top(rows, 20, 20)
    assert branch_bound_topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


# --- 8 -------------------------------------------------------------------------

RULES = [
    url_trust.Rule(True, "com", "/"), url_trust.Rule(False, "example.com", "/en/"), url_trust.Rule(True, "www.example.com", "/en/"),
    url_trust.Rule(False, "net", "/es/"),
]


def brute_trust(links, seeds, damping=0.85, rounds=400):
    """Dense iteration over all hosts."""
    hosts = sorted({h for e in links for h in e} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    out = {}
    for k, kind in enumerate(("trust", "distrust")):
        m = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in links.items():
            a, b = (a, b) if kind == "trust" else (b, a)
            m[at[a], at[b]] += n
        total = m.sum(axis=1)
        m = np.where(total[:, None] > 0, m / np.maximum(total, 1)[:, None], np.eye(len(hosts)))
        seed = np.array([seeds.get(h, (0, 0))[k] for h in hosts], dtype=float)
        r = seed
        for _ in range(rounds):
            r = (1 - damping) * seed + damping * r @ m
        out[kind] = r
    return {h: (out["trust"][i], out["distrust"][i]) for h, i in at.items()}


def test_trust_flows_along_links_and_distrust_against_them(spark):
    links = {("good", "a"): 3, ("a", "b"): 1, ("a", "bad"): 1, ("c", "bad"): 5, ("bad", "b"): 2, ("x", "y"): 1}
    seeds = {"good": (1.0, 0.0), "bad": (0.0, 1.0), "alone": (0.0, 0.4)}
    got = url_trust.propagate(
        spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, links long"),
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"), rounds=80,
    ).collect()
    expected = brute_trust(links, seeds)
    assert {r.host for r in got} == set(expected)
    for r in got:
        assert (r.trust, r.distrust) == pytest.approx(expected[r.host], abs=1e-5)


def test_rules_hosts_and_paths(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://example.com", "http://x.net/es/1", "http://xnet/es/1",
        "http://notexample.com/en/", "ftp://h?x/en/", "http://a://b/c", "http://x.net/es/1",
    ]
    pages = spark.createDataFrame([(k, u, None, "?", "?") for k, u in enumerate(urls)], "page_id long, url string, html string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trust.judge(pages, RULES).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[4] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[5] == ("example.com", "", None, "allow")
    assert got[6] == got[11] == ("x.net", "/es/1", "net/es/", "block")
    assert got[7] == ("xnet", "/es/1", None, "allow")
    assert got[8] == ("notexample.com", "/en/", "com/", "allow")
    assert got[9] == ("h", "", None, "allow") and got[10][:2] == ("a:", "//b/c")


def test_hosts_are_blocked_through_the_graph(spark):
    pages = [(1, "http://bad.net/es/1", ""), (2, "http://bad.net/x", ""), (3, "http://bad.net/es/2", "")]
    pages += [(4, "http://farm.org/1", '<a href="http://bad.net/x">'), (5, "http://farm.org/2", "<a HREF='//BAD.net/y'>"), (6, "http://ok.org/", '<a href="/local">')]
    got = {r.page_id: r for r in url_trust.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES, threshold=0.3).collect()}
    assert [got[k].verdict for k in (1, 2, 3, 4, 5, 6)] == ["block", "block", "block", "block", "block", "allow"]
    assert url_trust.judge(spark.createDataFrame([], "page_id long, url string, html string"), RULES).collect() == []


def test_the_main_path_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", "")], "page_id long, url string, html string")
    plan = url_trust.judge(pages, RULES)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- 9 -------------------------------------------------------------------------


def _toxic_table(spark, n=600):
    rng = np.random.default_rng(2)
    insults, word = ["oaf", "dolt", "churl"], lambda: "".join(rng.choice(list("abcdefgh"), 3))
    rows, labels = [], []
    for k in range(n):
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        w = [word() for _ in range(rng.integers(5, 80))]
        for _ in range(3 * toxic):
            w[rng.integers(len(w))] = str(rng.choice(insults))
        if toxic:
            w.append("nincom" + word())
        if junk:
            w.append("buy")
        rows.append((k, " ".join(w)))
        labels.append((k, int(not junk), int(toxic)))
    return rows, cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1", "both": "quality = 0 and toxic = 1"}


def test_chain_on_held_out_rows(spark):
    _, docs, labels = _toxic_table(spark)
    chain = toxicity_chain.fit(docs, labels.filter("doc_id % 2 = 0"), CATEGORIES)
    assert [len(m.before) for m in chain.models] == [0, 1, 2]
    found = toxicity_chain.with_probabilities(docs, chain)
    rows = found.select("row.doc_id", "found.*").join(labels, "doc_id").filter("doc_id % 2 = 1").collect()
    for name, truth in (("toxic", lambda r: r.toxic_y), ("junk", lambda r: 1 - r.quality), ("both", lambda r: r.toxic_y * (1 - r.quality))):
        rows_ = [(r[name], truth(_Row(r))) for r in rows]
        assert np.mean([(p >= 0.5) == bool(t) for p, t in rows_]) > 0.95, name
    # the last category's model leans on the earlier ones' probabilities
    assert np.abs(chain.models[2].before).max() > 0.1


class _Row:
    """Both columns named toxic: the probability and, last, the label."""

    def __init__(self, row):
        self.quality, self.toxic_y = row["quality"], row[len(row) - 1]


def test_chain_cases(spark):
    rows, docs, labels = _toxic_table(spark, 100)
    chain = toxicity_chain.fit(docs, labels, CATEGORIES)
    edge = cases.documents(spark)
    found = toxicity_chain.with_probabilities(edge, chain)
    assert found.select("row.*").columns == edge.columns and found.count() == edge.count()
    assert found.filter("isnull(found.toxic) or isnan(found.toxic)").count() == 0
    same = found.filter("row.doc_id = 200").select("found.*").distinct().count()
    assert same == 1
    for part, value in ((labels.limit(0), 0.0), (labels.withColumn("toxic", F.lit(1)), 1.0)):
        only = toxicity_chain.fit(docs, part, CATEGORIES)
        p = [r[0] for r in toxicity_chain.with_probabilities(edge, only).select("found.toxic").collect()]
        assert np.allclose(p, value, atol=1e-6)
    assert toxicity_chain.with_probabilities(cases.documents(spark, []), chain).collect() == []


# --- pipeline --------------------------------------------------------------------


def test_pipeline_stages_on_edge_rows(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(150), prose(60)
    texts = {k: prose(80) for k in range(60)}
    texts |= {k: prose(60).replace(" ", "*** ") for k in range(60, 80)}
    texts |= {k: prose(50) + " oaf dolt churl " + prose(9) for k in range(80, 110)}
    texts |= {110: base, 111: base, 112: base + " end", 113: None, 114: "", 115: "too short"}
    texts |= {116 + k: f"{prose(40)} {passage} {prose(40)}" for k in range(3)}
    rows = [(k, t, "en", "s", len(t or "")) for k, t in texts.items()] + [(None, prose(70), None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 0 if 60 <= k < 80 else 1, int(80 <= k < 110)) for k in range(110)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    docs, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(60)) | {None, 116, 117, 118}
    assert ids[0] == clean | set(range(80, 113))
    assert ids[1] == clean | {110, 111, 112}
    assert ids[2] == ids[3] == clean | {110}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == ids[3] and all(r.offset + r.length <= 2048 for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
