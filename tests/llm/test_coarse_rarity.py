"""The Jaccard join where the rarity sketch is too coarse for the text."""

import random

import numpy as np
import pytest

from revlens.llm import jaccard_join, sketch, textscan

WORDS, PERCENT = jaccard_join.WORDS, jaccard_join.PERCENT


def _texts(seed: int = 5) -> list[str]:
    """Texts of own words, each with some of a few common lines; some are near copies."""
    rng = random.Random(seed)
    lines = [" ".join(f"line{k}w{i}" for i in range(7)) for k in range(12)]
    out = []
    for d in range(160):
        own = [f"d{d}w{i}" for i in range(60)]
        out.append(" ".join(own + [x for k in sorted(rng.sample(range(12), 4)) for x in lines[k].split()]))
        if d % 16 == 0:
            out.append(out[-1] + f" tail{d}")
    return out


def _shingles(text: str) -> set:
    w = text.split()
    return {tuple(w[i : i + WORDS]) for i in range(len(w) - WORDS + 1)}


def _brute(texts: list[str]) -> dict[int, int]:
    sets = [_shingles(t) for t in texts]
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= PERCENT * (len(sets[i]) + len(sets[j]) - both) and comp[i] != comp[j]:
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    return dict(enumerate(comp))


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(_texts())), "doc_id bigint, text string").repartition(3)


def test_common_shingles_do_not_chain_unlike_sets_into_one_group(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 16)
    source = docs.selectExpr("doc_id AS _id", "text AS _text")
    order = sketch.Levels(6)  # 64 cells for some 13,000 shingles: every cell is as full as the next

    def keys_of(batch):
        for text in textscan.slices(batch.column("_text")):
            yield jaccard_join.shingles(text, WORDS)[0]

    rarity = spark.sparkContext.broadcast(sketch.build(source.select("_text"), keys_of, order))
    rows, classes, boundary, found, stars = jaccard_join._listed(source, order, rarity, WORDS, PERCENT)
    sets = classes.count()
    assert rows.count() == sets == 170
    assert jaccard_join._copies(stars, 0) <= sets
    # the lists of the sketch alone make one group of nearly all sets, each copied into many blocks
    first = jaccard_join._sets(source, order, rarity, WORDS, PERCENT)
    first = jaccard_join.materialize(jaccard_join.with_uid(first), "sets").withColumnRenamed("uid", "sid")
    alone = jaccard_join._lists(first, boundary, PERCENT).filter("b is null").select("e", "a")
    assert jaccard_join._copies(jaccard_join._stars(alone), 0) > 4 * sets


def test_a_coarse_sketch_gives_the_same_groups(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 16)
    want = _brute(_texts())
    assert sum(k != v for k, v in want.items()) == 10
    for bits in ((6, 6), jaccard_join.LEVEL_BITS):
        got = {r.doc_id: r.component_id for r in jaccard_join.link(docs, level_bits=bits).collect()}
        assert got == want


def test_blocks_are_bounded_by_their_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", 1_000)
    pairs = spark.createDataFrame([(0, k) for k in range(1, 40)], "a bigint, b bigint")
    sizes = spark.createDataFrame([(k, 300) for k in range(40)], "sid bigint, n int")
    stars = spark.createDataFrame([(k, 0) for k in range(1, 40)], "a bigint, b bigint")
    blocks = jaccard_join._blocks(pairs, stars, sizes).groupBy("comp", "x", "y").count().collect()
    assert max(b["count"] for b in blocks) * 300 < 40 * 300 / 2  # of 12 chunks two meet, not all
    met = {}
    for r in jaccard_join._blocks(pairs, stars, sizes).collect():
        met.setdefault((r.x, r.y), set()).add(r.sid)
    seen = np.zeros((40, 40), dtype=bool)
    for sids in met.values():
        seen[np.ix_(list(sids), list(sids))] = True
    assert seen.all()  # every two sets meet in some block
