"""Connected components of an edge table, label by label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.stage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every end of ``edges`` (a, b); comp is the smallest node.

    Each round a node takes the smallest label around it, then its label's
    label. Rounds are written, which cuts the lineage; they end when the
    sum of the labels, which only fall, stays the same.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("comp"))
    total = None
    while True:
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        labels = materialize(labels.join(up, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "labels")
        now = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("low"))
        labels = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("comp", "low").alias("comp"))


def contracted(edges: DataFrame) -> DataFrame:
    """The same (node, comp), by contraction: each round every node goes to the
    local minimum that a chain of smallest neighbours leads to, and the edges
    between different minima are what the next round has left. Groups around
    one node vanish in the first round, and no round keeps more than half of
    the nodes, so the whole costs little more than its first round.
    """
    left = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("up")), "up")
        while True:
            onward = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            step = materialize(up.join(onward, "up").select("node", F.col("up").alias("was"), F.col("next").alias("up")), "up")
            up = step.select("node", "up")
            if step.filter("was <> up").isEmpty():
                break
        steps.append(up)
        of = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}"))  # noqa: B023,E731
        joined = left.join(of("a"), "a").join(of("b"), "b").filter("up_a <> up_b")
        left = materialize(joined.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    comps = steps[-1].withColumnRenamed("up", "comp")
    for up in reversed(steps[:-1]):
        comps = up.join(comps.withColumnRenamed("node", "up"), "up", "left").select("node", F.coalesce("comp", "up").alias("comp"))
    return materialize(comps, "components")


def joined_by(comps: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) once ``links`` (a, b) have joined components. Only the links
    between different components are worked on."""
    of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).filter("a <> b")
    across = contracted(ends)
    # ends that had no component yet are nodes of their own
    every = comps.unionByName(across.join(comps.select(F.col("comp").alias("node")).distinct(), "node", "left_anti").select("node", F.col("node").alias("comp")))
    found = every.join(across.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp", "left")
    return materialize(found.select("node", F.coalesce("root", "comp").alias("comp")), "components")
