"""URL filter: rules first, then trust and distrust along host links.

A url's host and path are matched against allow and block rules; the
longest rule that fits decides. For the rest, each host is scored on the
graph of links between hosts: personalised PageRank from the hosts that
rules allow, along links, and from the hosts that rules block, against
them (who links to a bad host is suspect). A host's seed is the share of
its pages that a rule allows or blocks; it counts for no less than that,
whatever it passes on.

These scores are split among receivers, so their size falls with the
number of hosts that link to one place. What tells a host is the share of
the walk's mass there that came from such seeds: both walks are also run
from all their ends (hosts with a rule, and hosts that no link leaves or
none enters, where a walk of surfers begins), over the same links. A host's
suspicion is its seed, or the damped share of distrust in the second walk
against links, if more; its credit is the same of trust along links. A
host that leads nowhere but to blocked ones has a share of 1, at one linker
or a million, directly or over others. Hosts whose suspicion reaches
``threshold`` and exceeds their credit are blocked.

All steps are DataFrame functions. Links are counted by pair of hosts in
the map tasks, so the graph has a row for each linked pair, however many
pages a host has; every few rounds the scores are written, which cuts the
lineage, and the rounds end once they stand still to ``TOLERANCE`` (what is
left of a change falls by the damping each round). A host without links
(links within a host count for nothing) keeps its seed.

Cases: a null url, or one without ``://``, has empty host and path; it
fits no rule and its host is scored like any other; repeated rows are
judged alike, though each counts as a page; a null html has no links;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.sources.stage import materialize

DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 1e-9
ROUNDS_A_WRITE = 4
# Walks: along links from trusted hosts and from all ends, against them from distrusted ones and from all ends.
WALKS = ("trust", "distrust", "along", "against")
KINDS = ("trust", "distrust", "credit", "suspicion")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


class Rule(NamedTuple):
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits ``host`` and ``path``, else null."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")) & F.col("path").startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))) if out is None else out.when(fits, F.lit(value(rule)))
    return F.lit(None) if out is None else out


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst, links) between different hosts."""
    found = pages.select(host_of(url_col).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), 1)).alias("dst"))
    found = found.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst"))
    return found.filter("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def _flows(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """(back, src, dst, share): where a host's score goes, along links or back
    against them, divided among the receivers; it stays where nothing leaves."""
    along = links.select(F.lit(False).alias("back"), "src", "dst", "links")
    against = links.select(F.lit(True).alias("back"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    both = along.unionByName(against)
    out = both.groupBy("back", "src").agg(F.sum("links").alias("total"))
    shared = both.join(out, ["back", "src"]).select("back", "src", "dst", (F.col("links") / F.col("total")).alias("share"))
    every = hosts.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("back"), F.col("host").alias("src"))
    still = every.join(out, ["back", "src"], "left_anti").select("back", "src", F.col("src").alias("dst"), F.lit(1.0).alias("share"))
    return shared.unionByName(still)


def propagate(links: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust, along, against) from (src, dst, links) and (host, trust, distrust) seeds."""
    if rounds is None:
        rounds = ceil(log(TOLERANCE) / log(damping))
    ends = links.select(F.col("src").alias("host"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(links.select(F.col("dst").alias("host"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    degree = ends.groupBy("host").agg(F.max("out").alias("out"), F.max("into").alias("into"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    given = degree.join(seeds, "host", "full").select("host", zero("trust").alias("trust"), zero("distrust").alias("distrust"), zero("out").alias("out"), zero("into").alias("into"))
    ruled = (F.col("trust") > 0) | (F.col("distrust") > 0)
    hosts = materialize(
        given.select("host", "trust", "distrust", (ruled | (F.col("into") == 0)).cast("double").alias("along"), (ruled | (F.col("out") == 0)).cast("double").alias("against")), "hosts"
    )
    flows = materialize(_flows(links, hosts), "flows")
    seeded = F.map_from_arrays(F.array(*(F.lit(k) for k in WALKS)), F.array(*WALKS))
    back = F.col("kind").isin("distrust", "against").alias("back")
    start = hosts.select("host", F.explode(seeded).alias("kind", "score")).select("host", "kind", back, "score")
    scores = start
    for at in range(0, rounds, ROUNDS_A_WRITE):
        before = scores
        for _ in range(ROUNDS_A_WRITE):
            moved = flows.join(scores.withColumnRenamed("host", "src"), ["back", "src"]).select(
                F.col("dst").alias("host"), "kind", "back", (damping * F.col("share") * F.col("score")).alias("score")
            )
            kept = start.select("host", "kind", "back", ((1 - damping) * F.col("score")).alias("score"))
            scores = moved.unionByName(kept).groupBy("host", "kind", "back").agg(F.sum("score").alias("score"))
        scores = materialize(scores, f"scores-{at}")
        change = scores.join(before.withColumnRenamed("score", "was"), ["host", "kind"]).agg(F.max(F.abs(F.col("score") - F.col("was")))).first()[0]
        if change is None or change < TOLERANCE:
            break
    return scores.groupBy("host").agg(*(F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k) for k in WALKS))


def weigh(scores: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, credit, suspicion): scores no less than a host's
    own seeds, and the damped shares of the walks, to six places."""
    own = seeds.select("host", F.col("trust").alias("own_trust"), F.col("distrust").alias("own_distrust"))
    share = lambda part, whole: damping * F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0.0)), F.lit(0.0))
    found = scores.join(own, "host", "left")
    at_least = lambda value, c: F.round(F.greatest(value, F.coalesce(f"own_{c}", F.lit(0.0))), 6)
    return found.select(
        "host", at_least(F.col("trust"), "trust").alias("trust"), at_least(F.col("distrust"), "distrust").alias("distrust"),
        at_least(share("trust", "along"), "trust").alias("credit"), at_least(share("distrust", "against"), "distrust").alias("suspicion"),
    )


def judge(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust, credit, suspicion) for every page."""
    urls = pages.select(F.col(id_col).alias("_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    ruled = urls.withColumn("rule", longest_rule(rules, lambda r: r.name).cast("string")).withColumn("ruled", longest_rule(rules, lambda r: "allow" if r.allow else "block").cast("string"))
    shares = {"trust": "allow", "distrust": "block"}
    seeds = materialize(ruled.groupBy("host").agg(*(F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0)).alias(c) for c, v in shares.items())), "seeds")
    links = materialize(host_links(pages, url_col, html_col), "links")
    scores = materialize(weigh(propagate(links, seeds), seeds), "hosts")
    bad = (F.col("suspicion") >= threshold) & (F.col("suspicion") > F.col("credit"))
    return ruled.join(scores, "host", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce(F.col("ruled"), F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), *KINDS,
    )
