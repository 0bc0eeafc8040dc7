"""Link farms under the production threshold, whatever their size."""

import random

import numpy as np
import pytest

from revlens.llm import url_trust
from revlens.llm.queries import URL_RULES


def verdicts(spark, links):
    """Verdicts by host for pages of (host, hosts it links to); bad.net is blocked, good.com allowed."""
    pages = [(f"http://{h}/es/", "".join(f"<a href='http://{t}/'>" for t in to)) for h, to in [("bad.net", []), ("good.com", []), *links]]
    table = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    return {r.host: r for r in url_trust.judge(table, URL_RULES).collect()}


@pytest.mark.parametrize("size", [1, 2, 10])
def test_a_farm_is_blocked_whole_at_any_size(spark, size):
    got = verdicts(spark, [(f"f{k}.org", ["bad.net"]) for k in range(size)])
    assert {got[f"f{k}.org"].verdict for k in range(size)} == {"block"}


def test_a_linker_that_is_linked_to_is_blocked(spark):
    got = verdicts(spark, [("f.org", ["bad.net"]), ("g.org", ["f.org"]), ("ring1.org", ["ring2.org", "bad.net", "bad.net"]), ("ring2.org", ["ring1.org", "bad.net"])])
    assert all(got[h].verdict == "block" for h in ("f.org", "g.org", "ring1.org", "ring2.org"))
    assert (got["f.org"].suspicion, got["g.org"].suspicion) == pytest.approx((0.85, 0.85))


def test_one_bad_link_among_many_blocks_nobody(spark):
    got = verdicts(spark, [("dir.org", ["bad.net", *(f"n{k}.org" for k in range(9))]), ("half.org", ["bad.net", "good.com"]), ("fan.org", ["good.com"])])
    assert {got[h].verdict for h in ("dir.org", "half.org", "fan.org", "good.com")} == {"allow"}


def test_credit_outweighs_suspicion(spark):
    got = verdicts(spark, [("good2.com", ["liked.org"]), ("liked.org", ["bad.net"]), ("bare.org", ["bad.net"])])
    assert got["liked.org"].credit == pytest.approx(0.85) and got["liked.org"].verdict == "allow" and got["bare.org"].verdict == "block"


def walk(hosts, links, seeds, back, damping=url_trust.DAMPING):
    """Dense PageRank from ``seeds``, run until it stands still."""
    n, at = len(hosts), {h: k for k, h in enumerate(hosts)}
    move = np.zeros((n, n))
    for a, b in links:
        a, b = (b, a) if back else (a, b)
        move[at[b], at[a]] += 1
    for k in range(n):
        if not move[:, k].sum():
            move[k, k] = 1
    move /= move.sum(axis=0)
    seed = np.array([seeds.get(h, 0.0) for h in hosts])
    return np.linalg.solve(np.eye(n) - damping * move, (1 - damping) * seed)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_verdicts_equal_dense_pagerank_under_production_parameters(spark, seed):
    rng = random.Random(seed)
    names = [f"h{k}.org" for k in range(40)] + ["a.net", "b.net", "e.net", "f.net", "g.net", "c.com", "d.com"]
    out = {h: [t for t in rng.sample(names, rng.randint(0, 4)) if t != h] for h in names if rng.random() < 0.8}
    pages = [(f"http://{h}/es/", "".join(f"<a href='http://{t}/'>" for t in out.get(h, []))) for h in names]
    table = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.host: r for r in url_trust.judge(table, URL_RULES).collect()}
    links = [(h, t) for h, ts in out.items() for t in ts]
    trust, distrust = {h: float(h.endswith(".com")) for h in names}, {h: float(h.endswith(".net")) for h in names}
    ruled = {h for h in names if trust[h] or distrust[h]}
    along = {h: 1.0 for h in names if h in ruled or h not in {b for _, b in links}}
    against = {h: 1.0 for h in names if h in ruled or h not in {a for a, _ in links}}
    scores = [walk(names, links, s, back) for s, back in ((trust, False), (along, False), (distrust, True), (against, True))]
    for k, h in enumerate(names):
        t, a, d, g = (x[k] for x in scores)
        credit = max(trust[h], url_trust.DAMPING * t / a if a else 0)
        suspicion = max(distrust[h], url_trust.DAMPING * d / g if g else 0)
        assert (got[h].credit, got[h].suspicion) == pytest.approx((credit, suspicion), abs=2e-6)
        if h not in ruled and abs(suspicion - url_trust.THRESHOLD) > 1e-5 and abs(suspicion - credit) > 1e-5:
            bad = suspicion >= url_trust.THRESHOLD and suspicion > credit
            assert got[h].verdict == ("block" if bad else "allow")
