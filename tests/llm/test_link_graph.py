"""Propagation over long chains, and host verdicts against plain iteration."""

import random
from collections import Counter, defaultdict

from loadlens.llm import url_filter as uf


def ranks(edges, seeds, hosts):
    """Personalised PageRank by plain iteration until nothing moves."""
    out = defaultdict(float)
    for a, b, n in edges:
        out[a] += n
    rank = dict(seeds)
    for _ in range(400):
        now = {h: 0.15 * seeds.get(h, 0.0) for h in hosts}
        for a, b, n in edges:
            now[b] += 0.85 * rank.get(a, 0.0) * n / out[a]
        rank = now
    return rank


def verdicts(pages, edges, least=uf.LEAST_DISTRUST):
    count = Counter(h for h, _ in pages)
    hosts = set(count) | {x for a, b, _ in edges for x in (a, b)}
    seeds = {}
    for kind in ("allow", "block"):
        of = Counter(h for h, v in pages if v == kind)
        of = {h: n for h, n in of.items() if 2 * n > count[h]}
        seeds[kind] = {h: n / sum(of.values()) for h, n in of.items()}
    trust = ranks(edges, seeds["allow"], hosts)
    distrust = ranks([(b, a, n) for a, b, n in edges], seeds["block"], hosts)
    return {h: distrust[h] > trust[h] and distrust[h] >= least / len(count) for h in count}


def judged(spark, pages, edges):
    p = spark.createDataFrame(pages, "host string, verdict string")
    e = spark.createDataFrame(edges, "src string, dst string, n long")
    return {r.host: r.blocked for r in uf.judge_hosts(p, e).collect()}


def test_host_verdicts_against_plain_iteration(spark):
    rnd = random.Random(8)
    hosts = [f"h{i}" for i in range(40)]
    pages = [(rnd.choice(hosts), rnd.choice([None, None, None, "allow", "block"])) for _ in range(300)]
    edges = [(a, b, rnd.randrange(1, 5)) for a in hosts for b in rnd.sample(hosts, 2) if a != b]
    got = judged(spark, pages, edges)
    assert got == verdicts(pages, edges) and 0 < sum(got.values()) < len(got)


def test_a_chain_of_sixty_hosts(spark):
    """Each host links to the next one, the last to a blocked one; distrust goes back through all of them."""
    chain = [f"c{i:02d}" for i in range(60)]
    edges = [(a, b, 1) for a, b in zip(chain, [*chain[1:], "bad"])]
    ranked = uf.propagate(
        spark.createDataFrame([("block", b, a, 1.0) for a, b, _ in edges], "kind string, src string, dst string, share double"),
        spark.createDataFrame([("block", "bad", 1.0)], "kind string, host string, mass double"),
    )
    got = {r.host: r["rank"] for r in ranked.collect()}
    assert set(got) == {*chain, "bad"}
    for i, h in enumerate(reversed(chain), 1):
        assert abs(got[h] - 0.15 * 0.85**i) < 1e-8
