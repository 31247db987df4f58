"""URL filter: rules first, then what the link graph says of a host.

Hosts that the rules mostly allow are trusted seeds, hosts that they mostly block are blocked seeds. Trust is
a personalised PageRank from the trusted seeds along links; distrust is one from the blocked seeds against
them, since who links to bad hosts is suspect. A host with more distrust than trust, beyond a threshold, is
blocked. Links are summed to host edges before the iteration, so it works on hosts, not on pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: (host, path, verdict): fits the host and all hosts below it, for paths that start with the path.
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
DAMPING = 0.85
#: Propagation ends when all ranks together change by less than this part of the least distrust that counts.
PRECISION = 1e-3
#: Or by what sums of doubles cannot tell.
ROUNDING = 1e-14
#: Distrust counts from this many times the even share, 1 / hosts.
LEAST_DISTRUST = 0.1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) from rows of (host, html): absolute links to other hosts."""
    links = F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK)), lambda h: F.translate(h, _UPPER, _LOWER)
    )
    rows = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst"))
    return rows.filter("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int | None = None, tolerance: float = 1e-9
) -> DataFrame:
    """(kind, host, rank) from edges (kind, src, dst, share) and seeds (kind, host, mass).

    Masses of a kind and shares of a source sum to 1. What a host without links out holds goes nowhere. Steps go on
    until the ranks of a kind change by less than the tolerance together (or for the steps given): a step changes them
    by at most damping times the step before, so it ends, and a host any number of links away gets what reaches it.
    """
    seeds = stored(seeds, "seeds")
    ranks, step = seeds.withColumnRenamed("mass", "rank"), 0
    while steps is None or step < steps:
        moved = ranks.withColumnRenamed("host", "src").join(edges, ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg(
            (damping * F.sum(F.col("rank") * F.col("share"))).alias("rank")
        )
        given = seeds.select("kind", "host", ((1 - damping) * F.col("mass")).alias("rank"))
        now = stored(moved.unionByName(given).groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "ranks")
        both = now.unionByName(ranks.select("kind", "host", (-F.col("rank")).alias("rank")))
        change = both.groupBy("kind", "host").agg(F.sum("rank").alias("d")).agg(F.sum(F.abs("d"))).first()[0]
        ranks, step = now, step + 1
        if change is None or change < max(tolerance, ROUNDING):
            break
    return ranks


def judge_hosts(judged: DataFrame, edges: DataFrame, least: float = LEAST_DISTRUST) -> DataFrame:
    """(host, trust, distrust, blocked) from pages (host, verdict by rule or null) and host edges.

    A host is a trusted seed if rules allow more than half of its pages, a blocked seed if they block more than
    half; its part of the seeds is its part of such pages.
    """
    counts = judged.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allow"),
        F.count_if(F.col("verdict") == "block").alias("block"),
    )
    counts, edges = stored(counts, "hosts"), stored(edges, "edges")
    of = lambda kind: counts.filter(F.col(kind) * 2 > F.col("pages")).select(
        F.lit(kind).alias("kind"), "host", F.col(kind).cast("double").alias("mass")
    )
    seeds = of("allow").unionByName(of("block"))
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))
    seeds = seeds.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("mass"))
    directed = edges.select(F.lit("allow").alias("kind"), "src", "dst", "n").unionByName(
        edges.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = directed.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    directed = stored(
        directed.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all")).alias("share")), "shares"
    )
    even = 1 / max(counts.count(), 1)
    ranks = propagate(directed, seeds, tolerance=PRECISION * least * even)
    rank = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    ranks = ranks.groupBy("host").agg(rank("allow").alias("trust"), rank("block").alias("distrust"))
    ranks = counts.select("host").join(ranks, "host", "left").fillna(0.0, ["trust", "distrust"])
    return ranks.withColumn("blocked", (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least * even))


def filter_urls(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, least: float = LEAST_DISTRUST
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block).

    The rule's verdict holds where one fits; else a page is blocked if its host is, and allowed otherwise. A null url
    or one without :// has an empty host and path, fits no rule and is allowed; null html has no links. Pages that
    repeat count each time. Other columns are not read. A table without rows gives none.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    hosts = judge_hosts(judged, host_edges(rows), least).filter("blocked").select(F.col("host").alias("bad"), "blocked")
    found = judged.join(hosts, (F.col("host") == F.col("bad")) & F.col("rule").isNull(), "left")
    by_graph = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_graph).alias("verdict"))
