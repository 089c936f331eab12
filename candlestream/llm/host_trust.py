"""URL rules, and trust and distrust spread over the host graph, on built-in functions only.

Rules decide the pages they fit. Hosts of pages that rules allow are trusted seeds, hosts of pages
that rules block are distrusted ones. Trust is personalised PageRank along the links from host to
host, distrust the same against their direction; a host with more than `threshold` of its score
from distrust is blocked.

Defined cases: a NULL url, or one without `://`, has an empty host and path; no rule fits it and it
takes the verdict of a host without links. A host that neither score reaches is allowed. Equal
links count as often as they occur; links from a host to itself carry nothing. Repeated pages are
judged alike, an empty table gives an empty result, and only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.session import materialize

ALLOW, BLOCK = "allow", "block"

DAMPING = 0.85
TOLERANCE = 1e-9

# Hosts whose scores are sent to all executors; more are joined by shuffle.
BROADCAST_HOSTS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANCHOR = r"""(?i)href\s{0,9}=\s{0,9}["']?((?:https?:)?//[^"'\s<>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """`target` is a host and the start of a path, such as `example.org/es/`."""

    verdict: str
    target: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.target.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


# The rules of the `pages` table.
RULES = (
    UrlRule(ALLOW, "org/"),
    UrlRule(BLOCK, "example.org/es/"),
    UrlRule(BLOCK, "example.org/en/1"),
    UrlRule(ALLOW, "com/fr/"),
    UrlRule(BLOCK, "com/de/"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def by_rule(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url") -> DataFrame:
    """`pages` with host, path, the longest rule that fits, and that rule's verdict."""
    own = ("host", "path", "rule", "rule_verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in own]
    parts = pages.select(
        *kept, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.target)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.target).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return parts.withColumns({"rule": rule, "rule_verdict": verdict})


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between different hosts: src, dst and how many there are."""
    target = F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(ANCHOR), 1))
    found = pages.select(host_of(F.col(f"`{url}`")).alias("src"), target.alias("to"))
    dst = F.translate(F.regexp_extract("to", "//([^/?#]*)", 1), UPPER, LOWER)
    return (
        found.select("src", dst.alias("dst")).filter("src != '' AND dst != '' AND src != dst")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING,
           tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank: (host, score) from `seeds` (host, weight) along `links`.

    Rounds go on until the scores change by less than `tolerance` in all, about 130 at 1e-9, and no
    new host is reached. They end: a round's change is at most `damping` times the one before, and
    there are as many hosts as links allow.

    The score of a host without links ends there instead of returning to the seeds; that scales
    all scores by one factor, and they are scaled to a sum of one at the end.
    """
    if not 0 <= damping < 1:
        raise ValueError(f"damping of {damping} never settles")
    total = seeds.agg(F.sum("weight")).first()[0] or 0.0
    if total == 0:
        return seeds.select("host", F.lit(0.0).alias("score"))
    start = seeds.select("host", (F.col("weight") / total).alias("score"))
    out = links.groupBy("src").agg(F.sum("n").alias("all_n"))
    shares, edges = materialize(
        links.join(out, "src").select("src", "dst", (F.col("n") / F.col("all_n")).alias("share")),
        "links",
    )
    start, reached = materialize(start, "seeds")
    scores = start
    while edges:
        moved = shares.join(scores, shares["src"] == scores["host"]).select(
            F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("part")
        )
        restart = start.select("host", (F.col("score") * (1 - damping)).alias("part"))
        following = moved.union(restart).groupBy("host").agg(F.sum("part").alias("score"))
        following, hosts = materialize(following, "scores")
        change = following.withColumnRenamed("score", "new").join(scores, "host", "full").agg(
            F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("score", F.lit(0.0))))
        ).first()[0]
        settled = change < tolerance and hosts == reached
        scores, reached = following, hosts
        if settled:
            break
    mass = scores.agg(F.sum("score")).first()[0]
    return scores.select("host", (F.col("score") / mass).alias("score"))


def host_scores(judged: DataFrame, links: DataFrame) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches; `judged` comes from `by_rule`."""
    votes, _ = materialize(
        judged.filter("rule_verdict IS NOT NULL AND host != ''").groupBy("host").agg(
            F.count_if(F.col("rule_verdict") == ALLOW).cast("double").alias("allowed"),
            F.count_if(F.col("rule_verdict") == BLOCK).cast("double").alias("blocked"),
        ), "votes",
    )
    backwards = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")

    def seeds(votes_for: str) -> DataFrame:
        return votes.filter(F.col(votes_for) > 0).select("host", F.col(votes_for).alias("weight"))

    trust = spread(links, seeds("allowed")).withColumnRenamed("score", "trust")
    distrust = spread(backwards, seeds("blocked")).withColumnRenamed("score", "distrust")
    return trust.join(distrust, "host", "full").na.fill(0.0, ["trust", "distrust"])


def judge(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url", html: str = "html",
    threshold: float = 0.5, broadcast_hosts: int = BROADCAST_HOSTS,
) -> DataFrame:
    """`pages` with host, path, rule, verdict, and the host's trust and distrust."""
    own = ("host", "path", "rule", "verdict", "trust", "distrust", "rule_verdict")
    kept = [c for c in pages.columns if c not in own]
    judged = by_rule(pages, rules, url)
    links, _ = materialize(host_links(pages, url, html), "links")
    scores, hosts = materialize(host_scores(judged, links), "hosts")
    if hosts <= broadcast_hosts:
        scores = F.broadcast(scores)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    by_host = F.when(share > threshold, BLOCK).otherwise(ALLOW)
    return judged.join(scores, "host", "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", "rule",
        F.coalesce("rule_verdict", by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
