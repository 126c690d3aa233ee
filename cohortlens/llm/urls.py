"""URL filter: rules on host and path first, then trust and distrust that spread over the link graph of hosts.

Hosts are nodes, links between their pages (of anchors) weighted edges. A host's seed of trust is the share of its urls
under allow rules, its seed of distrust that under block rules; a host without pages of its own is judged by the urls
that others link to. Personalised PageRank carries trust along the links. Distrust goes against them, a link's share of it
being its share of the linking host's links: a host's distrust is the damped chance that following links from it leads to
blocked urls, however many pages it has and however many others link there. A host is blocked if its distrust exceeds both
its trust and ``margin``; the urls that no rule fits get their host's verdict.

Defined cases: a url that is null or without "://" has an empty host and path and is allowed; null html has no links;
repeated rows count as pages each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, settle

LINK = r"(?i)<a\s[^>]*?\bhref\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s<>]+)"
ROUNDS, DAMPING, MARGIN = 8, 0.85, 0.4
PLACES = 9  # to which scores are compared, as sums in another order differ behind them


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first "://" up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules``: (verdict, host/path)."""
    name = verdict = None
    for says, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, folder = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + folder)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def spread(edges: DataFrame, hosts: DataFrame, seed: str, onto: str, by: str, rounds: int, damping: float) -> DataFrame:
    """(host, score): each round the ``seed`` and the damped shares of the scores at the other ends of the ``edges`` (src, dst, share)."""
    now = hosts.select("host", F.col(seed).alias("seed"), F.col(seed).alias("score"))
    for i in range(rounds):
        sent = edges.join(now.select(F.col("host").alias(by), "score"), by).groupBy(F.col(onto).alias("onto")).agg(F.sum(F.col("score") * F.col("share")).alias("got"))
        now = now.join(sent, now.host == sent.onto, "left").select("host", "seed", (F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("score"))
        if i % 4 == 3:
            now = settle(now, "rank")
    return now.select("host", "score")


def link_filter(
    pages: DataFrame, rules: list[tuple[str, str]], rounds: int = ROUNDS, damping: float = DAMPING, margin: float = MARGIN, key: str = "page_id",
) -> DataFrame:
    """key, host, path, rule and verdict of every row of ``pages`` (columns ``url`` and ``html``)."""
    host, path = url_parts(F.col("url"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(key, host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("says", says)
    count = lambda verdict: F.count_if(F.coalesce(F.col("says") == verdict, F.lit(False)))

    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)
    target, at = url_parts(F.concat(F.lit("http:"), F.regexp_replace(F.col("link"), "(?i)^https?:", "")))
    linked = pages.select(host.alias("src"), F.explode(links).alias("link")).select("src", target.alias("host"), at.alias("path"))
    linked = linked.where("src <> host AND src <> '' AND host <> ''").withColumn("says", says)
    # the text of a link goes no further than its task
    edges = linked.groupBy("src", "host").agg(F.count("*").alias("w"), count("allow").alias("allowed"), count("block").alias("blocked"))
    edges = settle(edges, "links")
    total = edges.groupBy(F.col("src").alias("from")).agg(F.sum("w").alias("total"))
    forth = settle(edges.join(total, F.col("src") == F.col("from")).select("src", F.col("host").alias("dst"), (F.col("w") / F.col("total")).alias("share")), "forth")

    own = judged.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), count("allow").alias("allowed"), count("block").alias("blocked"))
    others = edges.groupBy("host").agg(*[F.sum(a).alias(z) for a, z in (("w", "n"), ("allowed", "allowed"), ("blocked", "blocked"))])
    known = own.unionByName(others.join(own.select("host"), "host", "left_anti"))
    hosts = settle(known.select("host", (F.col("allowed") / F.col("n")).alias("trusted"), (F.col("blocked") / F.col("n")).alias("distrusted")), "hosts")
    trust = spread(forth, hosts, "trusted", "dst", "src", rounds, damping).withColumnRenamed("score", "trust")
    distrust = spread(forth, hosts, "distrusted", "src", "dst", rounds, damping).withColumnRenamed("score", "distrust")
    over = lambda limit: F.round(F.col("distrust") - limit, PLACES) > 0
    bad = trust.join(distrust, "host").where(over(F.col("trust")) & over(F.lit(margin))).select("host", F.lit("block").alias("method"))
    # written first, so that the planner sees its size and joins it without moving the pages where it is small
    bad = settle(bad, "blocked")
    out = judged.join(bad, "host", "left")
    return out.select(key, "host", "path", "rule", F.coalesce("says", "method", F.lit("allow")).alias("verdict"))
