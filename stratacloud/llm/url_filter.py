"""URL filters: rules by host and path, then link-graph propagation of trust and distrust for what no rule decides.

A host's trust seed is the share of its pages that an allow rule decides, its distrust seed the share that a block rule
decides. Trust flows along links by personalised PageRank, in shares of the linking host's links; distrust flows against
them (who links to blocked hosts), also in shares of the linking host's links, so that how many others link to a blocked host
changes nothing. A host whose distrust exceeds its trust and the threshold is blocked; any other host is allowed.

Links are aggregated to distinct host pairs with counts before anything is joined. The iteration moves (host, score)
rows only; a host with very many links is one key on a sort-merge join that adaptive execution splits, and sums over
a key are pre-aggregated. State is cut by checkpoints every few rounds.

Null url or one without "://": host and path are empty, and no propagation reaches it. Null or empty html: no links. Null
page_id: judged as any. Repeated pages: each is judged and counted. Distrust equal to trust or to the threshold does not block. An empty table gives an empty result. Columns of the input named like the results' are not read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, THRESHOLD = 0.85, 0.5
#: Rounds go on until no score moves by more; a score is then within TOLERANCE * DAMPING / (1 - DAMPING) of its limit.
TOLERANCE = 1e-6
#: Rounds between checkpoints, and blocked hosts up to which their list is broadcast.
CUT_EVERY, BROADCAST_HOSTS = 4, 200_000
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest fitting rule, null if none fits; a rule is a host suffix and a path prefix."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: src, dst, n."""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("link"))
    links = links.select(F.col("host").alias("src"), host_of(F.regexp_replace("link", "^//", "://")).alias("dst"))
    return links.filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, shares_of: str = "src") -> DataFrame:
    """edges(src, dst, n), seeds(host, seed) to host, score: score = (1 - damping) seed + damping * sum of the in-links'
    shares, a link's share being of all links of its src, or of its dst. A host without out-links passes nothing on. Each
    round moves the scores by the damping less at least, so rounds end: when no score moves by more than the tolerance."""
    base = durable(seeds.select("host", (F.col("seed") * (1 - damping)).alias("base")).filter("base > 0"))
    out = edges.groupBy(shares_of).agg(F.sum("n").alias("total"))
    shares = durable(edges.join(out, shares_of).select("src", "dst", (F.col("n") / F.col("total")).alias("share")))
    scores = base.withColumnRenamed("base", "score")
    if shares.isEmpty():
        return scores
    for k in count(1):
        flow = shares.join(scores.withColumnRenamed("host", "src"), "src").groupBy(F.col("dst").alias("host")).agg((F.sum(F.col("share") * F.col("score")) * damping).alias("flow"))
        new = flow.join(base, "host", "full").select("host", (F.coalesce("flow", F.lit(0.0)) + F.coalesce("base", F.lit(0.0))).alias("score"))
        if k % CUT_EVERY == 0:
            new = durable(new)
            moved = new.join(scores.withColumnRenamed("score", "old"), "host", "full").agg(F.max(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
            if moved is None or moved <= tolerance:
                return new
        scores = new


def blocked_hosts(judged: DataFrame, edges: DataFrame, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """judged(host, rule_verdict) per page; hosts that the propagation blocks, with trust and distrust."""
    share = lambda v: F.count_if(F.col("rule_verdict") == v) / F.count("*")
    seeds = durable(judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block")))
    trust = personalised_rank(edges, seeds.select("host", F.col("allow").alias("seed")), damping)
    distrust = personalised_rank(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"), seeds.select("host", F.col("block").alias("seed")), damping, shares_of="dst")
    both = distrust.withColumnRenamed("score", "distrust").join(trust.withColumnRenamed("score", "trust"), "host", "left").na.fill(0.0, ["trust"])
    return both.filter((F.col("distrust") > F.col("trust")) & (F.col("distrust") > threshold * (1 - damping)))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """pages(page_id, url, html): page_id, host, path, rule, verdict."""
    p = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    p = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    p = p.withColumn("match", matched_rule(F.col("host"), F.col("path"), rules))
    judged = p.select("page_id", "host", "path", F.col("match.rule").alias("rule"), F.col("match.verdict").alias("rule_verdict"))
    edges = durable(host_links(p))
    blocked = durable(blocked_hosts(judged, edges, damping, threshold).select(F.col("host").alias("blocked_host")))
    if blocked.count() <= BROADCAST_HOSTS:
        blocked = F.broadcast(blocked)
    out = judged.join(blocked, F.col("rule_verdict").isNull() & (F.col("host") == F.col("blocked_host")), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked_host").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
