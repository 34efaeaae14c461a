"""URL filtering by host and path rules, and by trust spread over the links between hosts.

Pages that a rule allows make their host a seed of trust, pages that a rule blocks a seed of
distrust. Trust flows along the links between hosts, distrust against them (who links to blocked
hosts is suspect), both as personalised PageRank. A page that no rule fits gets its host's verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored

DAMPING = 0.85
# Rounds go on until no new host is reached and all ranks together gain less than this in _STEP.
TOLERANCE = 1e-7
_STEP = 4
# Ranks that take longer are an error; a chain of links may be as long.
MOST_ROUNDS = 10_000
# A host is blocked if its distrust is more than so many times its trust.
DISTRUST_RATIO = 2.0
# Hosts are broadcast up to so many rows and bytes of names; beyond that they are joined.
BROADCAST_HOSTS = 4000
BROADCAST_BYTES = 1 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LINK = r"""(?i)<(?:a|area|link)\b[^>]*?\shref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(
            path, F.lit(rule.path)
        )
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight``: pages of ``src`` that link to ``dst``, another host."""
    return (
        pages.select("host", F.explode_outer(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("to"))
        .where("to is not null")
        .select(
            F.col("host").alias("src"),
            host_of(F.regexp_replace("to", r"\A//", "http://")).alias("dst"),
        )
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def personalised_rank(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, rank``; ``seeds`` has ``host, seed`` that add up to 1 (or 0).

    What a host without links would pass on is lost: ranks are compared with each other, and trust
    that leads nowhere is none. One row per host and edge moves in each round. Ranks only grow and
    hosts are only added from round to round, so their sum and number tell when all is settled.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("all"))
    share = stored(
        edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("all")).alias("share")),
        "rank-edges",
    )
    start = seeds.select("host", (F.col("seed") * (1 - DAMPING)).alias("rank"))
    rank = stored(start, "rank")
    seen = rank.agg(F.count("*"), F.sum("rank")).first()
    for _ in range(0, MOST_ROUNDS, _STEP):
        for _ in range(_STEP):
            flow = share.join(rank, F.col("src") == F.col("host")).select(
                F.col("dst").alias("host"), (F.col("rank") * F.col("share") * DAMPING).alias("rank")
            )
            rank = start.unionByName(flow).groupBy("host").agg(F.sum("rank").alias("rank"))
        rank = stored(rank, "rank")
        now = rank.agg(F.count("*"), F.sum("rank")).first()
        if now[0] == seen[0] and (now[1] or 0.0) - (seen[1] or 0.0) <= TOLERANCE:
            return rank
        seen = now
    raise RuntimeError(f"ranks are not settled after {MOST_ROUNDS} rounds")


def judge_hosts(pages: DataFrame) -> DataFrame:
    """``host, trust, distrust, host_verdict`` from pages with ``host, html, rule_verdict``."""
    counted = stored(
        pages.groupBy("host").agg(
            F.count(F.when(F.col("rule_verdict") == "allow", 1)).alias("good"),
            F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("bad"),
        ),
        "hosts",
    )
    total = counted.agg(F.sum("good"), F.sum("bad")).first()

    def seeds(column: str, all_of: int | None) -> DataFrame:
        part = F.col(column) / F.lit(float(max(all_of or 0, 1)))
        return counted.where(F.col(column) > 0).select("host", part.alias("seed"))

    edges = stored(host_edges(pages), "host-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = personalised_rank(edges, seeds("good", total[0]))
    distrust = personalised_rank(back, seeds("bad", total[1]))
    both = (
        counted.select("host")
        .join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        .na.fill(0.0)
    )
    blocked = F.col("distrust") > DISTRUST_RATIO * F.col("trust")
    return both.withColumn("host_verdict", F.when(blocked, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust``, one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; a
    null html has no links; repeated rows count each; an empty table gives no rows.
    """
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html"
    )
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("rule_verdict", verdict)
    hosts = stored(judge_hosts(rows), "host-verdicts")
    size = hosts.agg(F.count("*"), F.sum(F.octet_length("host"))).first()
    few = size[0] <= BROADCAST_HOSTS and (size[1] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(hosts) if few else hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "host_verdict").alias("verdict"),
        "trust",
        "distrust",
    )
