"""URL filter: host and path rules, and trust propagated over the link graph of hosts.

A page that a rule fits takes the verdict of the longest one. For the others, two
personalised PageRanks run over the links between hosts: trust starts at hosts in the
share of their pages that rules allow and follows links forward; distrust starts in the
share that rules block and follows links backward (who links to blocked hosts is
suspect). Beside each runs the plain PageRank of the same direction, which starts at
every host alike. A host's trust is the share of what reached it along links that came
from allowed pages, its distrust likewise; neither depends on how many hosts share a
neighbour. The share of its own pages is the least a host has. A host is blocked from a
threshold on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of the mass that follows links; the rest returns to the seeds.
DAMPING = 0.85
#: A host passes on what reached it last while that is more than this part of all it has.
TOLERANCE = 1e-7
#: A host is blocked if its distrust reaches this and exceeds its trust.
BLOCK_FROM = 0.5
#: Absolute and protocol-relative links; relative ones stay on the host.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    rule: str  # host and path, such as "example.com/en/"

    @property
    def host(self) -> str:
        return self.rule[: self.rule.index("/")]

    @property
    def path(self) -> str:
        return self.rule[self.rule.index("/") :]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); of equally long ones the first by text.

    The list is written into the plan, so it is meant for up to some hundred rules.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule), reverse=True):
        under = (host == r.host) | host.endswith(f".{r.host}")
        hit = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(under & path.startswith(r.path), hit).otherwise(found)
    return found


def judged_by_rules(pages: DataFrame, rules: list[Rule], page_id: str, url: str) -> DataFrame:
    parts = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    best = parts.withColumn("best", best_rule(rules, F.col("host"), F.col("path")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, summed before they are shuffled."""
    linked = pages.where(F.col(html).contains("//")).select(
        host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("link")
    )
    ends = linked.select("src", lower_ascii(F.col("link")).alias("dst"))
    return ends.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def transitions(links: DataFrame) -> DataFrame:
    """(kind, src, dst, w): trust along links, distrust against them; shares of a source sum to 1."""
    both = links.select(
        F.inline(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n"),
                F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n"),
            )
        )
    )
    totals = both.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    shares = both.join(totals, ["kind", "a"])
    return shares.select("kind", F.col("a").alias("src"), F.col("b").alias("dst"), (F.col("n") / F.col("total")).alias("w"))


def seed_mass(judged: DataFrame) -> DataFrame:
    """(kind, host, seed): share of a host's pages that rules allow (trust) or block (distrust)."""
    allowed, blocked = (F.avg(F.when(F.col("verdict") == v, 1.0).otherwise(0.0)) for v in ("allow", "block"))
    by_host = judged.where("host <> ''").groupBy("host").agg(allowed.alias("a"), blocked.alias("b"))
    pair = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("a").alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), F.col("b").alias("seed")),
    )
    return by_host.select("host", F.inline(pair)).where("seed > 0").select("kind", "host", "seed")


def host_ranks(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, seed, got, got_plain): what reaches a host along links in its personalised PageRank, and in the plain one.

    A step sends only what reached a host in the step before, and only from hosts where
    that still matters; every round trip loses 1 - ``damping``, so the steps end by
    themselves. Mass of a host without onward links goes nowhere. Hosts without any link
    take no part. Every step is written to the shared folder, so a lost executor costs
    one step.
    """
    edges = stage(transitions(links), "edges")
    ends = edges.select("kind", F.explode(F.array("src", "dst")).alias("host")).distinct()
    back = 1 - damping
    start = ends.join(seeds, ["kind", "host"], "left").select("kind", "host", F.coalesce("seed", F.lit(0.0)).alias("seed"))
    zero = F.lit(0.0)
    state = stage(start.select("kind", "host", "seed", zero.alias("got"), zero.alias("got_plain"), (F.col("seed") * back).alias("new"), F.lit(back).alias("new_plain")), "ranks")
    amounts = ["seed", "got", "got_plain", "new", "new_plain"]
    onward = edges.withColumnRenamed("src", "host")
    matters = (F.col("new") > tolerance * (F.col("seed") * back + F.col("got"))) | (F.col("new_plain") > tolerance * (back + F.col("got_plain")))
    while not state.where(matters).isEmpty():
        sent = state.where(matters).join(onward, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), zero.alias("seed"),
            *[(F.col(c) * F.col("w") * damping).alias(name) for c, name in (("new", "got"), ("new_plain", "got_plain"), ("new", "new"), ("new_plain", "new_plain"))],
        )
        held = state.select("kind", "host", "seed", "got", "got_plain", zero.alias("new"), zero.alias("new_plain"))
        state = stage(held.unionByName(sent).groupBy("kind", "host").agg(*[F.sum(c).alias(c) for c in amounts]), "ranks")
    return state.select("kind", "host", "seed", "got", "got_plain")


def host_shares(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, share) between 0 and 1: the seed, or if more, the seeded part of what reached the host."""
    seeds = stage(seeds, "seeds")
    ranks = host_ranks(seeds, links, damping, tolerance)
    share = F.greatest("seed", F.coalesce(F.col("got") / F.nullif("got_plain", F.lit(0.0)), F.lit(0.0)))
    return ranks.select("kind", "host", share.alias("share")).unionByName(
        seeds.join(ranks, ["kind", "host"], "left_anti").select("kind", "host", F.col("seed").alias("share"))
    )


def filter_urls(
    pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", html: str = "html",
    block_from: float = BLOCK_FROM, tolerance: float = TOLERANCE,
) -> DataFrame:
    """Every page as (page_id, host, path, rule, verdict, trust, distrust).

    ``verdict`` is that of the longest fitting rule, else ``block`` where the host's
    distrust reaches ``block_from`` and exceeds its trust, else ``allow``. A null url
    or one without ``://`` has an empty host and path, no trust and no distrust, and
    is allowed. Null html has no links. Repeated pages each get their row and count
    each as a page of their host. No rules, or no pages: no seeds, all allowed.
    """
    judged = judged_by_rules(pages, rules, page_id, url)
    shares = host_shares(seed_mass(judged), host_links(pages, url, html), tolerance=tolerance)
    by_kind = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("share"))), F.lit(0.0)).alias(k)
    hosts = stage(shares.groupBy("host").agg(by_kind("trust"), by_kind("distrust")), "host-trust")
    scored = judged.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    blocked = (F.col("distrust") >= block_from) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce("verdict", F.when(blocked, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
