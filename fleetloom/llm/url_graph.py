"""Url verdicts: rules first, then trust and distrust passed along the links of hosts.

Hosts whose pages the rules mostly allow are trusted seeds, hosts whose pages they mostly
block are blocked seeds. Trust is a PageRank personalised to the trusted seeds, over
edges from host to host; distrust runs from the blocked seeds over the reversed edges, so
it reaches hosts that link to them. A page that no rule fits is blocked if its host has
more distrust than trust and more than the mean share of all hosts.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.session import release, scratch_table

DAMPING = 0.85
SETTLED = 1e-9
# Rounds in one job; what they change is asked after it.
ROUNDS_AT_ONCE = 10

Rule = tuple[str, str]


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://`` and the path; empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return tuple(F.coalesce(c, F.lit("")) for c in (lowered(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)))


def fits(rule: str, host: Column, path: Column) -> Column:
    """True for the rule's host and its subdomains, if the path starts with the rule's."""
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    by_length = sorted((rule for rule, _ in rules), key=lambda r: (-len(r), r))
    return F.coalesce(*[F.when(fits(rule, host, path), F.lit(rule)) for rule in by_length], F.lit(None).cast("string"))


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, links: absolute links between different hosts, counted once a page."""
    own, _ = host_and_path(F.col("url"))
    links = F.regexp_extract_all("html", F.lit(r"(?i)\bhref\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]*)"), F.lit(1))
    hosts = F.array_distinct(F.transform(links, lambda x: lowered(F.regexp_extract(x, r"^[^/]*//([^/?#]*)", 1))))
    return (
        pages.select(own.alias("source"), F.explode(hosts).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def _ranked(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """kind, host, score: per kind, the PageRank that starts anew at ``seeds`` (kind, host, weight; weights add up to 1).

    ``edges`` has kind, source, target and links. What reaches a host without outgoing
    edges starts anew at the seeds too, so the ranks are in proportion to what
    x = seeds + DAMPING * (x passed on) settles to, and no sum over all hosts is needed on
    the way. Rounds go on until ``ROUNDS_AT_ONCE`` more of them change less than SETTLED of
    all; each takes DAMPING of the change before.
    """
    out = edges.groupBy("kind", "source").agg(F.sum("links").alias("_out"))
    share = (F.col("links") / F.col("_out") * DAMPING).alias("_share")
    steps = scratch_table(edges.join(out, ["kind", "source"]).select("kind", F.col("source").alias("host"), "target", share), "link-steps")
    start = scratch_table(seeds.select("kind", "host", F.col("weight").alias("score")), "link-seeds")
    ranks = start
    while True:
        following = ranks
        for _ in range(ROUNDS_AT_ONCE):
            passed = following.join(steps, ["kind", "host"]).select("kind", F.col("target").alias("host"), (F.col("score") * F.col("_share")).alias("score"))
            following = passed.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        following = scratch_table(following, "link-ranks")
        both = following.unionByName(ranks.select("kind", "host", (-F.col("score")).alias("score")))
        change = both.groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("d")).agg(F.sum("d")).first()[0] or 0.0
        if ranks is not start:
            release(ranks)
        ranks = following
        if change < SETTLED:
            break
    mass = ranks.groupBy("kind").agg(F.sum("score").alias("_mass"))
    return ranks.join(F.broadcast(mass), "kind").select("kind", "host", (F.col("score") / F.col("_mass")).alias("score"))


def _seeds(hosts: DataFrame, chosen: Column, kind: str) -> DataFrame:
    """kind, host, weight: the chosen hosts by their pages."""
    picked = hosts.where(chosen).select("host", "pages")
    total = picked.agg(F.sum("pages")).first()[0] or 1
    return picked.select(F.lit(kind).alias("kind"), "host", (F.col("pages") / F.lit(total)).alias("weight"))


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page.

    ``rules`` are pairs of a text like ``example.org/de/`` and ``allow`` or ``block``; the
    longest that fits decides. Null or odd urls have no host and, without a rule, are
    allowed; a null page has no links; repeated pages are judged alike.
    """
    host, path = host_and_path(F.col("url"))
    rule = longest_rule(rules, F.col("host"), F.col("path"))
    allowed = [r for r, verdict in rules if verdict == "allow"]
    ruled = F.when(F.col("rule").isNotNull(), F.when(F.col("rule").isin(allowed), "allow").otherwise("block"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("ruled", ruled)
    hosts = scratch_table(
        rows.where("host <> ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("ruled") == "allow").alias("allowed"),
            F.count_if(F.col("ruled") == "block").alias("blocked"),
        ),
        "hosts",
    )
    edges = scratch_table(host_edges(pages), "host-edges")
    named = hosts.select("host").unionByName(edges.select(F.col("target").alias("host"))).distinct()
    mean = 1.0 / max(1, named.count())
    trusted = edges.select(F.lit("trust").alias("kind"), "source", "target", "links")
    against = edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "links")
    seeds = _seeds(hosts, F.col("allowed") * 2 >= F.col("pages"), "trust").unionByName(_seeds(hosts, F.col("blocked") * 2 >= F.col("pages"), "distrust"))
    ranks = _ranked(trusted.unionByName(against), seeds)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    scores = scratch_table(ranks.groupBy("host").agg(of("trust"), of("distrust")), "host-scores")
    verdict = F.coalesce("ruled", F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") > mean), "block").otherwise("allow"))
    return rows.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")],
    )
