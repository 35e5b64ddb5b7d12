"""URL filters: rules first, then propagation of trust and distrust over the links between hosts.

Rules judge urls by host and path. What they leave open is judged per host: a host's share of
allowed urls is its trust seed, its share of blocked ones its distrust seed (of the urls that a
rule judges). Trust runs along links as a personalised PageRank; distrust runs against them, from a
blocked host to those that link to it. A host is blocked if its distrust exceeds ``BLOCK_RATIO``
times its trust and is not negligible.

Everything is DataFrame work: links are cut out of the html with expressions, combined to one
weighted edge for each pair of hosts before any join, and each step joins one row per host to the
edges. A hub's edges are split by adaptive execution. Steps are stored in the shared folder, which
cuts the lineage, and end when scores no longer change.

Relative links stay on their host and count for nothing. Null urls and urls without ``://`` have an
empty host, no rule and no links; they are allowed. Null html has no links. Repeated rows are kept.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.tables import stored

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
#: Steps between two stored states, and the greatest number of steps.
STORED_EVERY = 4
MOST_STEPS = 40
#: Greatest change of a host's score in a step at which propagation ends.
TOLERANCE = 1e-4
BLOCK_RATIO = 2.0
#: Distrust below this never blocks.
LEAST_DISTRUST = 0.01

#: Rules of the registered query: host, path, verdict.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
_ABSOLUTE_LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path together) and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, weight (links): one row for each ordered pair of different hosts."""
    links = pages.select(url_host(F.col("url")).alias("source"), F.explode(F.regexp_extract_all("html", F.lit(_ABSOLUTE_LINK), F.lit(1))).alias("link"))
    target = _lower(F.regexp_extract("link", r"//([^/?#]*)", 1))
    return (
        links.select("source", target.alias("target"))
        .where((F.col("source") != F.col("target")) & (F.col("source") != "") & (F.col("target") != ""))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def host_seeds(judged: DataFrame) -> DataFrame:
    """host, trust, distrust: shares of a host's rule verdicts; zeros where no rule speaks."""
    said = lambda verdict: F.sum(F.when(F.col("rule_verdict") == verdict, 1.0).otherwise(0.0))
    counts = judged.where(F.col("host") != "").groupBy("host").agg(said(ALLOW).alias("allowed"), said(BLOCK).alias("blocked"))
    total = F.greatest(F.col("allowed") + F.col("blocked"), F.lit(1.0))
    return counts.select("host", (F.col("allowed") / total).alias("trust"), (F.col("blocked") / total).alias("distrust"))


def propagate(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """host, score after propagation of ``seeds`` (host, seed) along ``edges`` (a, b, share).

    share: the part of a's score that goes to b. One join and one sum for each step.
    """
    seeds = stored(seeds)
    now, done = seeds.select("host", "seed", ((1 - DAMPING) * F.col("seed")).alias("score")), 0
    while done < MOST_STEPS:
        for _ in range(STORED_EVERY):
            before = now
            flow = now.join(edges, now["host"] == edges["a"]).groupBy("b").agg(F.sum(F.col("score") * F.col("share")).alias("flow"))
            now = seeds.join(flow, seeds["host"] == flow["b"], "left").select(
                "host", "seed", ((1 - DAMPING) * F.col("seed") + DAMPING * F.coalesce("flow", F.lit(0.0))).alias("score")
            )
        last = before.select("host", F.col("score").alias("score_before"))
        now = stored(now.join(last, "host"))
        done += STORED_EVERY
        change = now.agg(F.max(F.abs(F.col("score") - F.col("score_before")))).first()[0]
        now = now.drop("score_before")
        if change is None or change <= TOLERANCE:
            break
    return now.select("host", "score")


def host_scores(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """host, trust, distrust for every host with a url or a link."""
    edges = stored(edges)
    linked = edges.select(F.col("source").alias("host")).union(edges.select("target")).distinct()
    seeds = stored(linked.join(seeds, "host", "full").select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))

    def shares(end: str) -> DataFrame:
        """Each edge's part of all the weight at its ``end``."""
        totals = edges.groupBy(end).agg(F.sum("weight").alias("total"))
        return edges.join(totals, end).select("source", "target", (F.col("weight") / F.col("total")).alias("share"))

    along = stored(shares("source").select(F.col("source").alias("a"), F.col("target").alias("b"), "share"))
    against = stored(shares("target").select(F.col("target").alias("a"), F.col("source").alias("b"), "share"))
    trust = propagate(seeds.select("host", F.col("trust").alias("seed")), along).withColumnRenamed("score", "trust")
    distrust = propagate(seeds.select("host", F.col("distrust").alias("seed")), against).withColumnRenamed("score", "distrust")
    return trust.join(distrust, "host")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust, for every page."""
    urls = pages.select(F.col("page_id"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = urls.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))
    scores = host_scores(host_seeds(judged), host_edges(pages))
    bad = (F.col("distrust") > BLOCK_RATIO * F.col("trust")) & (F.col("distrust") >= LEAST_DISTRUST)
    return judged.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bad, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
