"""URL filters: rules by host and path, and trust carried along links between hosts.

A page takes the verdict of the longest rule that fits it. The rules' verdicts are also the seeds of two
personalised PageRanks over the graph of hosts: trust starts at hosts with allowed pages and follows links,
distrust starts at hosts with blocked pages and goes against them (who links to a bad host is suspect).
Pages without a rule take their host's verdict: blocked where distrust is at least ``ratio`` times trust.
Ranks are in pages (a seed's weight is its number of allowed or blocked pages), and what arrives at a host
without links ends there. Hosts that neither reaches are allowed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host and path as in a URL, verdict)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits a page, as ``(size, rule, verdict)``, or null; of equally long ones the last by code point.

    Rules are looked up by the host and the domains above it, of which only those with no more labels than a rule's host
    are made, so a host of very many labels costs no more than its length. No row leaves its place for it.
    """
    if not rules:
        return F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    by_host: dict[str, list[dict]] = {}
    for rule, verdict in rules:
        above, slash, rest = rule.partition("/")
        by_host.setdefault(above, []).append({"size": len(rule), "rule": rule, "prefix": slash + rest, "verdict": verdict})
    kind = "map<string, array<struct<size: int, rule: string, prefix: string, verdict: string>>>"
    table = F.from_json(F.lit(json.dumps(by_host)), kind)
    most = max(x.count(".") + 1 for x in by_host)
    parts = F.split(host, r"\.")
    own = F.slice(parts, F.greatest(F.lit(1), F.size(parts) - most + 1), F.lit(most))
    above = F.transform(F.sequence(F.lit(1), F.size(own)), lambda k: F.array_join(F.slice(own, k, F.size(own)), "."))
    found = F.flatten(F.transform(above, lambda h: F.coalesce(table[h], F.array())))
    fits = F.filter(found, lambda r: F.startswith(path, r["prefix"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return F.when(host != "", best)


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst`` and the number of ``links`` between different hosts, from ``href`` in the pages' HTML.

    Relative links stay on their host and are left out, like links without a host.
    """
    found = F.regexp_extract_all(F.col("html"), F.lit(r"""(?i)\bhref\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("url"))
    links = links.select("src", host_of(F.regexp_replace("url", "^//", "http://")).alias("dst"))
    return links.where("src != '' AND dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = 20, damping: float = 0.85, every: int = 5) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` after ``rounds`` rounds of both PageRanks.

    ``links`` is ``src, dst, links``; ``seeds`` is ``host, good, bad`` with weights. Ranks are written every few
    rounds, so that a lost executor costs no more than those.
    """
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    outs = ways.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    ways = materialise(ways.join(outs, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("links") / F.col("all")).alias("share")), "ways")
    start = seeds.select(F.lit("trust").alias("kind"), "host", F.col("good").cast("double").alias("seed")).unionByName(
        seeds.select(F.lit("distrust").alias("kind"), "host", F.col("bad").cast("double").alias("seed"))
    )
    start = materialise(start.where("seed > 0").select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank")), "seeds")
    ranks = start
    if ways.limit(1).count():
        for k in range(1, rounds + 1):
            sent = ranks.join(ways, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
            ranks = start.unionByName(sent).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
            if k % every == 0 or k == rounds:
                ranks = materialise(ranks, "ranks")
    return ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"),
    )


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, ratio: float = 2.0, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for each row of ``pages`` (``page_id, url, html``).

    A rule fits its host and all subdomains if the page's path starts with the rule's; the longest wins, of
    equally long ones the last by code point.

    - Null ``url`` or one without ``://``: host and path are empty, no rule fits, allowed.
    - Null ``html`` or ``page_id``: no links; carried as null. Repeated rows are judged alike, and their links count
      again. An empty table gives no rows. Other columns are ignored.
    """
    url = F.col("url").cast("string")
    base = pages.select(F.col("page_id").cast("long"), host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string"))
    ruled = base.select("page_id", "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("x"))
    ruled = materialise(ruled.select("page_id", "host", "path", F.col("x.rule").alias("rule"), F.col("x.verdict").alias("ruled")), "ruled")
    seeds = ruled.where("ruled IS NOT NULL").groupBy("host")
    seeds = seeds.agg(F.count_if(F.col("ruled") == "allow").alias("good"), F.count_if(F.col("ruled") == "block").alias("bad"))
    # Written, so that both sides of the join come from a plain shuffle and a host with very many pages can be split.
    scores = materialise(propagate(host_links(base), seeds, **options), "scores")
    out = ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", "ruled", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= ratio * F.col("trust"))
    verdict = F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
