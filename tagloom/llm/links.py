"""Verdicts on urls: host rules first, then trust and distrust spread over the links between hosts.

Trust is a personalised PageRank from hosts with allowed pages along links; distrust
is one from hosts with blocked pages against them, for who links to bad hosts. Both
run on a table of hosts and one of host pairs, never on pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.sources.storage import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute and protocol-relative targets of links, up to the end of the host.
LINKED = r"""(?i)\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: str) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str) -> Column:
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", text)
    return F.when(at > 0, F.substr(text, at + 3)).otherwise("")


def matched(rules: Sequence[Rule], host: Column, path: Column, field: str) -> Column:
    """``field`` of the longest rule that fits, of equal lengths the first by name; null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    choices = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), getattr(r, field))
        for r in ordered
    ]
    return F.coalesce(*choices, F.lit(None).cast("string"))


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(source, target, n): links between different hosts, counted; needs a column ``host``."""
    found = pages.select(F.col("host").alias("source"), F.regexp_extract_all(html, F.lit(LINKED), F.lit(1)).alias("t"))
    links = found.filter(F.size("t") > 0).select("source", F.explode("t").alias("target"))
    links = links.withColumn("target", F.translate("target", UPPER, LOWER))
    return links.filter("source <> '' AND source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


def propagate(
    seeds: DataFrame, links: DataFrame, *, damping: float = 0.85, rounds: int = 30, tolerance: float = 1e-6
) -> DataFrame:
    """(host, trust, distrust) from (host, trust, distrust) seeds that each sum to 1 or are all 0.

    Every round is one pass over the links in each direction; the table of ranks
    is written each round. Rank of a host without links that way goes back to
    the seeds. It stops when the ranks move by less than ``tolerance`` in all,
    or after ``rounds``.
    """
    out = links.groupBy("source").agg(F.sum("n").alias("all"))
    into = links.groupBy("target").agg(F.sum("n").alias("all"))
    forward = links.join(out, "source").select(F.col("source").alias("a"), F.col("target").alias("b"), (F.col("n") / F.col("all")).alias("w"), F.lit(True).alias("with"))
    backward = links.join(into, "target").select(F.col("target").alias("a"), F.col("source").alias("b"), (F.col("n") / F.col("all")).alias("w"), F.lit(False).alias("with"))
    edges = materialise(forward.unionByName(backward), "host-links")
    hosts = seeds.select("host").unionByName(edges.select(F.col("a").alias("host"))).distinct()
    start = materialise(
        hosts.join(seeds, "host", "left").select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")]),
        "seeds",
    )
    ranks = start
    if edges.isEmpty():
        return ranks
    for _ in range(rounds):
        moved = edges.join(ranks.withColumnRenamed("host", "a"), "a")
        moved = moved.groupBy(F.col("b").alias("host")).agg(
            F.sum(F.when(F.col("with"), F.col("w") * F.col("trust")).otherwise(0.0)).alias("in_trust"),
            F.sum(F.when(~F.col("with"), F.col("w") * F.col("distrust")).otherwise(0.0)).alias("in_distrust"),
        )
        given = moved.agg(F.sum("in_trust"), F.sum("in_distrust")).first()
        total = start.agg(F.sum("trust"), F.sum("distrust")).first()
        columns = ["host"]
        for name, sent, mass in zip(("trust", "distrust"), given, total, strict=True):
            back = (mass or 0.0) - damping * (sent or 0.0)  # the restart, and what dead ends give back
            columns.append((F.col(f"s.{name}") * back / (mass or 1.0) + damping * F.coalesce(f"in_{name}", F.lit(0.0))).alias(name))
        following = materialise(start.alias("s").join(moved, "host", "left").select(*columns), "ranks")
        change = following.alias("x").join(ranks.alias("y"), "host").agg(
            F.sum(F.abs(F.col("x.trust") - F.col("y.trust")) + F.abs(F.col("x.distrust") - F.col("y.distrust")))
        )
        ranks = following
        if (change.first()[0] or 0.0) < tolerance:
            break
    return ranks


def judge(
    pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url", html: str = "html",
    threshold: float = 0.5, damping: float = 0.85, rounds: int = 30,
) -> DataFrame:
    """(key, host, path, rule, verdict, trust, distrust), one row per page.

    A rule that fits decides. Otherwise a host is blocked when distrust is more
    than ``threshold`` of its trust and distrust; without either, and for null
    urls and urls without ``://``, it is allowed. Repeated rows are judged one
    by one; null html has no links; an empty table gives an empty result. The
    rules are a short list that travels in the plan. A rule's verdict needs no
    join; other pages meet the table of hosts, which Spark may split by host.
    """
    located = pages.select(F.col(key).alias("key"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = located.select(
        "*",
        matched(rules, F.col("host"), F.col("path"), "name").alias("rule"),
        matched(rules, F.col("host"), F.col("path"), "verdict").alias("verdict"),
    )
    votes = ruled.filter("rule IS NOT NULL").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust")
    )
    votes = materialise(votes, "votes")
    sums = votes.agg(F.sum("trust"), F.sum("distrust")).first()
    seeds = votes.select("host", *[(F.col(c) / F.lit(float(s or 1))).alias(c) for c, s in zip(("trust", "distrust"), sums, strict=True)])
    links = host_links(pages.select(host_of(url).alias("host"), html), html)
    ranks = propagate(seeds, materialise(links, "host-links"), damping=damping, rounds=rounds)
    ranks = ranks.withColumn("bad", F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")))
    empty = F.lit(None).cast("double")
    decided = ruled.filter("rule IS NOT NULL").withColumns({"trust": empty, "distrust": empty})
    others = ruled.filter("rule IS NULL").drop("verdict").join(ranks, "host", "left")
    others = others.withColumn("verdict", F.when(F.col("bad"), "block").otherwise("allow"))
    columns = [F.col("key").alias(key), "host", "path", "rule", "verdict", "trust", "distrust"]
    return decided.select(*columns).unionByName(others.select(*columns))
