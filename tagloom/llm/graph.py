"""Connected components of links, as Spark joins over tables that shrink every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.sources.storage import materialise


def _flat(parents: DataFrame) -> DataFrame:
    """Point every node of a forest (node, parent) straight at its root, by doubling."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents = materialise(
            parents.join(above, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            ),
            "parents",
        )
        if parents.filter("moved").isEmpty():
            return parents.select("node", "parent")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that some link joins to another.

    ``component`` is the smallest node reachable. Each round hooks every node to
    its smallest smaller neighbour, flattens that forest by doubling, and
    contracts the links to its roots; at least half of the nodes with links go
    in a round, so a chain takes a logarithmic number of rounds. Links with a
    null end and links of a node to itself are ignored, repeated ones count
    once; without links the result is empty. Every round reads and writes
    tables in the shared folder, so a lost executor costs tasks, not the run.
    """
    x, y = F.col(a), F.col(b)
    edges = materialise(
        links.filter(x != y).select(F.greatest(x, y).alias("high"), F.least(x, y).alias("low")).distinct(), "links"
    )
    found: DataFrame | None = None
    while not edges.isEmpty():
        roots = _flat(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("parent")))
        high = roots.select(F.col("node").alias("high"), F.col("parent").alias("top"))
        low = roots.select(F.col("node").alias("low"), F.col("parent").alias("bottom"))
        joined = edges.join(high, "high").join(low, "low", "left")
        ends = joined.select("top", F.coalesce("bottom", "low").alias("bottom")).filter("top <> bottom")
        edges = materialise(
            ends.select(F.greatest("top", "bottom").alias("high"), F.least("top", "bottom").alias("low")).distinct(),
            "links",
        )
        if found is None:
            found = roots
        else:
            moved = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            kept = found.join(moved, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent"))
            found = materialise(kept.unionByName(roots.join(found, "node", "left_anti")), "roots")
    if found is None:
        return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    ends = found.select(F.col("parent").alias("node"), "parent").distinct()
    return found.unionByName(ends).distinct().withColumnRenamed("parent", "component")
