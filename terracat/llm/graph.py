"""Connected components of a link table, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import discard, staged


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> node, component: the smallest node reachable. Nodes without links are not listed.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the hooks twice, and renames the
    links' ends; links within a component vanish. The rounds needed grow with the logarithm of the largest component.
    Every round is a written table, and those of earlier rounds are deleted.
    """
    edges = staged(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    labels, done = None, None  # done: what the labels are read from, while they are no table of their own
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "hooks")
        hook = first
        for _ in range(2):
            up = hook.select(F.col("a").alias("to"), F.col("to").alias("further"))
            hook = hook.join(up, "to").select("a", F.col("further").alias("to"))
        hook = staged(hook, "hooks")
        if labels is None:
            labels, spent = hook.select(F.col("a").alias("node"), F.col("to").alias("component")), []
            last = hook
        else:
            up = hook.select(F.col("a").alias("component"), "to")
            last = staged(labels.join(up, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
            labels, spent = last, [done, hook]
        old = edges
        for end in ("a", "b"):
            up = hook.select(F.col("a").alias(end), "to")
            edges = edges.join(up, end).drop(end).withColumnRenamed("to", end)
        edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        discard(first, old, *spent)
        done = last
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    discard(edges)
    return labels
