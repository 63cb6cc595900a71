"""Connected components of a table of links, by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import bounded_broadcast, forget, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component's name is one of its nodes.

    Each round every node hooks to the one of itself and its neighbours that comes first in a
    fixed random order, and links are rewritten to the hooks. Rounds grow with the logarithm of
    the nodes; the order is by hash, so neither stars nor chains take more. Every round's tables
    are stored; links to itself and repeated links are allowed.
    """
    def both(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def rank(node: str) -> Column:
        return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("node"))

    edges = stored(links.filter("a <> b").distinct(), "links")
    loose = links.filter("a = b").select(F.col("a").alias("node")).distinct()
    names = None
    while not edges.isEmpty():
        first = both(edges).groupBy("a").agg(F.min(rank("b")).alias("other"))
        hooks = stored(first.select(F.col("a").alias("node"), F.least("other", rank("a"))["node"].alias("hook")), "hooks")
        lookup = bounded_broadcast(hooks)
        by_a = lookup.select(F.col("node").alias("a"), F.col("hook").alias("x"))
        by_b = lookup.select(F.col("node").alias("b"), F.col("hook").alias("y"))
        after = edges.join(by_a, "a").join(by_b, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        after = stored(after, "links")
        if names is None:
            moved = hooks.select("node", F.col("hook").alias("component"))
        else:
            step = lookup.select(F.col("node").alias("component"), "hook")
            moved = names.join(step, "component", "left").select("node", F.coalesce("hook", "component").alias("component"))
        moved = stored(moved, "names")
        for old in (edges, hooks, names):
            if old is not None:
                forget(old)
        edges, names = after, moved
    if names is None:
        return loose.select("node", F.col("node").alias("component"))
    alone = loose.join(names, "node", "left_anti").select("node", F.col("node").alias("component"))
    return names.unionByName(alone)
