"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import dropped, written


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b), of any type with an order -> (node, component) for every node of an edge; component is the least node that it reaches.

    Each round hooks every node to the least of itself and its neighbours, halves the hooks' chains, and contracts the
    graph to its roots, so the edges that remain shrink by a factor each round; rounds are written to the shared folder.
    """
    left = written(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        for _ in range(2):
            up = hook.select(F.col("node").alias("to"), F.col("to").alias("up"))
            hook = hook.join(up, "to").select("node", F.col("up").alias("to"))
        hook = written(hook, "hooks")
        if labels is None:
            nxt = hook.select("node", F.col("to").alias("component"))
        else:
            nxt = labels.join(hook.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        nxt = written(nxt, "labels")
        ends = left.join(hook.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(hook.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        rest = written(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        for old in (left, hook, labels):
            if old is not None:
                dropped(old)
        left, labels = rest, nxt
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    dropped(left)
    return labels
