"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (columns a and b); the component is its smallest node.

    Every node moves to its smallest neighbour, links follow their ends, and so on until none is left: each round at least
    halves the nodes, so there are few rounds.  Minima are combined before the shuffle, so a node with very many links is no
    burden; each round is written to the shared folder, so lost executors cost one round at most.
    """
    links = durable(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        # A node is its own candidate too, so the smallest node of a component stays where it is.
        moved = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("to")))
        if labels is None:
            labels = moved.withColumnRenamed("to", "component")
        else:
            step = moved.select(F.col("node").alias("component"), "to")
            labels = durable(labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        for end in ("a", "b"):
            step = moved.select(F.col("node").alias(end), "to")
            links = links.join(step, end).drop(end).withColumnRenamed("to", end)
        links = durable(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
