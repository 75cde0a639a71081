"""Connected components of a link table by contraction.

Each round every node hooks to its smallest neighbour, hooks are shortened by pointer jumping, and the links are drawn
anew between the nodes hooked to. At least half of the nodes that still have links vanish per round. All tables are
staged, so a lost executor costs a task, not the lineage; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

JUMPS = 2


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _relabel(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``column`` replaced by the node it is hooked to; between staged tables AQE can split a node of high degree."""
    to = hooks.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    return (
        rows.join(to, F.col(column) == F.col("_node"), "left")
        .withColumn(column, F.coalesce("_parent", column))
        .drop("_node", "_parent")
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``(a, b)``; a component is named by its smallest node."""
    edges = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        smallest = _both_ways(edges).groupBy("a").agg(F.min("b").alias("b"))
        hooks = stage(smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "hooks")
        for _ in range(JUMPS):
            hooks = stage(_relabel(hooks, "parent", hooks), "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("parent").alias("component"))
        else:
            labels = stage(_relabel(labels, "component", hooks), "labels")
        moved = _relabel(_relabel(edges, "a", hooks), "b", hooks).where("a <> b")
        edges = stage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
