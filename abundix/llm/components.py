"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abundix.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest node.

    Every round each node points to its smallest neighbour, pointers are followed twice, and the
    edges are drawn between where their ends point to; edges inside one node vanish.  The smallest
    node of a component always points to itself, so it is what remains.  A round costs a few joins
    of the remaining edges, and their nodes shrink by at least half.
    """
    labels = None
    while True:
        edges = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if edges.isEmpty():
            break
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = cut_lineage(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to")))
        for _ in range(2):
            further = point.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            point = point.join(further, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_t", "to").alias("to"))
        point = cut_lineage(point)
        if labels is None:
            labels = point.select("node", F.col("to").alias("component"))
        else:
            further = point.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            labels = labels.join(further, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_t", "component").alias("component"))
        labels = cut_lineage(labels)
        first = point.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        second = point.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        edges = edges.join(first, "a").join(second, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
