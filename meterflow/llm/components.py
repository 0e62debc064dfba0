"""Connected components of a graph given as edges, by joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b: two columns of whole numbers); component is the smallest node reachable.

    Each round every node looks at its neighbours' labels and takes the smallest, then takes the label of its
    label (which halves the length of chains). Rounds end when no label changes. An empty
    graph has no rows. Repeated edges and loops do no harm; an edge with a missing end does not count.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = stored(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = stored(low.select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").select(F.col("a").alias("node"), "component")
        least = near.union(labels).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = (
            least.join(jump, "component", "left")
            .select("node", F.least("component", "further").alias("component"))
            .join(labels.withColumnRenamed("component", "before"), "node")
        )
        moved = stored(moved, "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> before").isEmpty():
            return labels
