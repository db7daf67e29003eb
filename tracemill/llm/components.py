"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.sources.staging import release, stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of ``links (a, b)``; the smallest node names it.

    Every round each node takes the smallest label around it, and then the label of
    its label, so labels travel along paths in steps that double. Each round is a
    stored table; the number of rounds grows with the logarithm of a path's length.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(edges.distinct(), "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("b"))
    labels = stage(labels.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("new")
        )
        onward = labels.select(F.col("node").alias("new"), F.col("component").alias("next"))
        jumped = lower.join(onward, "new").select(
            "node", "old", F.least("new", "next").alias("component")
        )
        jumped = stage(jumped, "labels")
        release(labels)
        labels = jumped.select("node", "component")
        if jumped.filter(F.col("old") != F.col("component")).isEmpty():
            release(edges)
            return labels
