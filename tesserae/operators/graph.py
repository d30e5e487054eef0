"""Connected components of edges by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def components(edges: DataFrame, src: str = "src", dst: str = "dst", nodes: DataFrame | None = None) -> DataFrame:
    """node and component: the least node that is reachable. nodes (column node) adds those without edges.

    Every round takes the least label of the neighbours and then the label of that label, so that paths halve. Rounds
    are checkpointed; the number of rounds is about the logarithm of the longest path.
    """
    both = cut(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).union(edges.select(F.col(dst), F.col(src))).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    if nodes is not None:
        labels = nodes.select("node").distinct().join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    labels = cut(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        step = cut(step.join(jump, "via").select("node", "old", F.least("via", "far").alias("component")))
        done = step.filter("component < old").limit(1).count() == 0
        labels = step.select("node", "component")
        if done:
            return labels
