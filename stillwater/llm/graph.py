"""Connected components of a graph that no single machine holds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``a, b`` (numbers) to ``node, component``: the smallest node that can be reached.

    Every round gives each node the smallest label among its own and its neighbours', then the label of that label
    (which halves long ways). Labels are stored after every round; the rounds end when none changes.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    for _ in range(most_rounds):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("_near")))
        better = labels.join(near, "node").select("node", F.least("component", "_near").alias("_to"), F.col("component").alias("_was"))
        onward = labels.select(F.col("node").alias("_to"), F.col("component").alias("_next"))
        moved = stored(better.join(onward, "_to", "left").select(
            "node", F.coalesce(F.least("_to", "_next"), F.col("_to")).alias("component"), "_was"), "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> _was").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
