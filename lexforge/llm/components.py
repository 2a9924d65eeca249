"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.shared import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); the component is its smallest node.

    Rounds of taking the smallest label among neighbours, then the label of that label,
    until none changes: the rounds grow with the logarithm of the longest path. Each
    round is written to the shared folder; nothing but a count reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    both = settle(both, "edges")
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        least = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        moved = settle(least.join(jump, "new", "left").select("node", "old", F.least("new", "next").alias("label")), "labels")
        labels = moved.select("node", "label")
        if not moved.where("label != old").limit(1).count():
            return labels.withColumnRenamed("label", "component")
