"""Connected components of a large graph by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): the smallest node it reaches.

    Each round a node takes the smallest label among its neighbours, and then the label of
    the node that its label names; every round is stored, so a lost executor costs one read.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
                     .select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        lower = (labels.join(near, labels["node"] == near["a"])
                 .select("node", F.col("label").alias("before"), F.least("label", "near").alias("lower")))
        up = labels.select(F.col("node").alias("lower"), F.col("label").alias("up"))
        after = written(lower.join(up, "lower").select("node", "before", F.least("lower", "up").alias("label")),
                        "labels")
        labels = after.select("node", "label")
        if after.where(F.col("before") != F.col("label")).isEmpty():
            return labels
