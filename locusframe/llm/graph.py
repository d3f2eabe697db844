"""Connected components over an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is its component's smallest node.

    A round takes the least label around every node and then the label's label, so
    long paths halve. Each round is written; nothing but one flag reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        near = labels.join(around, "node").select("node", "root", F.least("root", "m").alias("m"))
        far = labels.select(F.col("node").alias("m"), F.col("root").alias("r"))
        new = near.join(far, "m", "left").select("node", F.least("m", F.coalesce("r", "m")).alias("root"), F.col("root").alias("was"))
        new = written(new, "labels")
        labels = new.select("node", "root")
        if new.where("root <> was").limit(1).count() == 0:
            return labels
