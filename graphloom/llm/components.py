"""Connected components of a graph given as links, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node that has a link.

    Each round takes the least label among neighbours (pre-aggregated) and then
    the label of one's label; it ends when no label changes.  Hot nodes meet
    their neighbours in joins that AQE splits.  Nodes are long and not null.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = materialise(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least"))
    labels = materialise(labels.select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        told = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("component").alias("heard"))
        nearer = labels.join(told, F.col("node") == F.col("x")).select("node", F.col("component").alias("was"), F.least("component", "heard").alias("component"))
        onward = labels.select(F.col("node").alias("at"), F.col("component").alias("onward"))
        step = nearer.join(onward, F.col("component") == F.col("at")).select("node", "was", F.least("component", "onward").alias("component"))
        step = materialise(step, "labels")
        labels = step.select("node", "component")
        if not step.where("was <> component").limit(1).count():
            return labels
