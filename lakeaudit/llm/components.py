"""Connected components by label propagation with pointer jumping.

All joins are between written tables, so adaptive execution splits the partitions of hubs and of giant components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of links ``a, b``; a component is named by its smallest node.

    A round takes the smallest label among a node's neighbours, then the label of the label, so the number of rounds grows
    with the logarithm of the longest path. Links may repeat, point both ways or to themselves. No links, no rows.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    edges = written(both.unionByName(both.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct())
    labels = written(edges.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("component")))
    while True:
        of_near = labels.select(F.col("node").alias("near"), "component")
        lower = edges.join(of_near, "near").groupBy("node").agg(F.min("component").alias("least"))
        lower = written(labels.join(lower, "node").select("node", F.least("component", "least").alias("component"), F.col("component").alias("was")))
        roots = lower.select(F.col("node").alias("component"), F.col("component").alias("root"))
        fresh = written(lower.join(roots, "component").select("node", F.col("root").alias("component"), "was"))
        discard(labels, lower)
        labels = fresh
        if not fresh.where("component != was").limit(1).count():
            discard(edges)
            return labels.drop("was")
