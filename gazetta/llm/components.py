"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of links (a, b).

    In each round a node takes the smallest label of its neighbours and itself, then the label of
    that label; rounds end when no label changes. Labels are cut after each round. Least labels
    are pre-aggregated, so a hub of many links costs one row for each task.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = stepped.join(labels.select(F.col("node").alias("label"), F.col("label").alias("far")), "label", "left")
        fresh = cut(jumped.select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        changed = not fresh.where("old <> label").isEmpty()
        labels = fresh.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
