"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.sources.staging import stage, staging_path


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for all nodes of ``links (a, b)``; the label is the component's smallest node.

    A round gives every node the smallest label around it and then that label's own label.
    Each round is written, so lost executors repeat one round at most.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), staging_path(spark, "links"))
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), staging_path(spark, "labels"))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # A label is a node of the same component, so its own label is one too.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = moved.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        moved = stage(moved, staging_path(spark, "labels"))
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels
