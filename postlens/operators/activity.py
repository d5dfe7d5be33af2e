"""Posting activity by weekday and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import calendar


def activity(posts: DataFrame, labels: DataFrame | None = None, ts: str = "date") -> DataFrame:
    """Posts per class, weekday and hour: ``(label, day, hour, count)``.

    One pass serves the views of all classes.  Posts without a date form the group with
    NULL day and hour.  With ``labels``, posts are first counted per subject and cell, so
    that a subject reaches the join in 169 rows at most; without, they must hold their
    label.
    """
    cell = (calendar.day(F.col(ts)).alias("day"), calendar.hour(F.col(ts)).alias("hour"))
    if labels is None:
        return posts.groupBy("label", *cell).agg(F.count("*").alias("count"))
    per_subject = posts.groupBy("subject_id", *cell).agg(F.count("*").alias("count"))
    return (
        per_subject.join(labels, "subject_id", "inner")
        .groupBy("label", "day", "hour")
        .agg(F.sum("count").alias("count"))
    )


def heatmap(cells: DataFrame, label: int) -> DataFrame:
    """One class of :func:`activity`, ordered by weekday and hour."""
    return cells.where(F.col("label") == label).select("day", "hour", "count").orderBy("day", "hour")


def heatmap_grid(
    cells: DataFrame,
    labels: Sequence[int] = (0, 1),
    day_names: Sequence[str] = calendar.DAY_NAMES,
) -> DataFrame:
    """All 7 x 24 cells per class, 0 where nothing was posted: ``(label, day, day_name, hour, count)``.

    The empty grid is added as zero counts and summed, which needs no join.
    """
    spark = cells.sparkSession
    cell = F.col("id") % 168
    empty = spark.range(168 * len(labels)).select(
        F.get(F.array(*[F.lit(v) for v in labels]), (F.col("id") / 168).cast("int")).alias("label"),
        ((cell / 24).cast("int") + 1).alias("day"),
        (cell % 24).cast("int").alias("hour"),
        F.lit(0).cast("bigint").alias("count"),
    )
    known = cells.where(F.col("day").isNotNull() & F.col("label").isin(list(labels)))
    return (
        known.unionByName(empty)
        .groupBy("label", "day", "hour")
        .agg(F.sum("count").alias("count"))
        .select("label", "day", calendar.day_name(F.col("day"), day_names).alias("day_name"), "hour", "count")
    )


def heatmap_matrix(grid: DataFrame) -> DataFrame:
    """Wide form of a grid: one row per class and weekday, one column per hour ``h0`` .. ``h23``."""
    hours = [F.sum(F.when(F.col("hour") == h, F.col("count"))).alias(f"h{h}") for h in range(24)]
    return grid.groupBy("label", "day", "day_name").agg(*hours)


def hourly_share(cells: DataFrame) -> DataFrame:
    """Share of a class's dated posts per hour of the day: ``(label, hour, count, share)``."""
    per_hour = (
        cells.where(F.col("hour").isNotNull()).groupBy("label", "hour").agg(F.sum("count").alias("count"))
    )
    # At most 24 rows per class reach the window.
    total = F.sum("count").over(Window.partitionBy("label"))
    return per_hour.withColumn("share", F.col("count") / total)
