"""Classification quality from a confusion matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "f1_score", "weighted_precision", "weighted_recall")


def confusion(predictions: DataFrame) -> DataFrame:
    """``(label, prediction, count)``; combinations that do not occur give no row."""
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("count"))


def classification_metrics(matrix: DataFrame) -> DataFrame:
    """``(metric_name, value)`` for accuracy and the support-weighted F1, precision and recall.

    All four come from one pass over the predictions.  Each cell is counted once for its
    label and once for its prediction, which gives a class's totals without a join.
    """
    n = F.col("count")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    role = lambda cls, support, predicted, hits: F.struct(
        F.col(cls).cast("double").alias("cls"),
        support.alias("support"),
        predicted.alias("predicted"),
        hits.alias("hits"),
    )
    zero = F.lit(0).cast("bigint")
    classes = (
        matrix.select(
            F.inline(
                F.array(
                    role("label", n, zero, hit.cast("bigint")),
                    role("prediction", zero, n, zero),
                )
            )
        )
        .groupBy("cls")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    scored = classes.select("support", "hits", precision.alias("p"), recall.alias("r")).withColumn(
        "f", F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    )
    total = F.sum("support")
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), total)
    row = scored.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        weighted("f").alias("f1_score"),
        weighted("p").alias("weighted_precision"),
        weighted("r").alias("weighted_recall"),
    )
    return row.unpivot([], list(METRICS), "metric_name", "value")
