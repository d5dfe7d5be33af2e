"""Counts and KPIs, all derived from one row of totals per subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subject_totals(posts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``(subject_id, label, posts, words, counted)``; the last two if posts have a ``word_count``.

    ``counted`` is the number of posts whose word count is known.  With ``labels``, posts
    are reduced to one row per subject before the join: it moves no text, and a prolific
    subject reaches it as a single row.  Without, the posts must hold their label.
    """
    sums = [F.count("*").alias("posts")]
    if "word_count" in posts.columns:
        sums += [F.sum("word_count").alias("words"), F.count("word_count").alias("counted")]
    if labels is None:
        return posts.groupBy("subject_id", "label").agg(*sums)
    totals = posts.groupBy("subject_id").agg(*sums)
    return totals.join(labels, "subject_id", "inner").select(
        "subject_id", "label", *totals.columns[1:]
    )


def _count(condition: Column | None = None) -> Column:
    """Posts of the subjects that meet ``condition``."""
    posts = F.col("posts") if condition is None else F.when(condition, F.col("posts"))
    return F.coalesce(F.sum(posts), F.lit(0))


def _mean_length() -> Column:
    return F.try_divide(F.sum("words"), F.sum("counted"))


def class_counts(totals: DataFrame) -> DataFrame:
    """Total, class 1 and the rest in one pass: ``(total_posts, class1_posts, control_posts)``."""
    class1 = _count(F.col("label") == 1)
    return totals.agg(
        _count().alias("total_posts"),
        class1.alias("class1_posts"),
        (_count() - class1).alias("control_posts"),
    )


def class_imbalance(subjects: DataFrame) -> DataFrame:
    """Of one row per subject: ``(n_rows, n_class1, n_class0, imbalance_pct)``.

    The percentage is NULL without controls.
    """
    n1 = F.count_if(F.col("label") == 1)
    n0 = F.count_if(F.col("label") == 0)
    return subjects.agg(
        F.count("*").alias("n_rows"),
        n1.alias("n_class1"),
        n0.alias("n_class0"),
        (F.try_divide(n1, n0) * 100).alias("imbalance_pct"),
    )


def kpi(totals: DataFrame) -> DataFrame:
    """One row ``(total_posts, risk_ratio, avg_length)``: posts, mean label, mean word count."""
    labelled_posts = _count(F.col("label").isNotNull())
    return totals.agg(
        _count().alias("total_posts"),
        F.try_divide(F.sum(F.col("label") * F.col("posts")), labelled_posts).alias("risk_ratio"),
        _mean_length().alias("avg_length"),
    )


def kpi_by_class(totals: DataFrame) -> DataFrame:
    """``(label, total_posts, avg_length)``."""
    return totals.groupBy("label").agg(_count().alias("total_posts"), _mean_length().alias("avg_length"))


def kpi_cards(kpi_row: DataFrame, metrics: DataFrame, metric: str = "f1_score") -> DataFrame:
    """The KPI row plus the model's metric, 0.0 when it has not been computed."""
    value = (
        metrics.where(F.col("metric_name") == metric)
        .agg(F.max("value").cast("double").alias("value"))
        .scalar()
    )
    return kpi_row.withColumn(metric, F.coalesce(value, F.lit(0.0)))


def subject_verbosity(totals: DataFrame, n: int | None = None) -> DataFrame:
    """Mean word count of every subject's posts: ``(subject_id, label, avg_len)``; with ``n``, the first by id."""
    rows = totals.select("subject_id", "label", F.try_divide("words", "counted").alias("avg_len"))
    return rows if n is None else rows.orderBy("subject_id", "label").limit(n)
