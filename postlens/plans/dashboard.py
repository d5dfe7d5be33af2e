"""The dashboard's views, computed from one narrow table of post facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.operators import activity as A
from postlens.operators import similarity, summary
from postlens.operators.posts import label_posts
from postlens.sources.staging import stage, staging_path
from postlens.sources.views import VIEWS, dashboard_path, write_view

_ORDER = {
    "dashboard_time_dep": ("day", "hour"),
    "dashboard_time_ctrl": ("day", "hour"),
}

# One row per subject, so written by as many tasks as compute it.
_LARGE = ("dashboard_scatter",)


def post_facts(posts: DataFrame) -> DataFrame:
    """What the views need of a post, without its text: ``(subject_id, [label], date, word_count)``."""
    label = ["label"] if "label" in posts.columns else []
    words = text.word_count(text.normalized(F.col("text")))
    return posts.select("subject_id", *label, "date", words.alias("word_count"))


def stage_facts(posts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Facts of labelled posts, written once and read back for all views.

    With ``labels``, words are counted in front of the join, which then moves no text.
    """
    facts = post_facts(posts)
    if labels is not None:
        facts = label_posts(facts, labels)
    return stage(facts, staging_path(posts.sparkSession, "facts"))


def post_views(facts: DataFrame) -> dict[str, DataFrame]:
    """The views that need posts only; the verbosity view has a row per subject, the others few."""
    cells = A.activity(facts)
    totals = summary.subject_totals(facts)
    return {
        "dashboard_kpi": summary.kpi(totals),
        "dashboard_time_dep": A.heatmap(cells, 1),
        "dashboard_time_ctrl": A.heatmap(cells, 0),
        "dashboard_scatter": summary.subject_verbosity(totals),
    }


def metrics_view(metrics: DataFrame) -> DataFrame:
    """The F1 score alone: dashboards read the view's first row."""
    return metrics.where(F.col("metric_name") == "f1_score").select(
        "metric_name", F.col("value").cast("float").alias("value")
    )


def semantic_view(neighbours: DataFrame, n: int = 50) -> DataFrame:
    """Similar words over all seeds: ``(word, similarity float)``."""
    return similarity.best_neighbours(neighbours, "word", n).select(
        "word", F.col("similarity").cast("float").alias("similarity")
    )


def write_views(views: dict[str, DataFrame], folder: str) -> None:
    for name, df in views.items():
        fmt = VIEWS[name][0]
        by_similarity = (F.desc("similarity"), "word")
        order = by_similarity if name == "dashboard_semantic_words" else _ORDER.get(name, ())
        write_view(df, dashboard_path(folder, name), fmt, order, single=name not in _LARGE)
