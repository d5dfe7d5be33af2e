"""Views: small result tables on disk, the interface between batch jobs and a dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Names, formats and columns of the dashboard's views.
VIEWS = {
    "dashboard_kpi": ("csv", "total_posts bigint, risk_ratio double, avg_length double"),
    "dashboard_time_dep": ("parquet", "day int, hour int, count bigint"),
    "dashboard_time_ctrl": ("parquet", "day int, hour int, count bigint"),
    "dashboard_scatter": ("parquet", "subject_id string, label int, avg_len double"),
    "dashboard_metrics": ("csv", "metric_name string, value float"),
    "dashboard_semantic_words": ("csv", "word string, similarity float"),
}


def write_view(df: DataFrame, path: str, fmt: str, order_by: Sequence = (), single: bool = True) -> None:
    """Overwrite ``path`` with ``df``, CSV with a header or Parquet; as one file if ``single``.

    ``repartition(1)`` and not ``coalesce(1)``: the latter would pull the computation in
    front of it into the single writing task.  Only for results of a bounded size; others
    are written with ``single=False``.
    """
    one = df.repartition(1) if single else df
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    writer = one.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown view format: {fmt}")


def read_view(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType) -> DataFrame:
    """Read all files of a view with an explicit schema.  A missing view raises."""
    if fmt == "csv":
        return spark.read.schema(schema).csv(path, header=True)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown view format: {fmt}")


def dashboard_path(folder: str, name: str) -> str:
    """Parquet views carry their format in the folder's name, CSV views do not."""
    suffix = ".parquet" if VIEWS[name][0] == "parquet" else ""
    return f"{folder.rstrip('/')}/{name}{suffix}"


def read_dashboard_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    fmt, schema = VIEWS[name]
    return read_view(spark, dashboard_path(folder, name), fmt, schema)
