"""Label lines: ``<subject id><white space><class>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _parsed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    parts = F.split("value", r"\s+")
    return spark.read.text(path).select(
        "value",
        F.get(parts, F.lit(0)).alias("subject_id"),
        F.get(parts, F.lit(1)).try_cast("int").alias("label"),
    )


def _valid() -> Column:
    return (F.col("subject_id") != "") & F.col("label").isNotNull()


def read_labels(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(subject_id, label)`` of the lines that hold both."""
    return _parsed(spark, path).where(_valid()).select("subject_id", "label")


def label_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that :func:`read_labels` leaves out, as ``value``."""
    return _parsed(spark, path).where(~_valid()).select("value")
