"""Parquet tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, read in the splits that its files and the session's settings give."""
    return spark.read.parquet(path)
