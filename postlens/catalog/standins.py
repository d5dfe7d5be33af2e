"""The data model's tables, derived from the given ones.

subject = document, writing = line of its text, label = ``labels.toxic``, posting time =
``events`` of the user with the document's id, ordered texts = ``conversations``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators import posts as P
from postlens.operators.summary import subject_totals
from postlens.plans.etl import flatten_labelled, normalized_text
from postlens.sources import staging
from postlens.sources.subjects import WRITING_FIELDS
from postlens.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _date_text(pos: Column) -> Column:
    """Dates that vary with document and line; hours 24 to 29 are no time of day."""
    return F.format_string(
        "2024-01-%02d %02d:30:00", (pos % 28 + 1).cast("int"), (F.col("doc_id") % 30).cast("int")
    )


def subjects(
    spark: SparkSession, sf_dir: str, fields: Sequence[str] = WRITING_FIELDS
) -> DataFrame:
    """Nested subjects ``(ID bigint, WRITING)`` with the given writing fields."""
    values = {
        "TITLE": lambda line, pos: F.col("lang"),
        "DATE": lambda line, pos: _date_text(pos),
        "INFO": lambda line, pos: F.col("source"),
        "TEXT": lambda line, pos: line,
    }
    writing = lambda line, pos: F.struct(*[values[f](line, pos).alias(f) for f in fields])
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("ID"), F.transform(F.split("text", "\n"), writing).alias("WRITING")
    )


def posts(spark: SparkSession, sf_dir: str, fields: Sequence[str] = ("TEXT",)) -> DataFrame:
    return P.flatten_posts(subjects(spark, sf_dir, fields))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("subject_id"), F.col("toxic").alias("label")
    )


def labelled(spark: SparkSession, sf_dir: str, fields: Sequence[str] = ("TEXT",)) -> DataFrame:
    return flatten_labelled(subjects(spark, sf_dir, fields), labels(spark, sf_dir))


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(subject_id, word_count)`` per post, labelled or not."""
    return P.word_count(posts(spark, sf_dir)).select("subject_id", "word_count")


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subject_totals(word_counts(spark, sf_dir), labels(spark, sf_dir))


def training_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled posts with normalized text, stored for the passes that a fit makes."""
    return staging.stage(normalized_text(labelled(spark, sf_dir)), staging.staging_path(spark, "posts"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, text)``: whole texts of labelled subjects."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    own = labels(spark, sf_dir).withColumnRenamed("subject_id", "doc_id")
    return P.label_posts(docs, own, "doc_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting times: ``(subject_id, date)``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject_id"), F.col("ts").alias("date")
    )
