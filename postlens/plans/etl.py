"""Read, flatten, label, clean and tokenize posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.operators import posts as P
from postlens.sources.labels import read_labels
from postlens.sources.subjects import WRITING_FIELDS, read_subjects_xml


# What tells the records of a subject apart.
RECORD = ("chunk", "file", "record")


def read_posts(
    spark: SparkSession,
    posts_path: str | list[str],
    fields: Sequence[str] = WRITING_FIELDS,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Flat posts of XML files: ``(subject_id, chunk, file, record, pos, …)``, parsing only ``fields``."""
    return P.flatten_posts(read_subjects_xml(spark, posts_path, fields, encoding=encoding), keep=RECORD)


def read_labelled_posts(
    spark: SparkSession,
    posts_path: str | list[str],
    labels_path: str | list[str],
    fields: Sequence[str] = WRITING_FIELDS,
    encoding: str = "UTF-8",
) -> DataFrame:
    """:func:`read_posts` of labelled subjects, with their label."""
    subjects = read_subjects_xml(spark, posts_path, fields, encoding=encoding)
    return flatten_labelled(subjects, read_labels(spark, labels_path), RECORD)


def flatten_labelled(
    subjects: DataFrame, labels: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Labelled posts, joined before flattening: fewer rows to join, fewer records to flatten."""
    labelled = P.label_posts(subjects, labels.withColumnRenamed("subject_id", "ID"), "ID")
    return P.flatten_posts(labelled, (*keep, "label"))


def process(labelled: DataFrame) -> DataFrame:
    """Adds ``clean_text``, its ``words``, and ``filtered_words`` without English stop words."""
    cleaned = P.tokens(P.clean_text(labelled), "clean_text")
    stops = [w for w in text.english_stop_words() if w]
    return cleaned.withColumn("filtered_words", F.filter("words", lambda w: ~w.isin(stops)))


def normalized_text(labelled: DataFrame) -> DataFrame:
    """Text as the models and the word counts see it: trimmed and lowercased."""
    return labelled.withColumn("text", text.normalized(F.col("text")))
