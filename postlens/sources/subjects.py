"""Nested subject documents in XML: ``<INDIVIDUAL>`` with an ID and repeated ``<WRITING>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.sources import markup

# Element names of the input format.
ROW_TAG = "INDIVIDUAL"
WRITING_FIELDS = ("TITLE", "DATE", "INFO", "TEXT")

CORRUPT = "_corrupt_record"

# Why a record is rejected.
UNCLOSED, MALFORMED = "no closing tag", "not well-formed"

# White space around a value is content; flattening trims the spaces of it.
_XML_OPTIONS = {"ignoreSurroundingSpaces": "false"}


def subject_schema(fields: Sequence[str] = WRITING_FIELDS, corrupt: bool = False) -> T.StructType:
    """Explicit schema.  Inference would read subjects with one writing as a struct, not an array."""
    writing = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    schema = T.StructType(
        [T.StructField("ID", T.StringType()), T.StructField("WRITING", T.ArrayType(writing))]
    )
    return schema.add(CORRUPT, T.StringType()) if corrupt else schema


# What follows the name in an opening tag: its end, or white space and an attribute.  A file's
# text in front of its first record, and longer tag names, do not continue like this.
_TAG_GOES_ON = r"^\s*(?:/?>|[A-Za-z_:][^\s=<>]*\s*=)"


def _records(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """One row per opening tag: ``(text, reason, file, record)``, unparsed.

    The opening tag is the record separator of a plain text scan.  The scan therefore
    splits large files, a malformed record cannot hide the records behind it, which the
    whole-file XML reader loses, and a record without closing tag is seen: every opening
    tag gives a row, unless it stands in a CDATA section or a comment (see ``markup``).
    ``record`` is a key of the record, made of its file and text.
    """
    tag = f"<{ROW_TAG}"
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), encoding)
    pieces = spark.read.option("lineSep", tag).text(path).select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    )
    value, closed = F.col("value"), F.col("closed")
    single = F.regexp_extract(value, r"^[^<>]*/>", 0)
    text = (
        F.when(single != "", F.concat(F.lit(tag), single))
        .when(closed.isNotNull(), F.concat(F.lit(tag), closed, F.lit(f"</{ROW_TAG}>")))
        .otherwise(F.concat(F.lit(tag), value))
    )
    unclosed = closed.isNull() & (single == "")
    # A column of its own is cut once for all its uses.
    whole = markup.whole_pieces(pieces, tag).where(value.rlike(_TAG_GOES_ON))
    return whole.withColumn("closed", markup.cut(value, rf"</{ROW_TAG}\s*>")).select(
        text.alias("text"),
        F.when(unclosed, F.lit(UNCLOSED)).alias("reason"),
        "file",
        F.xxhash64("file", value).alias("record"),
    )


def read_subjects_xml(
    spark: SparkSession,
    path: str | list[str],
    fields: Sequence[str] = WRITING_FIELDS,
    corrupt: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Subjects ``(ID, WRITING, chunk, file, record)`` from a path, list of paths or glob such as ``data/chunk*/*.xml``.

    ``fields`` names the writing fields to parse; leave out those not needed.  Malformed and
    unclosed records are left out here and listed by :func:`subject_rejects`; with
    ``corrupt`` they stay as rows that only fill ``_corrupt_record`` and ``reason``.  Record
    tags in CDATA sections and comments are text, wherever the file is split.
    ``encoding`` is one in which the tags have the same bytes as in ASCII.  A path that does
    not exist raises.
    """
    # The generator keeps Catalyst from copying from_xml into the filters that follow it, on
    # the id or the corrupt record, each of which would parse every record again.
    subject = F.from_xml("text", subject_schema(fields, corrupt=True), _XML_OPTIONS)
    chunk = F.regexp_extract("file", r"chunk(\d+)[^/]*/[^/]*$", 1).try_cast("int")
    rows = _records(spark, path, encoding).select(
        F.inline_outer(F.array(subject)), chunk.alias("chunk"), "file", "record", "reason", "text"
    )
    # A parser may accept what has no closing tag; it is rejected all the same.
    reason = F.coalesce("reason", F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)))
    bad = F.col("reason").isNotNull()
    rows = rows.withColumn("reason", reason).select(
        F.when(~bad, F.col("ID")).alias("ID"), F.when(~bad, F.col("WRITING")).alias("WRITING"),
        "chunk", "file", "record", F.when(bad, F.col("text")).alias(CORRUPT), "reason",
    )
    return rows if corrupt else rows.where(F.col("reason").isNull()).drop(CORRUPT, "reason")


def rejects(subjects: DataFrame) -> DataFrame:
    """Of subjects read with ``corrupt``, the records that could not be read: ``(record, file, reason)``."""
    return subjects.where(F.col("reason").isNotNull()).select(F.col(CORRUPT).alias("record"), "file", "reason")


def accepted(subjects: DataFrame) -> DataFrame:
    """Of subjects read with ``corrupt``, the others."""
    return subjects.where(F.col("reason").isNull()).drop(CORRUPT, "reason")


def subject_rejects(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Records without closing tag or not well-formed: ``(record, file, reason)``."""
    return rejects(read_subjects_xml(spark, path, corrupt=True, encoding=encoding))


def write_subjects_xml(subjects: DataFrame, path: str) -> None:
    """Write ``(ID, WRITING)`` rows in the input format."""
    (
        subjects.select("ID", "WRITING")
        .write.format("xml")
        .option("rootTag", "SUBJECTS")
        .option("rowTag", ROW_TAG)
        .save(path)
    )
