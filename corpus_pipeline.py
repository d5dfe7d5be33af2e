"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept;
its result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import decontaminate, packing, quality, secret_scan, shingle_join
from postlens.llm.queries import table, tokenizer_path
from postlens.sources.staging import stage, staging_path


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; sites are sources, paths their languages."""
    model = quality.fit(docs, quality.bad_labels(table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    return shingle_join.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by the name of the rule."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", reject_bad),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]

# A trained classifier and a packing plan are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all of ``documents`` that pass the filters."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), staging_path(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
