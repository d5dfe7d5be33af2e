"""Most frequent words per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.functions.stopwords import REPORT_STOP_WORDS


def word_frequency(
    labelled: DataFrame,
    col: str = "text",
    min_len: int = 3,
    stop_words: Sequence[str] | DataFrame = REPORT_STOP_WORDS,
) -> DataFrame:
    """``(label, word, count)`` of the lowercased text's words of ``min_len`` characters or more.

    ``stop_words`` is a list, or a table with a column ``word``.  A list filters the tokens;
    a table is anti-joined after counting, so that only distinct words take part.
    """
    words = labelled.select("label", F.explode(text.pieces(F.lower(col))).alias("word")).where(
        F.length("word") >= max(min_len, 1)
    )
    as_table = isinstance(stop_words, DataFrame)
    if not as_table and stop_words:
        words = words.where(~F.col("word").isin(list(stop_words)))
    counts = words.groupBy("label", "word").agg(F.count("*").alias("count"))
    return counts.join(stop_words, "word", "left_anti") if as_table else counts


def top_words(
    labelled: DataFrame,
    col: str = "text",
    min_len: int = 3,
    n: int = 100,
    stop_words: Sequence[str] | DataFrame = REPORT_STOP_WORDS,
) -> DataFrame:
    """The ``n`` most frequent words of every class, ties by word: ``(label, word, count)``.

    The rank filter lets Spark keep ``n`` rows per class in each task before the shuffle
    by class.
    """
    ranked = Window.partitionBy("label").orderBy(F.desc("count"), F.asc("word"))
    return (
        word_frequency(labelled, col, min_len, stop_words)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= n)
        .select("label", "word", "count")
    )
