"""Vocabulary, term counts, IDF and TF-IDF as relations.

A document is identified by key columns and may be spread over many rows (posts).  All
grouping is by (document, word) or by word, both with partial aggregation, so neither a
long document nor a frequent word gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import text

# Words whose weights are sent to the tasks; any others are joined.
HEAD_WORDS = 500_000


def _wanted(stop_words: Sequence[str]) -> Column:
    """Whether ``word`` is a word, and none of ``stop_words``."""
    wanted = F.col("word") != ""
    if stop_words:
        wanted = wanted & ~F.col("word").isin([w.lower() for w in stop_words if w])
    return wanted


def term_counts(df: DataFrame, keys: Sequence[str], words: str = "words") -> DataFrame:
    """``(*keys, word, n)`` from rows with a token array."""
    # An inner explode would make Catalyst tokenize once more, to test for empty arrays first.
    return (
        df.select(*keys, F.explode_outer(words).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy(*keys, "word")
        .agg(F.count("*").alias("n"))
    )


def text_words(
    df: DataFrame,
    keys: Sequence[str],
    col: str = "text",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
    keep_wordless: bool = False,
) -> DataFrame:
    """``(*keys, word)``: a row per occurrence of a word in a text, without ``stop_words``.

    Split, explode and filter stay in generated code, where filtering an array would not.
    With ``keep_wordless``, empty pieces and stop words are rows of word NULL, so that every
    document has a row.
    """
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    words = df.select(*keys, F.explode(text.pieces(lowered, pattern)).alias("word"))
    if keep_wordless:
        return words.withColumn("word", F.when(_wanted(stop_words), F.col("word")))
    return words.where(_wanted(stop_words))


def text_term_counts(
    df: DataFrame,
    keys: Sequence[str],
    col: str = "text",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
    keep_wordless: bool = False,
) -> DataFrame:
    """:func:`term_counts` straight from text: ``(*keys, word, n)``; see :func:`text_words`."""
    words = text_words(df, keys, col, pattern, stop_words, keep_wordless)
    return words.groupBy(*keys, "word").agg(F.count("*").alias("n"))


def row_counts(
    docs: DataFrame,
    keys: Sequence[str],
    col: str = "text",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """:func:`text_term_counts` of text whose every row is a whole document.

    A row's words are sorted and runs of equal ones counted in the task that reads it, so
    nothing is shuffled.
    """
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    # Generators keep Catalyst from copying the arrays into every use of them.
    one = lambda array, name: F.explode(F.array(array)).alias(name)
    words = docs.select(*keys, one(F.sort_array(text.pieces(lowered, pattern)), "_words"))
    at = lambda i: F.get("_words", i)
    ends = F.filter(F.sequence(F.lit(1), F.size("_words")), lambda i: ~at(i).eqNullSafe(at(i - 1)))
    runs = words.select(*keys, "_words", one(ends, "_ends"))
    run = F.transform("_ends", lambda end, k: F.struct(
        at(end - 1).alias("word"), (end - F.coalesce(F.get("_ends", k - 1), F.lit(0))).cast("bigint").alias("n")
    ))
    return runs.select(*keys, F.inline(run)).where(_wanted(stop_words))


def document_term_counts(
    docs: DataFrame,
    keys: Sequence[str],
    col: str = "text",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """:func:`text_term_counts`, without its shuffle of words if no two rows have the same ``keys``."""
    repeated = docs.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    count = row_counts if repeated.isEmpty() else text_term_counts
    return count(docs, keys, col, pattern, stop_words)


def word_statistics(counts: DataFrame) -> DataFrame:
    """``(word, df, n)``: documents that hold the word, and occurrences."""
    return counts.groupBy("word").agg(F.count("*").alias("df"), F.sum("n").alias("n"))


def document_count(docs: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row ``(n_docs)``.  Give ``keys`` when a document has several rows."""
    rows = docs.select(*keys).distinct() if keys else docs
    return rows.agg(F.count("*").alias("n_docs"))


def row_word_statistics(
    docs: DataFrame,
    col: str = "text",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """:func:`word_statistics` straight from text whose every row is a whole document.

    A row's words are followed by its distinct words, which count documents.  The only
    shuffle is by word, after partial aggregation; none is by document.
    """
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    listed = docs.select(text.pieces(lowered, pattern).alias("_words")).select(
        F.size("_words").alias("_length"),
        F.posexplode(F.concat("_words", F.array_distinct("_words"))).alias("_pos", "word"),
    )
    is_distinct = F.col("_pos") >= F.col("_length")
    return (
        listed.where(_wanted(stop_words))
        .groupBy("word")
        .agg(F.count_if(is_distinct).alias("df"), F.count_if(~is_distinct).alias("n"))
    )


def row_term_counts(
    docs: DataFrame,
    keys: Sequence[str],
    vocab_words: Sequence[str],
    col: str = "text",
    pattern: str = text.NON_WORD,
) -> DataFrame:
    """Counts of vocabulary words, every row being a whole document: ``(*keys, word, n)``.

    The counting is the row-local ``CountVectorizerModel``, so nothing is shuffled.
    ``vocab_words`` is a list of a model's size (``vocab_size``), and is sent to the tasks.
    """
    lowered = F.lower(F.coalesce(F.col(col), F.lit("")))
    model = CountVectorizerModel.from_vocabulary(
        list(vocab_words), inputCol="_words", outputCol="_counts"
    )
    counted = model.transform(docs.select(*keys, text.pieces(lowered, pattern).alias("_words")))
    vector = F.unwrap_udt("_counts")
    entries = counted.select(
        *keys, F.inline(F.arrays_zip(vector["indices"].alias("index"), vector["values"].alias("n")))
    )
    vocab = docs.sparkSession.createDataFrame(list(enumerate(vocab_words)), "index int, word string")
    return entries.join(F.broadcast(vocab), "index").select(
        *keys, "word", F.col("n").cast("bigint").alias("n")
    )


def vocabulary(
    statistics: DataFrame,
    n_docs: DataFrame,
    size: int | None = None,
    min_df: float = 5.0,
    max_df: float = 0.75,
) -> DataFrame:
    """The words whose ``df`` lies within both bounds: ``(word, df, n)``; with ``size``, the most frequent of them.

    ``statistics`` is the result of :func:`word_statistics` or :func:`row_word_statistics`.
    Bounds are inclusive.  From 1 up they are document counts, below 1 a share of all
    documents.  Equal counts are ordered by word.
    """
    docs = n_docs.scalar()
    low = F.lit(min_df) if min_df >= 1 else docs * min_df
    high = F.lit(max_df) if max_df >= 1 else docs * max_df
    rows = statistics.where((F.col("df") >= low) & (F.col("df") <= high))
    return rows if size is None else rows.orderBy(F.desc("n"), "word").limit(size)


def vocabulary_head_tail(vocab: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most and the ``n`` least frequent vocabulary words: ``(part, word, df, n)``."""
    head = vocab.orderBy(F.desc("n"), "word").limit(n).select(F.lit("head").alias("part"), "*")
    tail = vocab.orderBy(F.asc("n"), F.desc("word")).limit(n).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


def idf_weight(df: Column, n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1))


def idf(vocab: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(word, df, idf)``."""
    return vocab.select("word", "df", idf_weight(F.col("df"), n_docs.scalar()).alias("idf"))


def tfidf(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """Counts of vocabulary words, weighted by the result of :func:`idf`: adds ``idf`` and ``tfidf``."""
    return counts.join(weights.select("word", "idf"), "word").withColumn("tfidf", F.col("n") * F.col("idf"))


def tfidf_by_head(counts: DataFrame, weights: DataFrame, head: int = HEAD_WORDS) -> DataFrame:
    """:func:`tfidf` for stored ``weights (word, df, idf)``, whose counts are not shuffled.

    The weights of the ``head`` words in most documents, which is a bounded table, are sent to
    the counts.  If there are more words, the counts of the others meet theirs in a join.
    """
    if weights.count() <= head:
        return tfidf(counts, F.broadcast(weights))
    # Two ranges of one order: neither loses a word nor has it twice.
    first = weights.orderBy(F.desc("df"), "word").limit(head)
    others = weights.join(F.broadcast(first.select("word")), "word", "left_anti")
    rest = counts.join(F.broadcast(first.select("word")), "word", "left_anti")
    return tfidf(counts, F.broadcast(first)).unionByName(tfidf(rest, others))
