"""Posts: flattening, labelling, filtering, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import calendar, text

# Writing field -> column of a post.
_POST_COLUMNS = {
    "TITLE": lambda c: F.trim(c).alias("title"),
    "DATE": lambda c: calendar.to_timestamp(c).alias("date"),
    "INFO": lambda c: c.alias("source_info"),
    "TEXT": lambda c: F.trim(c).alias("text"),
}


def flatten_posts(subjects: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per writing: ``(subject_id, *keep, pos, title, date, source_info, text)``.

    ``pos`` is the writing's place in its record.  Only the fields that the writings have
    become columns.  Subjects without writings give no row.

    The outer generator plus a filter on ``pos`` is an inner explode, but keeps Catalyst
    from adding ``size(WRITING) > 0`` below it, which would parse every XML record again.
    """
    writing = subjects.schema["WRITING"].dataType.elementType
    fields = [name for name in _POST_COLUMNS if name in writing.names]
    return (
        subjects.select(
            F.col("ID").alias("subject_id"), *keep, F.posexplode_outer("WRITING").alias("pos", "post")
        )
        .where(F.col("pos").isNotNull())
        .select(
            "subject_id", *keep, "pos", *[_POST_COLUMNS[name](F.col(f"post.{name}")) for name in fields]
        )
    )


def hot_subjects(posts: DataFrame, share: float = 0.01, key: str = "subject_id") -> list:
    """Ids that hold at least ``share`` of all posts, so ``1 / share`` of them at most."""
    counts = posts.groupBy(key).agg(F.count("*").alias("n"))
    total = posts.agg(F.count("*")).scalar()
    rows = counts.where(F.col(key).isNotNull() & (F.col("n") >= total * share)).orderBy(key)
    return [row[key] for row in rows.collect()]


def label_posts(
    posts: DataFrame,
    labels: DataFrame,
    key: str = "subject_id",
    hot: Sequence = (),
    salts: int = 16,
    salt_by: Sequence[str] = ("pos",),
) -> DataFrame:
    """Posts of labelled subjects, with their label (inner join on ``key``).

    Catalyst broadcasts ``labels`` when its size allows.  Otherwise both sides shuffle on
    ``key`` and AQE splits the partition of a hot subject, unless a later grouping by
    ``key`` reuses the partitioning: that would hand all of the subject's posts to one
    task.  Pass the ``hot`` subjects (:func:`hot_subjects`) in front of such groupings,
    unless the posts are stored between: the labels of these few are repeated ``salts``
    times and their posts pick one by the hash of ``salt_by``, so they are spread and the
    grouping gets a shuffle of its own, after partial aggregation.
    """
    if not hot:
        return posts.join(labels, key, "inner")
    is_hot = F.col(key).isin(list(hot))
    salt = F.when(is_hot, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (
        posts.withColumn("_salt", salt)
        .join(labels.withColumn("_salt", F.explode(copies)), [key, "_salt"], "inner")
        .drop("_salt")
    )


def posts_by_class(posts: DataFrame, label: int) -> DataFrame:
    return posts.where(F.col("label") == label)


def clean_text(posts: DataFrame, col: str = "text", out: str = "clean_text") -> DataFrame:
    return posts.withColumn(out, text.clean(F.col(col)))


def word_count(posts: DataFrame, col: str = "text", out: str = "word_count") -> DataFrame:
    return posts.withColumn(out, text.word_count(F.col(col)))


def drop_short_posts(posts: DataFrame, col: str = "text", min_words: int = 3) -> DataFrame:
    """Posts of at least ``min_words`` space-separated words; NULL text drops."""
    return posts.where(text.word_count(F.col(col)) >= min_words)


def tokens(
    posts: DataFrame,
    col: str = "text",
    out: str = "words",
    pattern: str = text.NON_WORD,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    return posts.withColumn(out, text.tokens(F.col(col), pattern, stop_words))


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of a projection, in a defined order (a distributed top-n)."""
    return df.select(*columns).orderBy(*order_by).limit(n)
