"""Text per subject: in segments of a bounded number of posts, or as a rope of chunks of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.sources.staging import stage, staging_path

POSTS_PER_SEGMENT = 1024

# Characters of a rope's chunk.
CHUNK_CHARS = 1 << 18


def _segment(pos: str, size: int) -> Column:
    return F.floor(F.col(pos) / size).alias("segment")


def _in_order(pos: str, col: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(col))))
    return F.transform(rows, lambda row: row[col])


def subject_corpus(
    posts: DataFrame,
    keys: Sequence[str] = ("subject_id", "label"),
    pos: str = "pos",
    col: str = "text",
    posts_per_segment: int = POSTS_PER_SEGMENT,
    record: Sequence[str] = (),
) -> DataFrame:
    """Texts joined by spaces in the order of ``pos``: ``(*keys, *record, segment, all_text)``.

    ``record`` names the columns that tell a subject's records apart where ``pos`` starts
    anew in each (``plans.etl.RECORD`` for posts read from XML); every record has segments
    of its own.  A record of up to ``posts_per_segment`` posts is one row, segment 0.  A
    longer one continues in further segments, so that no row or task has to hold an
    unbounded subject; the segments in order are the whole text.  NULL texts are skipped,
    and a group of NULLs only gives ``''``.
    """
    return posts.groupBy(*keys, *record, _segment(pos, posts_per_segment)).agg(
        F.concat_ws(" ", _in_order(pos, col)).alias("all_text")
    )


def subject_rope(
    posts: DataFrame,
    keys: Sequence[str] = ("subject_id", "label"),
    order: Sequence[str] = ("pos",),
    col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """The whole text of each subject as a rope: ``(*keys, chunk, start, n_chars, total_chars, text)``.

    The text is that of all posts in ``order``, joined by spaces; NULL texts are skipped, and
    a subject of NULLs only has one empty chunk.  For posts with records, order by
    ``(*plans.etl.RECORD, "pos")``.  Chunk ``i`` holds the characters from ``i * chunk_chars`` on, so any
    range of a text is found by key (see :func:`rope_range`), and no row grows with the subject.

    A post's place is a prefix sum of lengths, taken within ranges of posts and then over
    the ranges, so a subject of very many posts is not one task's work.  Equal places in the order are
    ordered by text.
    """
    spark = posts.sparkSession
    keys, order = list(keys), list(order)
    rows = posts.select(*keys, *order, F.col(col).alias("_text"))
    size = F.coalesce(F.length("_text") + 1, F.lit(0)).cast("long")  # with the space behind it
    ranged = rows.repartitionByRange(*keys, *order, F.xxhash64("_text")).withColumns({
        "_part": F.spark_partition_id(), "_size": size,
    })
    ranged = stage(ranged, staging_path(spark, "rope"))
    place = [*order, F.xxhash64("_text"), "_text"]
    before = lambda by, at: Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_size").alias("_sum"))
    parts = parts.select(
        *(F.col(k).alias(f"_{k}") for k in keys), F.col("_part").alias("_p"),
        F.coalesce(F.sum("_sum").over(before(keys, ["_part"])), zero).alias("_base"),
        F.greatest(F.sum("_sum").over(Window.partitionBy(*keys)) - 1, zero).alias("total_chars"),
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    at = F.col("_base") + F.coalesce(F.sum("_size").over(before([*keys, "_part"], place)), zero)
    placed = ranged.join(parts, same).withColumn("_at", at)
    end = F.least(F.col("_at") + F.col("_size"), "total_chars")
    first, last = F.floor(F.col("_at") / chunk_chars), F.floor((end - 1) / chunk_chars)
    chunks = placed.where((end > F.col("_at")) & F.col("_text").isNotNull()).select(
        *keys, "total_chars", "_at", end.alias("_end"), F.concat("_text", F.lit(" ")).alias("_text"),
        F.explode(F.sequence(first, last)).alias("chunk"),
    )
    start = F.greatest("_at", F.col("chunk") * chunk_chars)
    stop = F.least("_end", (F.col("chunk") + 1) * chunk_chars)
    piece = F.substring("_text", (start - F.col("_at") + 1).cast("int"), (stop - start).cast("int"))
    # Chunk 0 exists for a subject without any character as well.
    empty = parts.where("total_chars = 0").select(*(F.col(f"_{k}").alias(k) for k in keys), "total_chars").distinct()
    empty = empty.withColumns({"_start": zero, "_piece": F.lit(""), "chunk": zero})
    pieces = chunks.select(*keys, "total_chars", start.alias("_start"), piece.alias("_piece"), "chunk").unionByName(empty)
    parts_in_order = F.array_sort(F.collect_list(F.struct("_start", "_piece")))
    return (
        pieces.groupBy(*keys, "total_chars", "chunk")
        .agg(F.array_join(F.transform(parts_in_order, lambda p: p["_piece"]), "").alias("text"))
        .select(*keys, "chunk", (F.col("chunk") * chunk_chars).alias("start"), F.length("text").cast("long").alias("n_chars"), "total_chars", "text")
    )


def rope_range(
    rope: DataFrame, start: int, length: int, keys: Sequence[str] = ("subject_id", "label"), chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """``(*keys, text)``: ``length`` characters from ``start`` on of each subject, read from the chunks that hold them."""
    first, last = start // chunk_chars, (start + max(length, 1) - 1) // chunk_chars
    own = rope.where(F.col("chunk").between(first, last))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda c: c["text"]), "")
    return own.groupBy(*keys).agg(F.substring(text, start - first * chunk_chars + 1, length).alias("text"))
