"""Helpers for work on Arrow record batches inside Spark tasks.

Texts arrive as Arrow string columns of at most a few thousand rows, so every helper
works on one batch at a time and its memory is bounded by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text in one slice of a batch; numpy working arrays are some ten times of it.
SLICE_BYTES = 2 << 20

# Bytes of one Arrow batch between Spark and a Python worker.
BATCH_BYTES = 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df`` in a session whose Arrow batches are at most ``BATCH_BYTES`` large, or one row.

    Batches of long texts are counted in rows otherwise, and held twice on each side.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def two_columns(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` under fixed names, so extra or clashing columns of ``df`` do not matter."""
    return bounded(df).select(F.col(key).alias("k"), F.coalesce(F.col(value), F.lit("")).alias("v"))


def slices(batch: pa.RecordBatch, column: str = "v") -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of a slice hold about ``SLICE_BYTES``; one text is never cut."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    if not len(sizes):
        return
    part = np.cumsum(sizes) // SLICE_BYTES
    starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        yield batch.slice(int(lo), int(hi - lo))
    pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``(codes, distinct words, offsets)``: words are maximal runs without ASCII white space.

    Row ``i`` has the words ``codes[offsets[i]:offsets[i + 1]]``.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
    ends = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
    offsets = np.concatenate([[0], np.cumsum(real)])[ends].astype(np.int64)
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary, offsets


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


_ORDER = np.uint64(0x9E3779B97F4A7C15)


def _folded(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours."""
    n = max(0, len(hashes) - width + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        rolled = mix(rolled * _ORDER + hashes[i : n + i])
    return rolled


def word_shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, rows)`` of the ``width``-word shingles of all texts, A-Z lower-cased, in order.

    A text with fewer words has one shingle, its whole word sequence; one without words
    has none.  Repeated shingles are repeated.
    """
    codes, words, offsets = split_words(pc.ascii_lower(texts))
    hashes = word_hashes(words)[codes]
    counts = np.diff(offsets)
    rolled = _folded(hashes, width)
    rows = np.repeat(np.arange(len(counts)), counts)[: len(rolled)]
    # Runs that cross into the next text are left out.
    inside = np.arange(len(rolled)) + width <= offsets[1:][rows] if len(rolled) else np.empty(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return rolled[inside], rows[inside]
    whole = [_folded(hashes[offsets[i] : offsets[i + 1]], int(counts[i])) + np.uint64(counts[i]) for i in short]
    rolled, rows = np.concatenate([rolled[inside], *whole]), np.concatenate([rows[inside], short])
    order = np.argsort(rows, kind="stable")
    return rolled[order], rows[order]


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles; see :func:`word_shingles`."""
    rolled, rows = word_shingles(texts, width)
    counts = np.bincount(rows, minlength=len(texts))[: len(texts)]
    ends = np.cumsum(counts)
    out = []
    for lo, hi in zip(ends - counts, ends, strict=True):
        part = np.sort(rolled[lo:hi])
        out.append(part[np.concatenate([[True], part[1:] != part[:-1]])] if hi > lo else part)
    return out


# Rows of ids or of a few numbers that may be sent to all tasks: some 16 MB.
BROADCAST_ROWS = 500_000


def small_side(rows: DataFrame) -> DataFrame:
    """A stored table of few narrow columns as a join side: sent to all tasks if it was counted to be small.

    Beyond ``BROADCAST_ROWS`` the join is left to Spark, which shuffles both sides.
    """
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows
