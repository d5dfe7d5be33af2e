"""Benchmark items inside documents: MinHash containment search, verified exactly.

The items are the stated query set; they are read in blocks of bounded size, and every
block meets all documents in one scan without a shuffle.

An item with ``n`` distinct shingles of which a document holds a share of at least ``t``
misses at most ``(1 - t) n`` of them.  So of the item's ``floor((1 - t) n) + 1`` smallest
shingle hashes (a bottom-k MinHash sketch) the document holds at least one: looking up a
document's shingles among the sketches loses no pair, however long the document is.
Items are partitioned by size, and the sketch size belongs to the size class.  Candidates
are then verified on the words themselves.

Defined results: a text of fewer than ``width`` words is one shingle, its whole word
sequence; null or empty texts contain nothing and are contained in nothing; repeated rows
count each on their own; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, shingle_sets, slices, two_columns, word_shingles

WIDTH = 5
THRESHOLD = 0.8

# Characters of items in one block.
BLOCK_CHARS = 16 << 20
_FILTER_BITS = 22


class Index(NamedTuple):
    """Sketches of a block of items: sorted hashes, the item of each, and a bit per hash prefix."""

    hashes: np.ndarray
    items: np.ndarray
    filter: np.ndarray
    keys: list
    shingles: list[frozenset[str]]


def _shingle_strings(text: str, width: int) -> frozenset[str]:
    lower = pc.ascii_lower(pa.array([text], pa.large_string()))
    words = [w for w in pc.ascii_split_whitespace(lower)[0].as_py() if w]
    if len(words) < width:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def size_class(n: int) -> int:
    """Items of ``2**k`` to ``2**(k + 1) - 1`` shingles are one partition."""
    return max(0, n.bit_length() - 1)


def build_index(rows: list[tuple], width: int, threshold: float) -> Index:
    """The index of ``(id, text)`` items."""
    texts = pa.array([t or "" for _, t in rows], pa.large_string())
    hashes, owners = [], []
    for item, own in enumerate(shingle_sets(texts, width)):
        largest = 2 ** (size_class(len(own)) + 1) - 1
        kept = own[: int((1 - threshold) * largest + 1e-9) + 1]
        hashes.append(kept)
        owners.append(np.full(len(kept), item))
    hashes = np.concatenate([*hashes, np.empty(0, np.uint64)])
    owners = np.concatenate([*owners, np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    known = np.zeros(1 << _FILTER_BITS, dtype=bool)
    known[hashes >> np.uint64(64 - _FILTER_BITS)] = True
    shingles = [_shingle_strings(t or "", width) for _, t in rows]
    return Index(hashes[order], owners[order], known, [k for k, _ in rows], shingles)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items, a block of about ``BLOCK_CHARS`` characters at a time."""
    source = two_columns(items, id_col, text_col)
    chars = source.agg(F.sum(F.length("v"))).first()[0] or 0
    blocks = chars // BLOCK_CHARS + 1
    block = F.pmod(F.xxhash64("k", "v"), F.lit(blocks))
    for number in range(blocks):
        yield [(r.k, r.v) for r in source.where(block == number).collect()]


def _matches(index: Index, texts: pa.Array, width: int, threshold: float) -> Iterator[tuple[int, int, int]]:
    """``(row, item, shared shingles)`` of all pairs that reach the threshold."""
    if not len(index.hashes):
        return
    rolled, rows = word_shingles(texts, width)
    hit = np.flatnonzero(index.filter[rolled >> np.uint64(64 - _FILTER_BITS)])
    first = np.searchsorted(index.hashes, rolled[hit], side="left")
    last = np.searchsorted(index.hashes, rolled[hit], side="right")
    pairs = set()
    for h, lo, hi in zip(hit[first < last], first[first < last], last[first < last], strict=True):
        pairs.update((int(rows[h]), int(i)) for i in index.items[lo:hi])
    seen, own = -1, frozenset()
    for row, item in sorted(pairs):
        if row != seen:
            seen, own = row, _shingle_strings(texts[row].as_py(), width)
        shared = len(index.shingles[item] & own)
        if shared >= threshold * len(index.shingles[item]) - 1e-9:
            yield row, item, shared


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, item id, n_shared, n_item, containment)`` of items with a share of at least ``threshold`` in a document."""
    spark = docs.sparkSession
    source = two_columns(docs, id_col, text_col)
    key = source.schema["k"].dataType.simpleString()
    item_type = items.schema[item_id].dataType
    found = None
    for rows in item_blocks(items, item_id, item_text):
        index = _shared(spark, rows, width, threshold)

        def work(batches, index=index):
            for batch in batches:
                for part in slices(batch):
                    hits = list(_matches(index.value, part.column("v"), width, threshold))
                    row, item, shared = ([h[i] for h in hits] for i in range(3))
                    keys = part.column("k").take(pa.array(row, pa.int64()))
                    names = [index.value.keys[i] for i in item]
                    sizes = [len(index.value.shingles[i]) for i in item]
                    yield pa.RecordBatch.from_pydict({"k": keys, "i": names, "s": shared, "n": sizes}, out)

        out = pa.schema(
            [("k", _arrow(source.schema["k"].dataType)), ("i", _arrow(item_type)), ("s", pa.int64()), ("n", pa.int64())]
        )
        block = source.mapInArrow(work, f"k {key}, i {item_type.simpleString()}, s long, n long")
        found = block if found is None else found.unionAll(block)
    return found.select(
        F.col("k").alias(id_col),
        F.col("i").alias(item_id),
        F.col("s").alias("n_shared"),
        F.col("n").alias("n_item"),
        (F.col("s") / F.col("n")).alias("containment"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay as they are."""
    spark, schema, at = docs.sparkSession, docs.schema, docs.columns.index(text_col)
    for rows in item_blocks(items, item_id, item_text):
        index = _shared(spark, rows, width, threshold)

        def work(batches, index=index):
            for batch in batches:
                for part in slices(batch, text_col):
                    texts = pc.fill_null(part.column(at), "")
                    bad = {row for row, _, _ in _matches(index.value, texts, width, threshold)}
                    yield part.filter(pa.array([i not in bad for i in range(len(part))], pa.bool_()))

        docs = bounded(docs).mapInArrow(work, schema)
    return docs


def _shared(spark: SparkSession, rows: list[tuple], width: int, threshold: float) -> Broadcast:
    return spark.sparkContext.broadcast(build_index(rows, width, threshold))


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
