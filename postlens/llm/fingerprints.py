"""Document fingerprints: MinHash signatures, likenesses, and near copies by banded signatures.

A signature holds, for each of ``HASHES`` universal hash functions, the low 16 bits of its
least value over a document's distinct word shingles.  The share of equal places of two
signatures estimates the Jaccard similarity of their shingle sets.

* :func:`fingerprint_edits` fingerprints every text and an edited form of it, which ends like
  the next document.  Neighbours in id order are brought together by dealing the documents to
  blocks of consecutive ids; the first document of a block is also sent to the end of the
  block before.  So every text is shuffled once and no task sees more than a batch at a time.
* :func:`near_copies` cuts signatures into bands, joins equal bands in Spark, and verifies the
  pairs' exact Jaccard similarity on the shingles.  Texts with equal shingle sets are one
  class; only class representatives take part.

Defined results: null text is empty text; a text without words has no shingles and the
signature ``NONE`` everywhere, which is alike only to itself and is no near copy of anything; fewer words
than ``WIDTH`` are one shingle; texts of any length are read whole; null ids come last in descending order; rows
with equal ids follow one another by a hash of their text, and equal rows are rows of their
own; an empty table gives no rows.  Other columns are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postlens.llm.batches import SLICE_BYTES, mix, shingle_sets, slices, small_side, two_columns, word_shingles
from postlens.sources.staging import stage, staging_path

WIDTH = 5
HASHES = 128
SIMILARITY = 0.8

# Rows of a band: pairs at the wanted similarity share one of the 25 bands with probability 0.99995.
BAND_ROWS = 5

# What stands in a signature where there is no shingle.
NONE = 0xFFFF

# Universal hashes: odd multipliers and offsets from a fixed sequence, multiply-add-shift.
_SEED = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY, _ADD = _SEED[:HASHES] | np.uint64(1), _SEED[HASHES:]


def signatures(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    """``uint16[text, hash]`` for all texts."""
    hashes, rows = word_shingles(texts, width)
    out = np.full((len(texts), HASHES), NONE, dtype=np.uint16)
    if not len(hashes):
        return out
    known = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    owners = rows[known]
    spread = np.empty_like(hashes)
    for k in range(HASHES):
        np.multiply(hashes, _MULTIPLY[k], out=spread)
        np.add(spread, _ADD[k], out=spread)
        # The high half of the least value is the least high half.
        out[owners, k] = ((np.minimum.reduceat(spread, known) >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places of the signatures in each row."""
    return (a == b).mean(axis=-1)


def _hex(signature: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in signature]


# --- edited texts ------------------------------------------------------------


def _block_starts(docs: DataFrame, id_col: str, blocks: int) -> list:
    """The first ids of at most ``blocks`` blocks of consecutive ids, descending; as many values as blocks."""
    ids = docs.select(F.col(id_col).alias("k")).where("k is not null")
    ranged = ids.repartitionByRange(blocks, F.desc("k"))
    first = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.max("k").alias("k"))
    return sorted((r.k for r in first.collect()), reverse=True)


def _number_of_block(starts: list, key_type: T.DataType):
    """A function of ids: the number of the block, and whether the id is the block's first."""
    rising = np.array(starts[::-1], dtype=object)
    count = max(1, len(starts))

    @F.pandas_udf("block int, first boolean")
    def where(ids: pd.Series) -> pd.DataFrame:
        known = ids.notna().to_numpy()
        own = ids.to_numpy(dtype=object)
        block = np.full(len(own), count - 1)  # null ids are last of all
        first = np.zeros(len(own), dtype=bool)
        if len(rising):
            values = own[known]
            if isinstance(key_type, T.IntegralType):
                values, table = values.astype(np.int64), rising.astype(np.int64)
            else:
                table = rising
            at = np.searchsorted(table, values, side="left")  # the first start that is not smaller
            at = np.minimum(at, count - 1)
            block[known] = count - 1 - at
            first[known] = table[at] == values
        return pd.DataFrame({"block": block.astype(np.int32), "first": first})

    return where


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """``(block, guest, k, v)`` in partitions of whole blocks, in order: descending ids within a block.

    ``guest`` rows stand at the end of a block and repeat the document that follows it: the
    first one of the next block, or of the first block.  Blocks of a table whose ids are
    distinct have about equal numbers of documents.
    """
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _block_starts(docs, id_col, blocks)
    count = max(1, len(starts))
    source = two_columns(docs, id_col, text_col)
    placed = source.withColumn("at", _number_of_block(starts, source.schema["k"].dataType)("k"))
    # With null ids only, any of them may be the first.
    first = F.col("at.first") if starts else F.lit(True)
    before = F.pmod(F.col("at.block") - 1, F.lit(count))
    own = F.struct(F.col("at.block").alias("block"), F.lit(False).alias("guest"))
    copy = F.struct(before.alias("block"), F.lit(True).alias("guest"))
    rows = placed.select("k", "v", F.inline(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
    order: list[str | Column] = ["block", "guest", F.desc_nulls_last("k"), F.xxhash64("v"), "v"]
    return rows.select("block", "guest", "k", "v").repartitionById(blocks, "block").sortWithinPartitions(*order)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(key, text, next text)`` from rows in the order of :func:`neighbours`."""
    held = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "guest", "k", "v"))
        for block, guest, key, text in zip(*columns, strict=True):
            if held is not None and held[0] == block:
                yield held[1], held[2], text
            # Guests of equal ids come in order; the first is the one that follows.
            held = None if guest else (block, key, text)


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by the beginning of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, blocks: int | None = None
) -> DataFrame:
    """``(<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per document.

    The edited text ends in the beginning of the next document, by descending id, in place of
    its last half; the last document's next one is the first.
    """
    rows = neighbours(docs, id_col, text_col, blocks)
    key = rows.schema["k"].dataType
    fields = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def flushed(part: list[tuple]) -> pa.RecordBatch:
        keys, texts, following = zip(*part, strict=True)
        changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        signed = signatures(pa.array([*texts, following[-1]], pa.large_string()), width)
        own, later = signed[:-1], signed[1:]
        cut = signatures(pa.array(changed, pa.large_string()), width)
        columns = [
            pa.array(keys, arrow_key), pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(_hex(own)), pa.array(_hex(cut)), pa.array(likeness(own, cut)), pa.array(likeness(own, later)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["k", *fields])

    arrow_key = to_arrow_type(key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = [], 0
        for row in _pairs(batches):
            # A part is a chain, in which every text but the last is signed once.
            if part and row[1] is not part[-1][2]:
                yield flushed(part)
                part, size = [], 0
            part.append(row)
            size += len(row[1])
            if size > SLICE_BYTES // 2:
                yield flushed(part)
                part, size = [], 0
        if part:
            yield flushed(part)

    schema = (
        f"k {key.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return rows.mapInArrow(work, schema).withColumnRenamed("k", id_col)


# --- near copies -------------------------------------------------------------

# Representatives compared with one another at a time, and a signature's error that loses no pair in practice.
BLOCK_ROWS, SLACK = 1024, 0.17


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(k, set_id, n_shingles, signature)``; equal shingle sets have equal ``set_id``, which is null for empty ones."""
    source = two_columns(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("v")
                signed = signatures(texts, width)
                names, sizes = [], []
                for own in shingle_sets(texts, width):
                    names.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    sizes.append(len(own))
                columns = [part.column("k"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([row.tobytes() for row in signed], pa.binary())], ["k", "set_id", "n_shingles", "signature"]
                )

    key = source.schema["k"].dataType.simpleString()
    return source.mapInArrow(work, f"k {key}, set_id binary, n_shingles long, signature binary")


def _bands(classes: DataFrame) -> DataFrame:
    """``(bucket, set_id, n_shingles, signature)``: a row for every whole band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = _matrix(batch.column("signature")).astype(np.uint64)
            columns = []
            for band in range(HASHES // BAND_ROWS):
                mixed = np.full(len(signed), band + 1, dtype=np.uint64)
                for k in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
                    mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + signed[:, k])
                columns.append(mixed.view(np.int64))
            buckets = np.stack(columns, axis=1).ravel()
            again = pa.array(np.repeat(np.arange(len(signed)), len(columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets), batch.column("set_id").take(again)], ["bucket", "set_id"]
            )

    return classes.select("set_id", "signature").mapInArrow(work, "bucket long, set_id binary")


def _matrix(signature: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signature.to_pylist()), dtype=np.uint16).reshape(len(signature), HASHES)


def _candidates(bands: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: pairs of one bucket whose sizes and signatures allow the similarity.

    Only pairs that pass are emitted.  The members of a bucket are dealt by size to blocks of
    ``BLOCK_ROWS``; a task compares a block with itself and with one other, and only blocks
    whose sizes are near enough meet.
    """
    spark = bands.sparkSession
    shared = bands.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    sized = bands.join(shared, "bucket").join(classes, "set_id")
    # Blocks are ranges of sizes within which the similarity is possible, cut further by hash.
    step = -np.log(similarity) * (1 + 1e-9) if similarity < 1 else 1.0
    level = F.floor(F.log("n_shingles") / F.lit(float(step))).alias("level")
    parts = F.ceil(F.col("members") / BLOCK_ROWS).cast("int")
    placed = sized.select(
        "bucket", "set_id", "n_shingles", "signature", level, parts.alias("parts"),
        F.pmod(F.xxhash64("set_id"), parts).cast("int").alias("part"),
    )
    # Part p of a level meets parts q >= p of its level and all parts of the next one.
    any_part = F.sequence(F.lit(0), F.col("parts") - 1)
    meet = lambda level, p, q, left: F.struct(level.alias("level"), p.alias("p"), q.alias("q"), left.alias("side"))
    part = F.col("part")
    rows = placed.select("bucket", "set_id", "n_shingles", "signature", F.inline(F.concat(
        F.transform(any_part, lambda q: meet(2 * F.col("level"), F.least(part, q), F.greatest(part, q), F.lit(0))),
        F.transform(any_part, lambda q: meet(2 * F.col("level") + 1, part, q, F.lit(1))),
        F.transform(any_part, lambda p: meet(2 * F.col("level") - 1, p, part, F.lit(2))),
    )))
    key = F.xxhash64("bucket", "level", "p", "q").alias("task")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(key, "bucket", "level", "p", "q", "side", "set_id", "n_shingles", "signature")
    rows = rows.repartition(partitions, "task").sortWithinPartitions("task", "bucket", "level", "p", "q")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "level", "p", "q")), strict=True))
            starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if names[lo] != name:
                    yield from _compared(held, similarity)
                    held, name = [], names[lo]
                held.append(batch.slice(lo, hi - lo))
        yield from _compared(held, similarity)

    return rows.mapInArrow(work, "a binary, b binary").distinct()


def _compared(held: list[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs of one block, or of two, that may be similar."""
    if sum(map(len, held)) < 2:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    side = rows["side"].to_numpy()
    sizes = rows["n_shingles"].to_numpy()
    signed = _matrix(rows["signature"].combine_chunks())
    names = rows["set_id"].to_pylist()
    left, right = (np.flatnonzero(side == s) for s in (1, 2)) if side.any() else (np.arange(len(side)),) * 2
    a, b = [], []
    for i in left:
        least, most = np.minimum(sizes[i], sizes[right]), np.maximum(sizes[i], sizes[right])
        near = right[(least >= similarity * most) & ((right > i) | side.any())]
        near = near[likeness(signed[near], signed[i]) >= similarity - SLACK]
        for j in near:
            x, y = sorted((names[i], names[j]))
            if x != y:
                a.append(x)
                b.append(y)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(a, b, jaccard)`` of the pairs whose exact similarity is reached; ``sets (set_id, shingles)``."""
    side = lambda name: sets.select(F.col("set_id").alias(name), F.col("shingles").alias(f"{name}_shingles"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = []
            for x, y in zip(batch.column("a_shingles").to_pylist(), batch.column("b_shingles").to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                score.append(shared / (len(x) + len(y) - shared))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(score, pa.float64())], ["a", "b", "jaccard"])
            yield out.filter(pc.greater_equal(out.column("jaccard"), similarity))

    return joined.mapInArrow(work, "a binary, b binary, jaccard double")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY
) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``(<id>, class_id)`` per document and ``(a, b, jaccard)`` between classes, ``a < b``.

    A class holds the documents of one shingle set and is named by its smallest id; a document
    without shingles, or with a null id, is in no class (null).  A link is a pair of classes whose exact similarity
    is ``similarity`` or more.
    """
    spark = docs.sparkSession
    signed = stage(sign(docs, id_col, text_col, width), staging_path(spark, "signed"))
    classes = signed.where("set_id is not null and k is not null").groupBy("set_id").agg(F.min(F.struct("k", "n_shingles", "signature")).alias("c"))
    classes = stage(classes.select("set_id", "c.*"), staging_path(spark, "classes"))
    pairs = _candidates(_bands(classes), classes.select("set_id", "n_shingles", "signature"), similarity)
    pairs = stage(pairs, staging_path(spark, "pairs"))
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    first = small_side(stage(classes.join(wanted, "set_id").select("k", "set_id"), staging_path(spark, "wanted")))
    # One text of each class that takes part.
    texts = two_columns(docs, id_col, text_col).join(first, "k").select("k", "v", F.col("set_id").alias("wanted"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = [x.tobytes() for x in shingle_sets(part.column("v"), width)]
                names = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
                same = pa.array([a == b for a, b in zip(names, part.column("wanted").to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(own, pa.binary())], ["set_id", "shingles"]).filter(same)

    stored = texts.mapInArrow(sets, "set_id binary, shingles binary").dropDuplicates(["set_id"])
    stored = stage(stored, staging_path(spark, "sets"))
    links = _verified(pairs, stored, similarity)
    name = lambda c: classes.select(F.col("set_id").alias(c), F.col("k").alias(f"{c}_k"))
    links = links.join(name("a"), "a").join(name("b"), "b").select(
        F.least("a_k", "b_k").alias("a"), F.greatest("a_k", "b_k").alias("b"), "jaccard"
    )
    members = signed.join(classes.select("set_id", F.col("k").alias("class_id")), "set_id", "left")
    return members.select(F.col("k").alias(id_col), F.when(F.col("k").isNotNull(), F.col("class_id")).alias("class_id")), links
