"""Token ids as binary files: one id array per shard, document boundaries in Elias-Fano form.

A shard file holds, all little-endian:

=========== =================================================================
ids         all ids, one document behind the other
boundaries  Elias-Fano: where each document ends, ``documents`` values up to ``ids``
names       Elias-Fano: document ids minus the smallest, ascending, without null ones
8 bytes     ``TOKENEF1``
4 + 4       bytes per id (2 or 4), documents with a null id (they come first)
8 + 8       documents, ids
8 + 8       smallest document id, where the boundaries begin
=========== =================================================================

An Elias-Fano sequence of ``n`` ascending values up to ``u`` keeps ``floor(log2(u / n))`` low
bits of each value packed, and the rest in unary, 2 + log2(u / n) bits a value in all.  Every
``SAMPLE``-th one of the unary part has its position noted in four bytes, so ``select(i)``
reads a few words, without a table of offsets.

Documents are dealt to shards by ranges of their id, ties by their text, and every shard is
written by one task under a name of its own; the list of files is kept only for tasks that
ended well, so a repeated task leaves no trace in it.  Files are written and read with
``pyarrow.fs`` below ``spark.checkpoint.dir``.

Defined results: null text is empty text, whose only id is the end id; repeated rows are
stored each; rows with a null id come first; an empty table makes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, slices
from postlens.llm.encoding import Encoder
from postlens.sources.staging import stage, staging_path

END_ID = 2
SAMPLE = 256
_MAGIC = b"TOKENEF1"
_FOOT = struct.Struct("<8sIIQQq")
_EF = struct.Struct("<QQB7x")

# Ids that a reader holds at a time.
READ_IDS = 1 << 20


class EliasFano:
    """An ascending sequence of non-negative values."""

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n and (int(values[-1]) > universe or (values[1:] < values[:-1]).any()):
            raise ValueError("values must ascend and not exceed the universe")
        low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if low_bits and n:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((universe >> low_bits) + n + 1, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i[:, None].astype(np.int64) * self.low_bits + np.arange(self.low_bits)
        bits = self.low[at >> 3] >> (at & 7).astype(np.uint8) & 1
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The ``i``-th value, from the nearest noted position on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, bit = at >> 3, at & 7
        word = int(self.high[byte]) >> bit
        base = at
        while True:
            ones = word.bit_count()
            if ones > skip:
                for _ in range(skip):
                    word &= word - 1
                position = base + (word & -word).bit_length() - 1
                return (position - i) << self.low_bits | int(self._low(np.array([i]))[0])
            skip -= ones
            byte += 1
            base, word = byte * 8, int(self.high[byte])

    def values(self) -> np.ndarray:
        """All values."""
        bits = np.unpackbits(self.high, bitorder="little", count=(self.universe >> self.low_bits) + self.n + 1)
        high = np.flatnonzero(bits) - np.arange(self.n)
        out = np.empty(self.n, dtype=np.uint64)
        for lo in range(0, self.n, 1 << 16):
            i = np.arange(lo, min(self.n, lo + (1 << 16)))
            out[i] = high[i].astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)
        return out.astype(np.int64)

    def to_bytes(self) -> bytes:
        return b"".join(
            [_EF.pack(self.n, self.universe, self.low_bits), self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        )

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at ``at``, and where it ends."""
        n, universe, low_bits = _EF.unpack_from(data, at)
        at += _EF.size
        parts = []
        for size, kind in (
            (-(-n * low_bits // 8), np.uint8),
            (-(-((universe >> low_bits) + n + 1) // 8), np.uint8),
            (4 * -(-n // SAMPLE), "<u4"),
        ):
            parts.append(np.frombuffer(data, dtype=kind, count=size // np.dtype(kind).itemsize, offset=at))
            at += size
        return cls(n, universe, low_bits, *parts), at


# --- files -------------------------------------------------------------------


def _open(path: str):
    """The file system of a folder or file, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class ShardWriter:
    """Writes one shard; ids are appended as they come, the index is written last."""

    def __init__(self, path: str, wide: bool):
        system, self.path = _open(path)
        system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.kind = np.dtype("<u4" if wide else "<u2")
        self.out = system.open_output_stream(self.path)
        self.ends: list[np.ndarray] = []
        self.names: list[np.ndarray] = []
        self.ids = self.nulls = 0

    def append(self, ids: np.ndarray, offsets: np.ndarray, names: np.ndarray, nulls: int) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.ends.append(offsets[1:] + self.ids)
        self.names.append(names)
        self.ids += len(ids)
        self.nulls += nulls

    def close(self) -> int:
        """Writes index and foot; the number of documents."""
        ends, names = np.concatenate(self.ends), np.concatenate(self.names)
        least = int(names[0]) if len(names) else 0
        gaps = (names.astype(np.uint64) - np.uint64(least & (1 << 64) - 1)) if len(names) else names.astype(np.uint64)
        index = EliasFano.build(ends, self.ids).to_bytes()
        index += EliasFano.build(gaps, int(gaps[-1]) if len(gaps) else 0).to_bytes()
        self.out.write(index)
        foot = _FOOT.pack(_MAGIC, self.kind.itemsize, self.nulls, len(ends), self.ids, least)
        self.out.write(foot + struct.pack("<Q", self.ids * self.kind.itemsize))
        self.out.close()
        return len(ends)


class Shard(NamedTuple):
    """An open shard: ``ids(lo, hi)`` reads a range, ``boundaries.select(i)`` says where document ``i`` ends."""

    file: object
    kind: np.dtype
    nulls: int
    documents: int
    length: int
    least: int
    boundaries: EliasFano
    names: EliasFano

    def ids(self, lo: int, hi: int) -> np.ndarray:
        size = self.kind.itemsize
        return np.frombuffer(self.file.read_at((hi - lo) * size, lo * size), dtype=self.kind).astype("<u4")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.boundaries.select(i - 1) if i else 0, self.boundaries.select(i))


def open_shard(path: str) -> Shard:
    system, own = _open(path)
    file = system.open_input_file(own)
    size = file.size()
    foot = _FOOT.size + 8
    tail = file.read_at(foot, size - foot)
    magic, width, nulls, documents, ids, least = _FOOT.unpack_from(tail)
    if magic != _MAGIC:
        raise ValueError(f"not a token shard: {path}")
    (start,) = struct.unpack_from("<Q", tail, _FOOT.size)
    index = file.read_at(size - foot - start, start)
    boundaries, at = EliasFano.from_bytes(index)
    names, _ = EliasFano.from_bytes(index, at)
    return Shard(file, np.dtype(f"<u{width}"), nulls, documents, ids, least, boundaries, names)


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Writes all documents as shards below ``folder``; the stored list ``(shard, path, documents, ids)``."""
    spark = docs.sparkSession
    source = bounded(docs).select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("v"))
    tie = F.xxhash64("v")
    ordered = source.withColumn("t", tie).repartitionByRange("k", "t").sortWithinPartitions("k", "t", "v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = None, None
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            for part in slices(batch):
                if writer is None:
                    encoder = Encoder(tokenizer)
                    writer = ShardWriter(path, max(encoder.vocabulary, end_id + 1) > 1 << 16)
                ids, offsets = encoder.encode(part.column("v"))
                # The end id goes behind each document.
                more = np.arange(1, len(part) + 1)
                own = np.insert(ids, offsets[1:], np.uint32(end_id))
                keys = part.column("k")
                writer.append(own, np.concatenate([[0], offsets[1:] + more]), np.asarray(keys.drop_null()), keys.null_count)
        if writer is not None:
            count = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [path], "documents": [count], "ids": [writer.ids]},
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]),
            )

    files = ordered.select("k", "v").mapInArrow(work, "shard int, path string, documents long, ids long")
    return stage(files, staging_path(spark, "shards"))


def read_tokens(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of all documents in the listed files; ``start`` counts the ids before."""
    return _read(files, with_ids=True)


def read_boundaries(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of all documents, from the files."""
    return _read(files, with_ids=False)


def _read(files: DataFrame, with_ids: bool) -> DataFrame:
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    # The list comes in one partition; a shard is read by one task.
    dealt = placed.repartition(max(1, files.count())).select("path", "base")
    last = ("ids", pa.binary()) if with_ids else ("ids_crc32", pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = open_shard(path)
                ends = shard.boundaries.values()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                names = (shard.names.values().astype(np.uint64) + np.uint64(shard.least & (1 << 64) - 1)).astype(np.int64)
                names = [None] * shard.nulls + names.tolist()
                lo = 0
                while lo < shard.documents:
                    hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + READ_IDS, side="right")))
                    ids = shard.ids(int(starts[lo]), int(ends[hi - 1]))
                    own = [ids[s - starts[lo] : e - starts[lo]].tobytes() for s, e in zip(starts[lo:hi], ends[lo:hi], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[lo:hi], pa.int64()),
                            pa.array(starts[lo:hi] + base),
                            pa.array(ends[lo:hi] - starts[lo:hi]),
                            pa.array(own, pa.binary()) if with_ids else pa.array([zlib.crc32(x) for x in own], pa.int64()),
                        ],
                        schema=schema,
                    )
                    lo = hi

    kind = "ids binary" if with_ids else "ids_crc32 long"
    return dealt.mapInArrow(work, f"doc_id long, start long, n_tokens long, {kind}")


def token_folder(spark: SparkSession) -> str:
    """A new folder for shards below the shared one."""
    return staging_path(spark, "token-ids")
