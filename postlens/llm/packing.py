"""Packing of documents into sequences of a fixed window, planned on the length histogram.

1. Every document is tokenized, ended with an end id and cut into whole windows; what is
   left is its *tail*, shorter than the window.
2. The histogram of tail lengths, in bins of ``BIN`` tokens, has a fixed number of rows and
   is all that reaches the driver.  Combinations of at most ``DEPTH`` bins that fill the
   window exactly are enumerated, and non-negative least squares finds how often each should
   be used so that the histogram is used up.  The counts are rounded down.
3. What rounding leaves over is packed greedily, largest bins first.  Tails that fit nowhere
   well (all tails of one odd length, say) are laid end to end and cut at the window.
4. Tails are numbered per bin by prefix sums over task counts, so the plan's ranges of
   numbers tell each tail its sequence without collecting anything.

Defined results: null text is empty text, whose only id is the end id; repeated rows are
packed each; an empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.batches import slices, small_side, two_columns
from postlens.llm.encoding import Encoder
from postlens.sources.staging import stage, staging_path

WINDOW = 2048
END_ID = 1
BIN = 8
DEPTH = 3

# A greedy combination may leave this share of the window empty; worse ones are cut instead.
WASTE = 1 / 64


def tokenize(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, window: int = WINDOW
) -> DataFrame:
    """``(task, row, id, n, ids, crcs, tail_bin, tail_rank, windows_before)`` per document, stored.

    ``ids`` is little-endian, two bytes an id if all ids fit; ``crcs`` has the CRC-32 of each
    whole window and of the tail.  ``tail_rank`` numbers the tails of a bin and
    ``windows_before`` the whole windows, both within the task that wrote the row.
    """
    source = two_columns(docs, id_col, text_col)
    key = source.schema["k"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        narrow = np.dtype("<u2" if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else "<u4")
        task, row, windows, ranks = TaskContext.get().partitionId(), 0, 0, {}
        for batch in batches:
            for part in slices(batch):
                ids, offsets = encoder.encode(part.column("v"))
                out = {c: [] for c in ("row", "n", "ids", "crcs", "tail_bin", "tail_rank", "windows_before")}
                for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                    own = np.append(ids[lo:hi], np.uint32(end_id)).astype("<u4")
                    full, tail = divmod(len(own), window)
                    slot = -(-tail // BIN)
                    out["row"].append(row)
                    out["n"].append(len(own))
                    out["ids"].append(own.astype(narrow).tobytes())
                    out["crcs"].append([zlib.crc32(own[i : i + window].tobytes()) for i in range(0, len(own), window)])
                    out["tail_bin"].append(slot)
                    out["tail_rank"].append(ranks.get(slot, 0))
                    out["windows_before"].append(windows)
                    ranks[slot] = ranks.get(slot, 0) + 1
                    row, windows = row + 1, windows + full
                columns = [pa.array([task] * len(part), pa.int32()), pa.array(out["row"], pa.int64()), part.column("k")]
                columns += [pa.array(out["n"], pa.int64()), pa.array(out["ids"], pa.binary())]
                columns += [pa.array(out["crcs"], pa.list_(pa.int64())), pa.array(out["tail_bin"], pa.int32())]
                columns += [pa.array(out[c], pa.int64()) for c in ("tail_rank", "windows_before")]
                yield pa.RecordBatch.from_arrays(columns, ["task", "row", "id", *list(out)[1:]])

    schema = (
        f"task int, row long, id {key}, n long, ids binary, crcs array<long>, tail_bin int, "
        "tail_rank long, windows_before long"
    )
    return stage(source.mapInArrow(work, schema), staging_path(docs.sparkSession, "tokens"))


# --- the plan ----------------------------------------------------------------


class Part(NamedTuple):
    """Tails ``first <= number < stop`` of a bin go ``each`` to a sequence, into slots from ``slot`` on."""

    bin: int
    first: int
    stop: int
    each: int
    sequence: int
    slot: int


class Plan(NamedTuple):
    parts: list[Part]
    sequences: int
    planned: dict[int, int]


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ways to write ``units`` as a sum of at most ``depth`` descending bins."""
    if depth == 1:
        return [(units,)]
    out = [(units,)]
    for first in range(units - 1, 0, -1):
        out += [(first, *rest) for rest in combinations(units - first, depth - 1) if rest[0] <= first]
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``x >= 0`` that minimizes ``|a x - b|``, by the active-set method of Lawson and Hanson.

    The number of steps is bounded; every step keeps ``x`` feasible, so stopping early
    costs some padding and nothing else.
    """
    x = np.zeros(a.shape[1])
    active: list[int] = []
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * scale:
            break
        active.append(best)
        while active:
            own = a[:, active]
            gram = own.T @ own
            gram.flat[:: len(active) + 1] += 1e-10  # active columns are independent, if barely
            solved = np.linalg.solve(gram, own.T @ b)
            if solved.min() > 0:
                break
            old = x[active]
            falling = solved <= 0
            step = np.min(old[falling] / np.maximum(old[falling] - solved[falling], 1e-300))
            mixed = old + step * (solved - old)
            x[:] = 0
            keep = mixed > 1e-12 * scale
            if keep.all():
                keep[int(np.argmin(mixed))] = False
            active = [c for c, k in zip(active, keep, strict=True) if k]
            x[active] = mixed[keep]
        x[:] = 0
        if active:
            x[active] = solved
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """Which tails share a sequence, for ``histogram`` = number of tails per bin."""
    units = window // BIN
    left = np.zeros(units + 1, dtype=np.int64)
    for slot, count in histogram.items():
        left[slot] = count
    ways = [w for w in combinations(units) if all(left[s] for s in w)]
    parts: list[Part] = []
    taken = np.zeros(units + 1, dtype=np.int64)
    sequences = 0

    def use(bins: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        slot = 0
        for b, each in bins:
            parts.append(Part(b, int(taken[b]), int(taken[b] + times * each), each, sequences, slot))
            taken[b] += times * each
            left[b] -= times * each
            slot += each
        sequences += times

    if ways:
        grid = np.zeros((units + 1, len(ways)))
        for column, way in enumerate(ways):
            np.add.at(grid[:, column], list(way), 1)
        wanted = nnls(grid, left.astype(np.float64))
        for column in np.argsort(-wanted, kind="stable"):
            bins = [(b, ways[column].count(b)) for b in dict.fromkeys(ways[column])]
            times = min(int(wanted[column] + 1e-6), *(int(left[b] // each) for b, each in bins))
            if times > 0:
                use(bins, times)
    # The rest, largest bins first; a step uses up at least one bin.
    cut: dict[int, int] = {}
    while (present := np.flatnonzero(left[1:]) + 1).size:
        room, bins = units, []
        for b in present[::-1]:
            each = min(int(left[b]), room // int(b))
            if each:
                bins.append((int(b), each))
                room -= each * int(b)
        if room > WASTE * units:
            largest = int(present[-1])
            cut[largest] = int(left[largest])
            left[largest] = 0
        else:
            use(bins, min(int(left[b]) // each for b, each in bins))
    return Plan(parts, sequences, {b: int(taken[b]) for b in range(units + 1) if taken[b]})


# --- pieces ------------------------------------------------------------------


def _numbered(tokens: DataFrame, window: int) -> tuple[DataFrame, dict[int, int], int]:
    """Tokens without ids, with global tail numbers and window numbers; the histogram; the windows."""
    rows = tokens.select("task", "row", "id", "n", "crcs", "tail_bin", "tail_rank", "windows_before")
    full = F.floor(F.col("n") / window)
    # Bin -1 counts whole windows.
    counts = (
        rows.groupBy("task", "tail_bin")
        .agg(F.count("*").alias("c"), F.sum(full).alias("w"))
        .select("task", F.inline(F.array(
            F.struct(F.col("tail_bin").alias("b"), "c"), F.struct(F.lit(-1).alias("b"), F.col("w").alias("c"))
        )))
        .groupBy("task", "b").agg(F.sum("c").alias("c"))
    )
    total = {r.b: r.c for r in counts.groupBy("b").agg(F.sum("c").alias("c")).collect()}
    before = Window.partitionBy("b").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "b", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    tails = base.select("task", F.col("b").alias("tail_bin"), F.col("base").alias("tail_base"))
    windows = base.where("b = -1").select("task", F.col("base").alias("window_base"))
    numbered = (
        rows.join(tails, ["task", "tail_bin"])
        .join(windows, "task")
        .select(
            "task", "row", "id", "n", "crcs", "tail_bin", full.alias("full"),
            (F.col("n") % window).alias("tail"),
            (F.col("tail_base") + F.col("tail_rank")).alias("tail_number"),
            (F.col("window_base") + F.col("windows_before")).alias("first_window"),
        )
    )
    return numbered, {b: c for b, c in total.items() if b > 0}, int(total.get(-1) or 0)


def _placed(tails: DataFrame, own: Plan) -> DataFrame:
    """``tails`` with ``(sequence, slot)`` of the plan; null for tails to be laid end to end."""
    parts = sorted(own.parts, key=lambda p: (p.bin, p.first))
    field = lambda name: np.array([getattr(p, name) for p in parts], dtype=np.int64)
    bins, first, stop, each, base, slot0 = (field(f) for f in Part._fields)
    order = bins * (1 << 48) + first
    columns = tails.columns

    def work(batches):
        for batch in batches:
            b = np.asarray(batch.column("tail_bin"), dtype=np.int64)
            number = np.asarray(batch.column("tail_number"), dtype=np.int64)
            at = np.searchsorted(order, b * (1 << 48) + number, side="right") - 1
            known = at >= 0
            at = np.maximum(at, 0)
            if len(order):
                known &= (bins[at] == b) & (number < stop[at])
                index = number - first[at]
                sequence, slot = base[at] + index // each[at], slot0[at] + index % each[at]
            else:
                sequence = slot = number
            new = [pa.array(x, pa.int64(), mask=~known) for x in (sequence, slot)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*columns, "sequence", "slot"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tails.schema) + ", sequence long, slot long"
    return tails.mapInArrow(work, schema)


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of the documents that :func:`tokenize` stored.

    ``(id, task, row, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: the piece
    holds ``length`` ids of its document from ``start`` on and lies at ``offset`` in its sequence.
    """
    spark = tokens.sparkSession
    numbered, histogram, windows = _numbered(tokens, window)
    own = plan(histogram, window)
    columns = ["id", "task", "row", "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset"]

    whole = numbered.where("full > 0").select(
        "*", F.inline(F.transform(F.sequence(F.lit(0).cast("long"), F.col("full") - 1), lambda i: F.struct(
            (i * window).alias("start"), F.get("crcs", i.cast("int")).alias("ids_crc32"),
            (F.col("first_window") + i).alias("sequence_id"),
        )))
    )
    whole = whole.select("*", F.lit(window).cast("long").alias("length"), F.lit(0).cast("long").alias("offset"))

    tails = numbered.where("tail > 0").select(
        "id", "task", "row", "n", "tail_bin", "tail_number", (F.col("full") * window).alias("start"),
        F.col("tail").alias("length"), F.get("crcs", F.col("full").cast("int")).alias("ids_crc32"),
    )
    placed = stage(_placed(tails, own), staging_path(spark, "tails"))
    behind = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.where("sequence is not null").withColumns({
        "offset": F.coalesce(F.sum("length").over(behind), F.lit(0)), "sequence_id": F.col("sequence") + windows,
    })

    laid = _laid_end_to_end(placed.where("sequence is null"), tokens, window, windows + own.sequences)
    return whole.select(*columns).unionByName(packed.select(*columns)).unionByName(laid.select(*columns))


def _laid_end_to_end(tails: DataFrame, tokens: DataFrame, window: int, first_sequence: int) -> DataFrame:
    """Tails one behind the other, cut where a sequence is full."""
    sums = tails.groupBy("task").agg(F.sum("length").alias("s")).withColumn("all", F.lit(0))
    before = Window.partitionBy("all").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("task", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("length").over(inside), F.lit(0))
    row = tails.join(base, "task").withColumn("at", at)
    room = window - F.col("at") % window
    own = F.struct(F.lit(0).cast("long").alias("d"), F.least("length", room).alias("l"))
    rest = F.struct(room.alias("d"), (F.col("length") - room).alias("l"))
    pieces = row.select(
        "*", F.inline(F.when(F.col("length") > room, F.array(own, rest)).otherwise(F.array(own)))
    ).select(
        "id", "task", "row", "n", (F.col("start") + F.col("d")).alias("start"), F.col("l").alias("length"),
        F.when(F.col("l") == F.col("length"), F.col("ids_crc32")).alias("ids_crc32"),
        (F.floor((F.col("at") + F.col("d")) / window) + first_sequence).alias("sequence_id"),
        ((F.col("at") + F.col("d")) % window).alias("offset"),
    )
    # Few pieces are cut tails: they are sent to the ids instead of shuffling all ids.
    pieces = stage(pieces, staging_path(tokens.sparkSession, "laid"))
    cut = piece_ids(small_side(pieces.where("ids_crc32 is null").drop("ids_crc32")), tokens)
    return pieces.where("ids_crc32 is not null").unionByName(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def piece_ids(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pieces`` with their ``ids``, four little-endian bytes each."""
    stored = tokens.select("task", "row", F.col("ids").alias("all_ids"), F.col("n").alias("all_n"))
    width = (F.length("all_ids") / F.col("all_n")).cast("int")
    joined = pieces.join(stored, ["task", "row"]).withColumns({
        "ids": F.substring("all_ids", (F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int")),
        "width": width,
    }).drop("all_ids", "all_n")

    def widen(batches):
        for batch in batches:
            names = batch.schema.names
            at = names.index("ids")
            width = batch.column("width").to_pylist()
            wide = [
                np.frombuffer(x, dtype=f"<u{w}").astype("<u4").tobytes()
                for x, w in zip(batch.column(at).to_pylist(), width, strict=True)
            ]
            batch = batch.set_column(at, pa.field("ids", pa.binary()), pa.array(wide, pa.binary()))
            yield batch.drop_columns(["width"])

    return joined.mapInArrow(widen, joined.drop("width").schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents; see :func:`pack`.  Sequences are padded to the window by their reader."""
    pieces = pack(tokenize(docs, tokenizer, id_col, text_col, end_id, window), window)
    return pieces.drop("task", "row").withColumnRenamed("id", id_col)
