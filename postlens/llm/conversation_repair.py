"""Conversation structure repair: the cheapest edits that make turns alternate, least audit first.

A conversation's rows are edited (keep, change the role, delete, insert) until the roles'
initials are ``(s?(ua)+)?``.  The *audit* is the string of the edits' initials.

1. Rows are ordered by conversation and turn with one range exchange, which also divides a
   conversation of very many rows, and cut into *segments* of at most ``SEGMENT_ROWS`` rows.
2. A node is a row and a state: nothing yet, system, user, assistant.  The cost program
   runs from the last row to the first, for all segments of a batch side by side.
3. Nodes are ranked by their cheapest audits: first by one edit, then, by pairs of ranks and
   doubled pointers, by two, four, eight edits.  An edit leads from a node to one node only,
   so the least beginning of any length has one end, and following the doubled pointers
   lays out the least audit.
4. A segment that holds its whole conversation is done in its batch.  For others, the costs
   from each of four states to each are a small matrix.  A fold over the matrices of a
   conversation gives each segment the costs behind it, and a fold over the states at which
   the audits leave the segments tells each where it begins.  Only such matrices and states
   of a conversation meet in one task, a few numbers per ``SEGMENT_ROWS`` rows.
5. Hashes of long conversations are taken over their segments in order, as a stream.

Defined results: a null role, text, turn or id reads as one space where it is hashed or
written; null turns come first and count for no gap; rows of one turn are in order of role, then
of a hash of their text; repeated rows are rows of their own (the later ones duplicates);
texts of any length are read whole; conversations with null id are one, whose id stays null;
an empty table gives no rows; other columns are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import bounded
from postlens.sources.staging import stage, staging_path

# Costs of the edits, faults, and the characters that end a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FINE, BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = range(4)
SPACES, ENDS = " \t\n\x0b\f\r", ".!?"
LEGAL = {"su", "ua", "au"}

# Rows of a segment, and characters of its texts beyond which it is closed.
SEGMENT_ROWS, SEGMENT_CHARS = 4096, 1 << 22

# States: what was written last.  From a state, a new or changed row becomes a user's or an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
NO = 1 << 40  # a cost that no audit reaches

# Edits in ASCII order, so the number of an edit is its rank.
EDITS = "DIKR"


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, gone)``: the rows with one fault in four planted, by ``crc32(conv_id:turn) % 20``.

    0 drops a row (``gone``, so its conversation stays known), 1 empties its text, 2 removes
    sentence ends, 3 repeats the row, 4 makes it a user's.
    """
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(word(conv_id), F.lit(":"), word(turn)).cast("binary")) % 20
    own = bounded(rows).select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), word(role).alias("role"), word(text).alias("text"), fault.alias("fault")
    )
    changed = own.select(
        "conv", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("gone"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


# --- segments ----------------------------------------------------------------


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Stored segments of ``rows (conv, turn, role, text, gone)``, numbered in order.

    ``open`` segments may not hold their whole conversation.  ``faults`` knows no duplicates
    yet, ``prints`` are hashes of role and text.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.col("gone")]
    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        # A partition's first conversation may have begun before it; its last one may go on.
        conv, own, chars, first, cut = None, [], 0, True, False
        out: list[dict] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "gone")]
            for name, *row in zip(*columns, strict=True):
                full = len(own) >= segment_rows or chars >= SEGMENT_CHARS
                if own and (name != conv or full):
                    out.append(_segment(conv, number, own, first or cut or name == conv))
                    number, first, cut = number + 1, first and name == conv, name == conv
                    own, chars = [], 0
                conv = name
                own.append(row)
                chars += len(row[2])
            yield from _written(out, schema)
            out = []
        if own:
            yield from _written([_segment(conv, number, own, True)], schema)

    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    ddl = (
        f"conv {conv_type}, seg long, open boolean, turns array<{turn_type}>, roles array<string>, texts array<string>, "
        "faults binary, prints array<binary>"
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = spark.createDataFrame([], ddl)
    schema = to_arrow_schema(empty.schema)
    return stage(ordered.mapInArrow(work, empty.schema), staging_path(spark, "segments"))


def _segment(conv, number: int, rows: list, is_open: bool) -> dict:
    kept = [r for r in rows if not r[3]]
    faults, prints = bytearray(), []
    for _, role, text, _ in kept:
        seen = text.rstrip(SPACES)
        faults.append(BLANK_ROW if not seen else FINE if seen[-1] in ENDS else TRUNCATED_ROW)
        prints.append(xxhash.xxh3_128_digest(f"{len(role)}:{role}:{text}".encode()))
    return {
        "conv": conv, "seg": number, "open": is_open, "turns": [r[0] for r in kept], "roles": [r[1] for r in kept],
        "texts": [r[2] for r in kept], "faults": bytes(faults), "prints": prints,
    }


def _written(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


# --- costs and ranks, for many segments at a time ----------------------------


class Rows:
    """Rows of some segments as matrices (segment, row); segments are padded at the end."""

    def __init__(self, faults: list[bytes], roles: list[list[str]]):
        self.size = np.array([len(f) for f in faults], dtype=np.int64)
        most = int(self.size.max(initial=0))
        self.fault = np.zeros((len(faults), most), dtype=np.int64)
        initial = np.zeros((len(faults), most), dtype=np.int64)
        for i, (own, names) in enumerate(zip(faults, roles, strict=True)):
            self.fault[i, : len(own)] = np.frombuffer(own, dtype=np.uint8)
            initial[i, : len(own)] = [_INITIAL.get(r[:1], 0) for r in names]
        self.initial = initial

    def arcs(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the rows ``at``: cost of keeping per state and the state then, and cost of changing the role."""
        fault, initial = self.fault[:, at], self.initial[:, at]
        late = np.where(fault == TRUNCATED_ROW, TRUNCATED, 0)
        usable = (fault != BLANK_ROW) & (fault != DUPLICATE_ROW)
        keep = np.full((len(fault), 4), NO)
        # A user's row may follow anything but a user's, an assistant's only that, a system's nothing.
        for state in (START, SYSTEM, ASSISTANT):
            keep[:, state] = np.where(usable & (initial == USER), late, NO)
        keep[:, USER] = np.where(usable & (initial == ASSISTANT), late, NO)
        keep[:, START] = np.where(usable & (initial == SYSTEM), late, keep[:, START])
        then = np.where(initial == SYSTEM, SYSTEM, NEXT[:, None]).T
        return keep, then, np.where(usable, late + REROLE, NO)


_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    """Costs ``[segment, state, ...]`` when rows may be inserted first."""
    out = cost.copy()
    out[:, USER] = np.minimum(cost[:, USER], INSERT + cost[:, ASSISTANT])
    out[:, ASSISTANT] = np.minimum(cost[:, ASSISTANT], INSERT + cost[:, USER])
    for state in (START, SYSTEM):
        out[:, state] = np.minimum(cost[:, state], INSERT + out[:, USER])
    return out


def cost_table(rows: Rows, behind: np.ndarray) -> np.ndarray:
    """``[row, segment, state, ...]``: least costs to the end, for the costs ``behind`` each segment.

    Row ``size`` of a segment has what lies behind it.  All segments step back together, from
    the longest one's last row.
    """
    most = rows.fault.shape[1]
    table = np.empty((most + 1, *behind.shape), dtype=np.int64)
    table[most] = behind
    extra = (...,) + (None,) * (behind.ndim - 2)
    for at in range(most - 1, -1, -1):
        later = table[at + 1]
        keep, then, change = rows.arcs(at)
        kept = keep[extra] + np.take_along_axis(later, np.broadcast_to(then[extra], later.shape), axis=1)
        changed = change[:, None][extra] + later[:, NEXT]
        here = _with_inserts(np.minimum(np.minimum(DELETE + later, kept), changed))
        inside = (at < rows.size)[:, None][extra]
        table[at] = np.minimum(np.where(inside, here, behind), NO)
    return table


def least_audits(rows: Rows, table: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """``(ranks, pointers, letters)`` of the nodes on cheapest ways; ``ends[segment]`` tells where inserts may end it.

    Nodes are numbered ``(row * segments + segment) * 4 + state``.  ``pointers[k]`` lead ``2**k`` edits
    on, and nodes are ranked by the least audits of that many edits; a node at the end leads to itself.
    """
    most, count = rows.fault.shape[1], len(rows.size)
    number = np.arange((most + 1) * count * 4).reshape(most + 1, count, 4)
    best = np.full(number.shape, len(EDITS), dtype=np.int64)
    to = number.copy()

    def offer(at: int, edit: str, optimal: np.ndarray, target: np.ndarray) -> None:
        letter = EDITS.index(edit)
        better = optimal & (letter < best[at])
        best[at] = np.where(better, letter, best[at])
        to[at] = np.where(better, target, to[at])

    for at in range(most + 1):
        here = table[at]
        reached = here < NO
        # Behind a segment's last row, only inserts at the end of a conversation are left.
        insert = reached & (here == INSERT + here[:, NEXT]) & ((at < rows.size) | ((at == rows.size) & ends))[:, None]
        offer(at, "I", insert, number[at][:, NEXT])
        if at < most:
            later, inside = table[at + 1], (at < rows.size)[:, None] & reached
            keep, then, change = rows.arcs(at)
            offer(at, "D", inside & (here == DELETE + later), number[at + 1])
            offer(at, "K", inside & (here == keep + np.take_along_axis(later, then, axis=1)), np.take_along_axis(number[at + 1], then, axis=1))
            offer(at, "R", inside & (here == change[:, None] + later[:, NEXT]), number[at + 1][:, NEXT])
    letters = best.ravel()
    # An ended audit comes before all that go on.
    rank, pointer = np.where(letters == len(EDITS), 0, letters + 1), to.ravel()
    pointers = [pointer]
    while True:
        pairs = rank * (int(rank.max(initial=0)) + 1) + rank[pointer]
        _, rank = np.unique(pairs, return_inverse=True)
        if np.array_equal(pointer, further := pointer[pointer]):
            return rank, pointers, letters
        pointer = further
        pointers.append(pointer)


def audits(rows: Rows, behind: np.ndarray, entry: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(audit, state at its end, cost)`` of each segment, entered in the state ``entry``."""
    # At the end of a conversation the costs behind the last row allow for inserts.
    behind = np.where(ends[:, None], _with_inserts(behind), behind)
    table = cost_table(rows, behind)
    _, pointers, letters = least_audits(rows, table, ends)
    count = len(rows.size)
    node = np.arange(count) * 4 + entry
    cost = table.reshape(-1)[node]
    # Doubled pointers lay out the first 1, 2, 4, ... nodes of every audit at once.
    path = node[:, None]
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]], axis=1)
    names = np.frombuffer((EDITS + "\0").encode(), dtype=np.uint8)[letters[path]]
    text = [row.tobytes().partition(b"\0")[0].decode() for row in names]
    return text, path[:, -1] % 4, cost


# --- what the edits make -----------------------------------------------------


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The ``role:text`` rows that an audit leaves or makes, from ``state`` on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role = ("user", "user", "assistant", "user")[state]
        if edit == "I":
            out.append(f"{role}:")
        else:
            out.append(f"{roles[at] if edit == 'K' else role}:{texts[at]}")
        state = SYSTEM if edit == "K" and roles[at][:1] == "s" else int(NEXT[state])
        at += edit != "I"
    return out


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles[:-1], roles[1:], strict=True))


# The costs behind a conversation: what was written is nothing or ends with an assistant's row.
_END = np.array([0, NO, NO, 0])

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _faults(faults: bytes) -> tuple[int, int, int]:
    return faults.count(BLANK_ROW), faults.count(DUPLICATE_ROW), faults.count(TRUNCATED_ROW)


def _whole(closed: DataFrame) -> DataFrame:
    """Results of conversations that lie in one segment each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _similar_sizes(batch):
                turns, roles, texts, prints = (part.column(c).to_pylist() for c in ("turns", "roles", "texts", "prints"))
                faults = []
                for own, names in zip(part.column("faults").to_pylist(), prints, strict=True):
                    seen: set = set()
                    marked = bytearray(own)
                    for i, name in enumerate(names):
                        if own[i] != BLANK_ROW and name in seen:
                            marked[i] = DUPLICATE_ROW
                        seen.add(name)
                    faults.append(bytes(marked))
                count = len(faults)
                own = audits(Rows(faults, roles), np.tile(_END, (count, 1)), np.full(count, START), np.full(count, True))
                out = []
                for i, (audit, cost) in enumerate(zip(own[0], own[2], strict=True)):
                    known = [t for t in turns[i] if t is not None]
                    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
                    made = "\n".join(repaired(audit, START, roles[i], texts[i]))
                    out.append([gaps, *_faults(faults[i]), _illegal(roles[i]), int(cost), audit, hashlib.sha256(made.encode()).hexdigest()])
                columns = [pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:6]] + [pa.array(c, pa.string()) for c in list(zip(*out, strict=True))[6:]]
                yield pa.RecordBatch.from_arrays([part.column("conv"), *columns], ["conv", *(f.split()[0] for f in _RESULT.split(", "))])

    conv_type = closed.schema["conv"].dataType.simpleString()
    return closed.mapInArrow(work, f"conv {conv_type}, {_RESULT}")


# Cells of the padded matrices of a part.
CELLS = 1 << 18


def _similar_sizes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of segments of similar size, so that padding stays small."""
    sizes = np.array([len(f) for f in batch.column("faults").to_pylist()], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi - lo + 1) * (sizes[order[hi]] + 1) <= CELLS and sizes[order[hi]] <= 2 * sizes[order[lo]] + 8:
            hi += 1
        yield batch.take(pa.array(order[lo:hi]))
        lo = hi


# --- conversations of several segments ---------------------------------------


def _mark_duplicates(opened: DataFrame) -> DataFrame:
    """Open segments without texts, with duplicates of earlier segments marked; stored."""
    spark = opened.sparkSession
    rows = opened.select("conv", "seg", F.posexplode("prints").alias("at", "print"))
    first = rows.groupBy("conv", "print").agg(F.min(F.struct("seg", "at")).alias("first"))
    firsts = first.groupBy(F.col("first.seg").alias("seg")).agg(F.collect_list("first.at").alias("firsts"))
    joined = opened.select("conv", "seg", "turns", "roles", "faults").join(firsts, "seg", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = []
            for own, firsts in zip(batch.column("faults").to_pylist(), batch.column("firsts").to_pylist(), strict=True):
                later = set(range(len(own))).difference(firsts or ())
                marked.append(bytes(DUPLICATE_ROW if i in later and f != BLANK_ROW else f for i, f in enumerate(own)))
            columns = [batch.column(c) for c in ("conv", "seg", "turns", "roles")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marked, pa.binary())], ["conv", "seg", "turns", "roles", "faults"])

    schema = opened.select("conv", "seg", "turns", "roles", "faults").schema
    return stage(joined.mapInArrow(work, schema), staging_path(spark, "marked"))


def _measures(marked: DataFrame) -> DataFrame:
    """Per segment, its matrix of costs and what counts in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = np.where(np.eye(4, dtype=bool), 0, NO)
        for batch in batches:
            for part in _similar_sizes(batch):
                faults, roles, turns = (part.column(c).to_pylist() for c in ("faults", "roles", "turns"))
                table = cost_table(Rows(faults, roles), np.tile(unit, (len(faults), 1, 1)))
                known = [[t for t in own if t is not None] for own in turns]
                columns = [
                    part.column("conv"), part.column("seg"),
                    pa.array([m.ravel().tolist() for m in table[0]], pa.list_(pa.int64())),
                    *(pa.array(c, pa.int64()) for c in zip(*map(_faults, faults), strict=True)),
                    pa.array(map(_illegal, roles), pa.int64()),
                    pa.array([r[0][:1] if r else None for r in roles], pa.string()),
                    pa.array([r[-1][:1] if r else None for r in roles], pa.string()),
                    pa.array([min(k, default=None) for k in known], pa.int64()), pa.array([max(k, default=None) for k in known], pa.int64()),
                    pa.array([len(set(k)) for k in known], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    conv_type = marked.schema["conv"].dataType.simpleString()
    schema = (
        f"conv {conv_type}, seg long, matrix array<long>, blank long, duplicate long, truncated long, illegal long, "
        "first string, last string, low long, high long, turns long"
    )
    return marked.mapInArrow(work, schema)


def _fold_costs(measures: DataFrame) -> DataFrame:
    """``(conv, seg, behind, ends, gaps, ...)``: costs behind each segment; the counts stand on the last one."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("seg")
        rows = table.to_pylist()
        out = []
        behind = _END
        for i, row in enumerate(reversed(rows)):
            out.append({"conv": row["conv"], "seg": row["seg"], "behind": behind.tolist(), "ends": i == 0})
            if i == 0:
                behind = _with_inserts(behind[None])[0]
            behind = np.minimum((np.array(row["matrix"]).reshape(4, 4) + behind).min(axis=1), NO)
        totals = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
        filled = [r for r in rows if r["first"] is not None]
        totals["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(filled[:-1], filled[1:], strict=True))
        known = [r for r in rows if r["low"] is not None]
        # Segments are in order of turns, so a turn is in two of them only at a border.
        distinct = sum(r["turns"] for r in known) - sum(a["high"] == b["low"] for a, b in zip(known[:-1], known[1:], strict=True))
        totals["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
        for row in out:
            row |= totals if row["ends"] else dict.fromkeys(totals, 0)
        return pa.Table.from_pylist(out, schema)

    conv_type = measures.schema["conv"].dataType.simpleString()
    ddl = f"conv {conv_type}, seg long, behind array<long>, ends boolean, blank long, duplicate long, truncated long, illegal long, gaps long"
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = measures.sparkSession.createDataFrame([], ddl)
    schema = to_arrow_schema(empty.schema)
    return measures.groupBy("conv").applyInArrow(work, empty.schema)


def _ways(marked: DataFrame, folded: DataFrame) -> DataFrame:
    """Per segment and for each state it may be entered in: the audit, the state at its end and the cost; stored."""
    joined = marked.select("seg", "roles", "faults").join(folded, "seg")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _similar_sizes(batch):
                faults, roles = (part.column(c).to_pylist() for c in ("faults", "roles"))
                rows = Rows(faults, roles)
                behind = np.array(part.column("behind").to_pylist(), dtype=np.int64).reshape(-1, 4)
                ends = np.asarray(part.column("ends"))
                found = [audits(rows, behind, np.full(len(faults), q), ends) for q in range(4)]
                names = [c for c in part.schema.names if c not in ("roles", "faults", "behind")]
                columns = [part.column(c) for c in names]
                columns += [pa.array([[f[0][i] for f in found] for i in range(len(faults))], pa.list_(pa.string()))]
                columns += [pa.array([[int(f[k][i]) for f in found] for i in range(len(faults))], pa.list_(pa.int64())) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "audits", "exits", "costs"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.drop("roles", "faults", "behind").schema)
    out = joined.mapInArrow(work, f"{fields}, audits array<string>, exits array<long>, costs array<long>")
    return stage(out, staging_path(marked.sparkSession, "ways"))


def _fold_states(ways: DataFrame) -> DataFrame:
    """``(seg, entry, cost)``: the state in which each segment is entered; the cost stands on a conversation's first."""

    def work(table: pa.Table) -> pa.Table:
        rows = table.sort_by("seg").to_pylist()
        state, out = START, []
        for i, row in enumerate(rows):
            out.append({"seg": row["seg"], "entry": state, "cost": row["costs"][state] if i == 0 else 0})
            state = row["exits"][state]
        return pa.Table.from_pylist(out, pa.schema([("seg", pa.int64()), ("entry", pa.int64()), ("cost", pa.int64())]))

    return ways.select("conv", "seg", "exits", "costs").groupBy("conv").applyInArrow(work, "seg long, entry long, cost long")


def _digests(pieces: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)``: the rows of ``pieces (conv, seg, roles, texts, audit, entry)`` hashed in order, as a stream."""
    partitions = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(partitions, "conv").sortWithinPartitions("conv", "seg")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, filled = None, None, False
        for batch in batches:
            done: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("conv", "roles", "texts", "audit", "entry"))
            for name, roles, texts, audit, entry in zip(*columns, strict=True):
                if state is None or name != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state, filled = name, hashlib.sha256(), False
                made = repaired(audit, entry, roles, texts)
                if made:
                    state.update(("\n" * filled + "\n".join(made)).encode())
                    filled = True
            yield _two(done, batch)
        if state is not None:
            yield _two([(conv, state.hexdigest())], batch)

    conv_type = pieces.schema["conv"].dataType.simpleString()
    return ordered.mapInArrow(work, f"conv {conv_type}, repaired_sha256 string")


def _two(rows: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], like.schema.field("conv").type), pa.array([r[1] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv", "repaired_sha256"])


def _joined(opened: DataFrame) -> DataFrame:
    """Results of conversations whose segments are ``opened``."""
    spark = opened.sparkSession
    marked = _mark_duplicates(opened)
    ways = _ways(marked, _fold_costs(_measures(marked)))
    entered = stage(ways.join(_fold_states(ways), "seg"), staging_path(spark, "entered"))
    own = F.get("audits", F.col("entry").cast("int"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("seg", own.alias("audit")))), lambda r: r["audit"])
    counts = [F.sum(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    results = entered.groupBy("conv").agg(*counts, F.array_join(in_order, "").alias("audit"))
    pieces = opened.select("conv", "seg", "roles", "texts").join(entered.select("seg", own.alias("audit"), "entry"), "seg")
    digests = _digests(pieces).withColumnRenamed("conv", "c")
    return results.join(digests, F.col("conv").eqNullSafe(F.col("c"))).drop("c")


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per conversation of ``rows (conv, turn, role, text, gone)``: its faults, the cheapest repair and the repaired text.

    ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``; see
    :func:`damage` for the columns.  ``gone`` rows only make their conversation known.
    """
    own = segments(rows, segment_rows)
    columns = ["conv", *(f.split()[0] for f in _RESULT.split(", "))]
    whole = _whole(own.where(~F.col("open")))
    return whole.select(*columns).unionByName(_joined(own.where("open")).select(*columns))
