"""Similarity join of word n-gram sets by vertical partitioning of the global n-gram order.

Two sets link when ``den * |x n y| >= num * |x u y|``.

*Candidates.*  The global order is that of 64-bit n-gram hashes.  It is cut into fragments,
more of them than two linking sets can have different n-grams (``d``): with ``d + 1 + e``
fragments at least ``e + 1`` hold exactly the same n-grams in both.  So a document's
signatures are its fragments' contents, hashed, and a set with ``h`` empty fragments needs to
share ``e + 1 - h`` signatures, at least one; only sets with more than ``e`` empty ones sign
those too.  The number of fragments belongs to a size class, and a document signs for every
class its partners may belong to.  One range sort of all signatures shows which documents
share one.  A signature of few sets yields their pairs; those of many are counted per set.
Pairs that may share as many signatures as both need are candidates; sets that could do so by
signatures of many sets alone go to the way for crowds, below.

*Counts.*  Partial overlaps are counted per fragment and summed per pair.  A pair is first
bounded from short hashes of 256 fragments (each unequal one is a difference) and, if it
passes, counted on the n-grams themselves.

*Crowds.*  Among near copies of one text all pairs would be too many.  There the order is
by ascending frequency, and two sets can only link if they share an n-gram early in it
(prefix and position filters).  Every such n-gram first pairs its sets with one hub, the
set with the fewest n-grams of its own; links found so far make components, and only sets
of different components are paired again.

Sets are identified by 128-bit fingerprints, so exact copies are one set and never paired.

Defined results: null or empty text, and text without words, is an empty set that links
with nothing; a text of fewer than ``width`` words is one n-gram; repeated rows and ids
are rows of their own; a null id never names a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.batches import mix, shingle_sets, slices, small_side, two_columns
from postlens.llm.components import components
from postlens.sources.staging import remove, stage, staging_path

# Sets that share one signature and are paired directly; larger groups go to the way for crowds.
GROUP = 16

# One fragment more for so many, all of which linking sets need to share: few pairs of a common phrase do.
SURPLUS = 6

# Ratio of neighbouring size classes, fragments of the bounding sketch, fragments of the count.
RATIO = 1.5
SKETCH = 256
FRAGMENTS = 4


class Similarity(NamedTuple):
    """A Jaccard similarity of at least ``num / den``."""

    num: int
    den: int

    def difference(self, total):
        """Most n-grams that two linking sets of ``total`` n-grams together do not share."""
        return total - 2 * (-(-self.num * total // (self.num + self.den)))


def size_classes(largest: int) -> np.ndarray:
    """First sizes of the classes, beyond ``largest`` by one class."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * RATIO)))
    return np.array(bounds + [max(bounds[-1] + 1, int(bounds[-1] * RATIO))], dtype=np.int64)


def fragment_counts(bounds: np.ndarray, sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Per class ``(fragments, empty ones allowed)``; no fragments where only equal sets link."""
    largest = bounds[1:] - 1
    d = largest * (sim.den - sim.num) // sim.num
    allowed = 1 + np.ceil(2 * (d + 1) * np.exp(-bounds[:-1] / (d + 1))).astype(np.int64) + (d + 1) // SURPLUS
    return np.where(d > 0, d + 1 + allowed, 0), allowed


def signatures(sets: list[np.ndarray], sim: Similarity) -> tuple[list[np.ndarray], np.ndarray]:
    """Per set, the hashes of its fragments' contents for every size class it signs for, and its need.

    Two linking sets share at least as many signatures as either of them needs.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    found: list[list[np.ndarray]] = [[] for _ in sets]
    needs = np.full(len(sets), np.iinfo(np.int64).max)
    bounds = size_classes(int(sizes.max(initial=1)))
    fragments, allowed = fragment_counts(bounds, sim)
    top = np.searchsorted(bounds, sizes, side="right") - 1
    low = np.searchsorted(bounds, -(-sim.num * sizes // sim.den), side="right") - 1
    step = 0
    while True:
        own = np.flatnonzero((sizes > 0) & (top - step >= np.maximum(low, 0)))
        if not len(own):
            return [np.concatenate(f) if f else np.empty(0, np.uint64) for f in found], needs
        kind = top[own] - step
        step += 1
        usable = fragments[kind] > 0
        own, kind = own[usable], kind[usable]
        if not len(own):
            continue
        grams = np.concatenate([sets[i] for i in own])
        row = np.repeat(np.arange(len(own)), sizes[own])
        fragment = ((grams >> np.uint64(32)) * fragments[kind][row].astype(np.uint64)) >> np.uint64(32)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(row) > 0) | (np.diff(fragment.view(np.int64)) != 0)]))
        place = (kind[row[new]].astype(np.uint64) << np.uint64(32)) | fragment[new]
        signs = mix(np.add.reduceat(mix(grams), new) ^ mix(place + np.uint64(1)))
        ends = np.searchsorted(row[new], np.arange(1, len(own) + 1))
        for j, (lo, hi) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)):
            found[own[j]].append(signs[lo:hi])
            empty = fragments[kind[j]] - (hi - lo)
            needs[own[j]] = min(needs[own[j]], max(1, allowed[kind[j]] + 1 - empty))
            if fragments[kind[j]] - (hi - lo) > allowed[kind[j]]:
                holes = np.setdiff1d(np.arange(fragments[kind[j]]), fragment[new[lo:hi]].astype(np.int64))
                holes = (np.uint64(kind[j]) << np.uint64(32)) | holes.astype(np.uint64)
                found[own[j]].append(mix(~mix(holes + np.uint64(1))))


_OTHER = np.uint64(0xA0761D6478BD642F)


def fingerprints(sets: list[np.ndarray]) -> list[bytes]:
    """128 bits of each set's content; equal sets have equal ones."""
    out = []
    for s in sets:
        pair = np.array([mix(s).sum(dtype=np.uint64), mix(s ^ _OTHER).sum(dtype=np.uint64) + np.uint64(len(s))], ">u8")
        out.append(pair.tobytes())
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A byte per set and fragment of the order; different bytes mean different contents."""
    out = np.zeros((len(sets), SKETCH), dtype=np.uint8)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    if len(row):
        grams = np.concatenate(sets)
        cell = row * SKETCH + (grams >> np.uint64(56)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], np.diff(cell) != 0]))
        out.ravel()[cell[new]] = mix(np.add.reduceat(mix(grams ^ _OTHER), new)).astype(np.uint8)
    return out


def _short(fingerprint: bytes) -> int:
    return int.from_bytes(fingerprint[:8], "big", signed=True)


def _describe(docs: DataFrame, id_col: str, text_col: str, width: int, sim: Similarity) -> DataFrame:
    """``(id, n, node, f, sketch, need, signs)`` per row.  Copies within a task sign once."""
    source = two_columns(docs, id_col, text_col)
    key = source.schema["k"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed: set[bytes] = set()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("v"), width)
                nodes = fingerprints(sets)
                first = []
                for i, node in enumerate(nodes):
                    if len(sets[i]) and node not in signed:
                        signed.add(node)
                        first.append(i)
                own = [sets[i] for i in first]
                signs: list = [None] * len(sets)
                marks: list = [None] * len(sets)
                needs = np.zeros(len(sets), dtype=np.int64)
                found, needs[first] = signatures(own, sim)
                for i, s, m in zip(first, found, sketches(own), strict=True):
                    signs[i], marks[i] = s.view(np.int64), m.tobytes()
                columns = [
                    part.column("k"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array([_short(x) for x in nodes], pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.array(needs),
                    pa.array(signs, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "node", "f", "sketch", "need", "signs"])

    schema = f"id {key}, n long, node binary, f long, sketch binary, need long, signs array<long>"
    return source.mapInArrow(work, schema)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b, shared, need)`` of sets that share signatures, from rows sorted by ``(sign, f)``.

    A signature of more than ``GROUP`` sets, and the first and the last of a task, which may
    go on in another one, give ``(a, null, shared)`` for each of their sets: how many such it has.
    """
    sign, f, need = (np.empty(0, np.int64) for _ in range(3))
    edge = True  # the first signature kept is the task's first

    def emit(sign, f, need, first_edge, last_edge):
        starts = np.flatnonzero(np.concatenate([[True], np.diff(sign) != 0]))
        length = np.diff(np.append(starts, len(sign)))
        crowd = length > GROUP
        if first_edge:
            crowd[0] = True
        if last_edge:
            crowd[-1] = True
        crowd = np.repeat(crowd, length)
        pairs = [np.empty((0, 3), np.int64)]
        for d in range(1, GROUP):
            same = np.flatnonzero((sign[d:] == sign[:-d]) & ~crowd[d:])
            pairs.append(np.column_stack([f[same], f[same + d], np.maximum(need[same], need[same + d])]))
        pairs, shared = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
        lone, times = np.unique(f[crowd], return_counts=True)
        nothing = np.zeros(len(lone), np.int64)
        missing = np.concatenate([np.zeros(len(pairs), bool), np.ones(len(lone), bool)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([pairs[:, 0], lone])),
                pa.array(np.concatenate([pairs[:, 1], nothing]), mask=missing),
                pa.array(np.concatenate([shared, times])),
                pa.array(np.concatenate([pairs[:, 2], nothing])),
            ],
            ["a", "b", "shared", "need"],
        )

    for batch in batches:
        sign = np.concatenate([sign, np.asarray(batch.column("sign"))])
        f = np.concatenate([f, np.asarray(batch.column("f"))])
        need = np.concatenate([need, np.asarray(batch.column("need"))])
        fresh = np.concatenate([[True], (np.diff(sign) != 0) | (np.diff(f) != 0)])[: len(sign)]
        sign, f, need = sign[fresh], f[fresh], need[fresh]
        if not len(sign):
            continue
        last = int(np.searchsorted(sign, sign[-1], side="left"))
        if last:
            yield emit(sign[:last], f[:last], need[:last], edge, False)
            sign, f, need, edge = sign[last:], f[last:], need[last:], False
        elif len(sign) > 100_000:
            # One signature only: its sets are a crowd; one more than a group of them keeps it so.
            yield emit(sign, f, need, True, True)
            sign, f, need = (x[-GROUP - 1 :] for x in (sign, f, need))
    if len(sign):
        yield emit(sign, f, need, edge, True)


def _bounded(pairs: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs whose sketches and sizes do not rule a link out."""

    def work(batches):
        for batch in batches:
            total = np.asarray(batch.column("n1")) + np.asarray(batch.column("n2"))
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("s1", "s2")
            )
            unequal = (one != two).sum(axis=1)
            kept = pa.array(unequal <= sim.difference(total))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["x", "y"]).filter(kept)

    close = pairs.where(
        (F.col("n1") * sim.den >= F.col("n2") * sim.num) & (F.col("n2") * sim.den >= F.col("n1") * sim.num)
    )
    return close.select("x", "y", "n1", "n2", "s1", "s2").mapInArrow(work, "x binary, y binary")


def _sets(docs: DataFrame, nodes: DataFrame, described: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(node, n, grams)`` of the given nodes, stored; each is read again from one of its documents."""
    spark = docs.sparkSession
    ids = described.select("id", "node").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
    ids = stage(ids.select(F.col("id").alias("wanted")).distinct(), staging_path(spark, "wanted"))
    texts = two_columns(docs, id_col, text_col)
    texts = texts.join(small_side(ids), texts.k.eqNullSafe(ids.wanted), "left_semi").select("v")

    def work(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("v"), width)
                grams = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(sets), pa.binary()), grams], ["node", "grams"])

    found = texts.mapInArrow(work, "node binary, grams array<long>").join(nodes, "node", "left_semi")
    found = found.dropDuplicates(["node"]).select("node", F.size("grams").cast("long").alias("n"), "grams")
    return stage(found, staging_path(spark, "sets"))


def _linked(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs ``(x, y)`` that link: overlaps are counted per fragment of the order and summed."""
    width = (1 << 64) // FRAGMENTS
    # Hashes are unsigned; as signed numbers their order is cut at the same places, rotated.
    cuts = [-(1 << 63) + i * width for i in range(FRAGMENTS + 1)]
    inside = lambda lo, hi: F.filter("grams", lambda g: (g >= lo) & (g <= hi))
    part = [inside(lo, hi - 1) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    cells = sets.select("node", "n", F.posexplode(F.array(*part)).alias("fragment", "cell"))
    left = cells.select(F.col("node").alias("x"), F.col("n").alias("n1"), "fragment", F.col("cell").alias("c1"))
    right = cells.select(F.col("node").alias("y"), F.col("n").alias("n2"), "fragment", F.col("cell").alias("c2"))
    overlap = F.size(F.array_intersect("c1", "c2"))
    return (
        pairs.join(left, "x").join(right, ["y", "fragment"])
        .groupBy("x", "y").agg(F.sum(overlap).alias("shared"), F.max("n1").alias("n1"), F.max("n2").alias("n2"))
        .where(F.col("shared") * (sim.num + sim.den) >= sim.num * (F.col("n1") + F.col("n2")))
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )


def _prefixes(sets: DataFrame, sim: Similarity) -> DataFrame:
    """``(gram, node, n, pos, rare)``: each set's shared n-grams early in the order by frequency, stored.

    ``rare`` is the number of n-grams that no other of the given sets has; they come first.
    """
    grams = sets.select("node", "n", F.explode("grams").alias("gram"))
    frequent = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    prefix = (F.col("n") * (sim.den - sim.num) / sim.den).cast("long") + 1
    ranked = (
        grams.join(frequent, "gram")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("own"))
        .withColumn("rare", F.col("n") - F.size("own"))
        .where(F.col("rare") < prefix)
        .withColumn("own", F.slice("own", 1, (prefix - F.col("rare")).cast("int")))
        .select("node", "n", "rare", F.posexplode("own").alias("at", "item"))
    )
    rows = ranked.select(F.col("item.gram").alias("gram"), "node", "n", (F.col("rare") + F.col("at")).alias("pos"), "rare")
    return stage(rows, staging_path(sets.sparkSession, "prefixes"))


def _may_link(sim: Similarity):
    """Size and position filter for two prefix rows with the columns of ``one`` and ``two``."""
    total = F.col("n1") + F.col("n2")
    needed = F.ceil(total * sim.num / (sim.num + sim.den) - 1e-9)
    rest = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    return (
        (F.col("n1") * sim.den >= F.col("n2") * sim.num) & (F.col("n2") * sim.den >= F.col("n1") * sim.num) & (rest >= needed)
    )


def _pairs(frame: DataFrame) -> DataFrame:
    return frame.select(F.least("one", "two").alias("x"), F.greatest("one", "two").alias("y")).distinct()


def _crowd_links(sets: DataFrame, known: DataFrame, sim: Similarity) -> DataFrame:
    """Links among sets that share a signature with many others; ``known`` are links found before."""
    spark = sets.sparkSession
    rows = _prefixes(sets, sim)
    hubs = rows.groupBy("gram").agg(F.min(F.struct("rare", "node", "n", "pos")).alias("hub"), F.count("*").alias("c"))
    hubs = hubs.where("c > 1").select(
        "gram", F.col("hub.node").alias("one"), F.col("hub.n").alias("n1"), F.col("hub.pos").alias("pos1")
    )
    members = rows.select("gram", F.col("node").alias("two"), F.col("n").alias("n2"), F.col("pos").alias("pos2"))
    stars = hubs.join(members, "gram").where((F.col("one") != F.col("two")) & _may_link(sim))
    first = stage(_linked(_pairs(stars), sets, sim), staging_path(spark, "links"))
    labels = components(first.unionByName(known))
    named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = stage(named, staging_path(spark, "prefixes"))
    mixed = named.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("gram")
    open_rows = named.join(mixed, "gram", "left_semi")
    side = lambda k, name: open_rows.select(
        "gram", F.col("node").alias(name), F.col("n").alias(f"n{k}"), F.col("pos").alias(f"pos{k}"), F.col("label").alias(f"l{k}")
    )
    crossing = side(1, "one").join(side(2, "two"), "gram").where((F.col("l1") < F.col("l2")) & _may_link(sim))
    return first.unionByName(_linked(_pairs(crossing), sets, sim))


def _components(docs, id_col, text_col, width, sim) -> DataFrame:
    """``(id, n, node, label)`` per row; the label is a node of the row's component."""
    spark = docs.sparkSession
    path = lambda name: staging_path(spark, name)
    signed = path("signed")
    described = stage(_describe(docs, id_col, text_col, width, sim), signed)
    signs = described.where("signs is not null").select(F.explode("signs").alias("sign"), "f", "need")
    ordered = signs.repartitionByRange("sign", "f").sortWithinPartitions("sign", "f")
    near = stage(ordered.mapInArrow(_neighbours, "a long, b long, shared long, need long"), path("near"))
    # The signatures are the largest table and are no longer needed.
    described = stage(described.drop("signs"), path("described"))
    remove(spark, signed)
    marked = described.where("sketch is not null").select("f", "node", "n", "sketch")
    # What two sets share are signatures counted per pair, and at most the fewer of both sets' crowded ones.
    crowded = near.where("b is null").groupBy("a").agg(F.sum("shared").alias("crowded"))
    crowded = stage(crowded.withColumnRenamed("a", "f"), path("crowded"))
    inside = near.where("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
    times = lambda k: crowded.select(F.col("f").alias(k), F.col("crowded").alias(f"{k}_times"))
    inside = inside.join(times("a"), "a", "left").join(times("b"), "b", "left")
    most = F.col("shared") + F.least(F.coalesce("a_times", F.lit(0)), F.coalesce("b_times", F.lit(0)))
    inside = stage(inside.where(most >= F.col("need")).select("a", "b"), path("candidates"))
    one = marked.select(F.col("f").alias("a"), F.col("node").alias("x"), F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    two = marked.select(F.col("f").alias("b"), F.col("node").alias("y"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    pairs = stage(
        _bounded(inside.join(one.dropDuplicates(["x"]), "a").join(two.dropDuplicates(["y"]), "b"), sim), path("pairs")
    )
    # Sets that could link by crowded signatures alone.
    able = described.where("sketch is not null").select("f", "node", "need").join(crowded, "f").where("crowded >= need")
    crowd = stage(able.select("node").distinct(), path("crowd"))
    nodes = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).unionByName(crowd)
    sets = _sets(docs, nodes.distinct(), described, id_col, text_col, width)
    links = stage(_linked(pairs, sets, sim), path("links"))
    further = _crowd_links(sets.join(crowd, "node", "left_semi"), links, sim)
    labels = components(links.unionByName(further))
    rows = described.select("id", "n", "node")
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def link_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, sim: Similarity = Similarity(9, 10)
) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row: the smallest id that links reach."""
    rows = stage(_components(docs, id_col, text_col, width, sim), staging_path(docs.sparkSession, "rows"))
    names = rows.where("n > 0").groupBy("label").agg(F.min("id").alias("component_id"))
    full = rows.where("n > 0").join(names, "label").select("id", "n", "component_id")
    lone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(lone).withColumnsRenamed({"id": id_col, "n": "n_shingles"})


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, sim: Similarity = Similarity(8, 10)
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; all columns stay as they are.

    Rows without words all stay.  Rows that share an id are told apart by their text; of
    equal ones one stays.
    """
    spark, columns = docs.sparkSession, docs.columns
    rows = stage(_components(docs, id_col, text_col, width, sim), staging_path(spark, "rows"))
    best = rows.where("n > 0").groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("best")
    )
    kept = best.select(F.col("best.id").alias("id"), F.col("best.node").alias("node"))
    repeated = rows.groupBy("id").agg(F.count("*").alias("c")).where((F.col("c") > 1) | F.col("id").isNull()).select("id")
    gone = rows.where("n > 0").join(kept, rows.id.eqNullSafe(kept.id) & (rows.node == kept.node), "left_anti")
    gone = stage(gone.select("id").distinct(), staging_path(spark, "gone"))
    repeated = stage(repeated, staging_path(spark, "repeated"))
    named = lambda frame: frame.select(F.col("id").alias("__id"))
    match = F.col(id_col).eqNullSafe(F.col("__id"))
    leave = stage(gone.unionByName(repeated).distinct(), staging_path(spark, "leave"))
    plain = docs.join(small_side(named(leave)), match, "left_anti")
    if repeated.isEmpty():
        return plain

    at = columns.index(text_col)

    def work(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                sets = shingle_sets(part.column(at).fill_null(""), width)
                node = [x if len(s) else None for x, s in zip(fingerprints(sets), sets, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(node, pa.binary())], [*columns, "__node"])

    from pyspark.sql.types import BinaryType, StructType

    odd = docs.join(named(repeated), match, "left_semi")
    odd = odd.mapInArrow(work, StructType([*docs.schema.fields]).add("__node", BinaryType()))
    first = F.row_number().over(Window.partitionBy(id_col, "__node").orderBy(id_col)).alias("__first")
    named_kept = kept.select(F.col("id").alias("__id"), F.col("node").alias("__keep"))
    chosen = odd.join(named_kept, match & (F.col("__node") == F.col("__keep")), "left_semi").select("*", first)
    chosen = chosen.where("__first = 1").select(*columns)
    return plain.unionByName(chosen).unionByName(odd.where("__node is null").select(*columns))
