"""Nearest neighbours of a few seeds by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.accumulators import Accumulator, AccumulatorParam
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.sources.staging import stage, staging_path

# The seed words of the similar-words view.
SEED_WORDS = ("depression", "anxiety", "sadness", "tired", "help", "pain", "empty")

# Seeds whose vectors travel to the tasks at a time.
SEED_BLOCK = 4096

# Vectors whose angles to the others order these, and rows that are skipped or scored together.
PIVOTS, ROW_BLOCK = 64, 256

# Rounding of angles near 0 is some 1e-8.
SLACK = 1e-6


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors as rows; the given ones have one length."""
    rows = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(_key, _vec)`` of vectors that have a direction: no null component, not zero."""
    vec = F.col(vector).cast("array<double>")
    known = F.forall(vec, lambda x: x.isNotNull()) & F.exists(vec, lambda x: x != 0)
    return df.select(F.col(key).alias("_key"), vec.alias("_vec")).where(F.col("_key").isNotNull() & known)


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors of ``PIVOTS`` rows chosen by key hash, by length."""
    chosen = rows.orderBy(F.xxhash64("_key"), "_key").limit(PIVOTS).select("_vec").collect()
    by_length: dict[int, list] = {}
    for row in chosen:
        by_length.setdefault(len(row._vec), []).append(list(row._vec))
    return {n: _matrix(pa.array(own)) for n, own in by_length.items()}


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def pivot_order(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``(_key, _vec, _cell, _angle)`` stored in order of the nearest pivot and the angle to it.

    Neighbouring rows then lie at similar angles from one pivot, so blocks of them have
    narrow bounds.  Ranges of the order are dealt to tasks, so a crowded cell is divided.
    """
    spark = rows.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.list_value_length(batch.column("_vec")))
            cell, angle = np.full(len(batch), -1), np.zeros(len(batch))
            for n, own in pivots.items():
                at = np.flatnonzero(lengths == n)
                if len(at):
                    to = _angles(_matrix(batch.column("_vec").take(pa.array(at))), own)
                    cell[at] = to.argmin(axis=1)
                    angle[at] = to.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(angle)], [*batch.schema.names, "_cell", "_angle"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", _cell int, _angle double"
    placed = rows.mapInArrow(work, schema)
    order = [F.size("_vec"), F.col("_cell"), F.col("_angle"), F.col("_key")]
    return stage(placed.repartitionByRange(*order).sortWithinPartitions(*order), staging_path(spark, "pivot-order"))


class _Nearest:
    """The ``k`` nearest rows so far of each seed, and the angle within which a row still matters."""

    def __init__(self, names: list, table: np.ndarray, pivots: np.ndarray | None, k: int):
        self.names, self.table, self.k = names, table, k
        self.at = {name: i for i, name in enumerate(names)}
        self.keys = [[] for _ in names]
        self.scores = [np.empty(0) for _ in names]
        self.to_pivots = None if pivots is None else _angles(table, pivots)
        # Other seeds are rows too, so the k-th nearest of them bounds the k-th nearest row.
        own = table @ table.T
        np.fill_diagonal(own, -np.inf)
        nearest = -np.partition(-own, k - 1, axis=1)[:, k - 1] if len(names) > k else np.full(len(names), -1.0)
        self.limit = np.arccos(np.clip(nearest, -1.0, 1.0)) + SLACK

    def meet(self, keys: pa.Array, vectors: np.ndarray, cell: int, low: float, high: float) -> int:
        """Takes in a block of one cell whose angles to the pivot lie in ``[low, high]``; the pairs skipped."""
        near = np.arange(len(self.names))
        if cell >= 0 and self.to_pivots is not None:
            own = self.to_pivots[:, cell]
            # Triangle inequality on the sphere: no row of the block is nearer than this.
            near = np.flatnonzero(np.maximum(own - high, low - own) <= self.limit)
        if len(near):
            self._keep(near, keys, self.table[near] @ vectors.T)
        return (len(self.names) - len(near)) * len(vectors)

    def _keep(self, near: np.ndarray, keys: pa.Array, score: np.ndarray) -> None:
        # Ties go to the smaller key, so rows are in its order when the best are cut.
        order = np.asarray(pc.sort_indices(keys))
        listed, score = keys.take(pa.array(order)).to_pylist(), score[:, order]
        place = {name: i for i, name in enumerate(listed)}
        for row, seed in enumerate(near):
            own = place.get(self.names[seed])
            if own is not None:
                score[row, own] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, : self.k]
        for row, seed in enumerate(near):
            found = [i for i in best[row] if np.isfinite(score[row, i])]
            merged = sorted([*zip(-self.scores[seed], self.keys[seed]), *((-score[row, i], listed[i]) for i in found)])[: self.k]
            self.keys[seed] = [key for _, key in merged]
            self.scores[seed] = np.array([-s for s, _ in merged])
            if len(merged) == self.k:
                self.limit[seed] = min(self.limit[seed], np.arccos(np.clip(self.scores[seed][-1], -1.0, 1.0)) + SLACK)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(length, cell, low, high, keys, vectors)`` of runs of one cell, of ``ROW_BLOCK`` rows at most."""
    for batch in batches:
        lengths = np.asarray(pc.list_value_length(batch.column("_vec")))
        cells, angles = np.asarray(batch.column("_cell")), np.asarray(batch.column("_angle"))
        edges = np.flatnonzero((np.diff(lengths) != 0) | (np.diff(cells) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(batch)], strict=True):
            for at in range(lo, hi, ROW_BLOCK):
                to = min(hi, at + ROW_BLOCK)
                part = batch.slice(at, to - at)
                yield int(lengths[at]), int(cells[at]), angles[at:to].min(), angles[at:to].max(), part.column("_key"), _matrix(part.column("_vec"))


def _block_neighbours(rows: DataFrame, seeds: list, k: int, key_type: str, pivots: dict, skipped=None) -> DataFrame:
    """Per task, the ``k`` nearest rows of each seed: ``(seed, _key, similarity)``."""
    by_length: dict[int, list] = {}
    for seed in seeds:
        by_length.setdefault(len(seed._vec), []).append(seed)
    tables = {n: ([s._key for s in own], _matrix(pa.array([list(s._vec) for s in own]))) for n, own in by_length.items()}
    sent = rows.sparkSession.sparkContext.broadcast(tables)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = {n: _Nearest(names, table, pivots.get(n), k) for n, (names, table) in sent.value.items()}
        keys_type, left_out, pairs = None, 0, 0
        for length, cell, low, high, keys, vectors in _blocks(batches):
            keys_type = keys.type
            if length in nearest:
                left_out += nearest[length].meet(keys, vectors, cell, low, high)
                pairs += len(nearest[length].names) * len(vectors)
        if skipped is not None:
            skipped.add(np.array([left_out, pairs]))
        if keys_type is None:
            return
        for own in nearest.values():
            sizes = [len(keys) for keys in own.keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name for name, n in zip(own.names, sizes, strict=True) for _ in range(n)], keys_type),
                    pa.array([key for keys in own.keys for key in keys], keys_type),
                    pa.array(np.concatenate([np.empty(0), *own.scores])),
                ],
                ["seed", "_key", "similarity"],
            )

    return rows.mapInArrow(work, f"seed {key_type}, _key {key_type}, similarity double")


class PairCounts(AccumulatorParam):
    """Accumulates ``[skipped, all]`` pairs: ``spark.sparkContext.accumulator(np.zeros(2), PairCounts())``."""

    def zero(self, value):
        return np.zeros(2)

    def addInPlace(self, a, b):
        return a + b


def similar_vectors(
    vectors: DataFrame,
    seeds: Sequence | DataFrame,
    k: int = 10,
    min_similarity: float | None = None,
    key: str = "id",
    vector: str = "vector",
    skipped: Accumulator | None = None,
) -> DataFrame:
    """The ``k`` nearest neighbours of every seed, ties by key: ``(seed, <key>, similarity)``.

    ``seeds`` lists keys of ``vectors``, or is a table with that column; keys are unique.  A
    seed that has no vector gives no row and no error, and a seed is not its own neighbour;
    neither is a zero vector, or one of another length.  The seeds are the query set: their
    vectors are read in blocks of ``SEED_BLOCK``, each of which meets the vectors in one
    scan.  The vectors are stored in order of their angles to pivots, and a block of them is
    skipped, without loss, for seeds that cannot be near any of its rows by the triangle
    inequality on angles; the others are matrix products.  A task keeps ``k`` rows per
    seed.  ``skipped`` (see :class:`PairCounts`) counts the pairs skipped, and all.
    """
    rows = _usable(vectors, key, vector)
    key_type = rows.schema["_key"].dataType.simpleString()
    if isinstance(seeds, DataFrame):
        chosen = rows.join(seeds.select(F.col(key).alias("_key")), "_key", "left_semi")
    else:
        chosen = rows.where(F.col("_key").isin(list(seeds)))
    pivots = _pivots(rows)
    rows = pivot_order(rows, pivots)
    blocks = chosen.count() // SEED_BLOCK + 1
    number = F.pmod(F.xxhash64("_key"), F.lit(blocks))
    scored = None
    for block in range(blocks):
        own = _block_neighbours(rows, chosen.where(number == block).collect(), k, key_type, pivots, skipped)
        scored = own if scored is None else scored.unionAll(own)
    if min_similarity is not None:
        scored = scored.where(F.col("similarity") >= min_similarity)
    nearest = Window.partitionBy("seed").orderBy(F.desc("similarity"), "_key")
    return (
        scored.withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") <= k)
        .select("seed", F.col("_key").alias(key), "similarity")
    )


def best_neighbours(neighbours: DataFrame, key: str = "id", n: int = 50) -> DataFrame:
    """Neighbours over all seeds, each once with its best similarity, top ``n``."""
    return (
        neighbours.groupBy(key)
        .agg(F.max("similarity").alias("similarity"))
        .orderBy(F.desc("similarity"), key)
        .limit(n)
    )


def strongest(neighbours: DataFrame, key: str = "word", n: int = 20) -> DataFrame:
    """The ``n`` highest similarities in rising order, as a bar chart shows them."""
    return neighbours.orderBy(F.desc("similarity"), key).limit(n).orderBy("similarity", F.desc(key))
