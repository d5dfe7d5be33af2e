"""Nearest neighbours by inner product on robust-pruned directed graphs, one per shard.

Distinct vectors are dealt to shards of about ``SHARD_ROWS`` by hash.  In a shard every
vector is inserted twice: a greedy beam search from the shard's centre proposes neighbours,
and robust pruning keeps a near one and drops those that are ``alpha`` times nearer to it
than to the inserted vector, first with ``alpha`` 1, then with ``ALPHA``, so that edges stay
diverse.  Reverse edges are added and pruned alike.  A query searches every shard's graph
with a beam; the shards' best are merged.

Inner products are made distances by one more component, ``sqrt(m^2 - |x|^2)`` with the
shard's largest norm ``m``, which does not change their order for any query.

Equal vectors are indexed once.  No query can have more than ``k`` of them in its result, so
the ``k + 1`` smallest ids of each are kept (one may be the query's own).

Queries are read in blocks of ``QUERY_BLOCK``, each sent to the shards.

Defined results: vectors that are null, zero, or hold a null, NaN or infinite component, and
rows with a null id, take no part, also not as queries; rows that repeat an id and its vector
count once; vectors meet only those of their own length; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.sources.staging import stage, staging_path

SHARD_ROWS = 8192
DEGREE = 32
BUILD_BEAM = 64
QUERY_BEAM = 128
ALPHA = 1.2
QUERY_BLOCK = 8192

# Points inserted or queries searched at a time, and beam entries expanded in a step.
BATCH = 512
EXPAND = 4


class Graph(NamedTuple):
    """``edges[i]`` has the neighbours of vector ``i``, padded with -1; searches begin at ``entry``."""

    vectors: np.ndarray
    edges: np.ndarray
    entry: int


def _augmented(vectors: np.ndarray) -> np.ndarray:
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max() - squares, 0))
    return np.column_stack([vectors, rest]).astype(np.float32)


def beam_search(
    points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int, expand: int = EXPAND
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, nearness)`` of each query's beam, nearest first, and all ``(ids, nearness)`` expanded on the way.

    Nearness is the inner product with ``points``, which have one length in every shard.
    Missing entries have the id -1.
    """
    count, n = len(queries), len(points)
    ids = np.full((count, beam), -1, dtype=np.int64)
    near = np.full((count, beam), -np.inf, dtype=np.float32)
    done = np.ones((count, beam), dtype=bool)
    ids[:, 0], near[:, 0], done[:, 0] = entry, queries @ points[entry], False
    seen = np.zeros((count, n), dtype=bool)
    seen[:, entry] = True
    visited, scores = [], []
    while True:
        # The nearest entries that are not expanded yet, up to ``expand`` a query.
        open_first = np.argsort(done, axis=1, kind="stable")[:, :expand]
        chosen = ~np.take_along_axis(done, open_first, axis=1)
        live = np.flatnonzero(chosen.any(axis=1))
        if not len(live):
            break
        pick = open_first[live]
        heads = np.where(chosen[live], np.take_along_axis(ids[live], pick, axis=1), -1)
        visited_ids = np.full((count, heads.shape[1]), -1, dtype=np.int64)
        visited_near = np.full((count, heads.shape[1]), -np.inf, dtype=np.float32)
        visited_ids[live] = heads
        visited_near[live] = np.where(heads >= 0, np.take_along_axis(near[live], pick, axis=1), -np.inf)
        visited.append(visited_ids)
        scores.append(visited_near)
        marks = done[live]
        np.put_along_axis(marks, pick, True, axis=1)
        done[live] = marks
        new = np.where(heads[:, :, None] >= 0, edges[np.maximum(heads, 0)], -1).reshape(len(live), -1)
        new.sort(axis=1)
        fresh = new >= 0
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        fresh &= ~seen[live[:, None], np.maximum(new, 0)]
        r, c = np.nonzero(fresh)
        found = new[r, c]
        seen[live[r], found] = True
        value = np.full(new.shape, -np.inf, dtype=np.float32)
        value[r, c] = np.einsum("ij,ij->i", points[found], queries[live[r]])
        all_ids = np.concatenate([ids[live], np.where(fresh, new, -1)], axis=1)
        all_near = np.concatenate([near[live], value], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, order, axis=1)
        near[live] = np.take_along_axis(all_near, order, axis=1)
        done[live] = np.take_along_axis(all_done, order, axis=1)
    return ids, near, np.concatenate(visited, axis=1), np.concatenate(scores, axis=1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """At most ``degree`` diverse neighbours for each of ``own`` among its ``candidates`` (-1: none)."""
    candidates = np.sort(candidates, axis=1)
    valid = (candidates >= 0) & (candidates != own[:, None])
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    at = np.maximum(candidates, 0)
    spots = points[at]
    base = ((spots - points[own][:, None, :]) ** 2).sum(axis=2)
    squares = (spots**2).sum(axis=2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(spots, spots.transpose(0, 2, 1))
    out = np.full((len(own), degree), -1, dtype=np.int64)
    rows = np.arange(len(own))
    for slot in range(degree):
        distance = np.where(valid, base, np.inf)
        best = distance.argmin(axis=1)
        alive = np.isfinite(distance[rows, best])
        if not alive.any():
            break
        out[alive, slot] = candidates[alive, best[alive]]
        # Squared distances, so alpha is squared too.
        valid &= alpha * alpha * between[rows, best] > base
        valid[rows, best] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> Graph:
    """The graph of a shard; the same vectors in the same order give the same graph."""
    points = _augmented(vectors)
    n = len(points)
    rng = np.random.default_rng(seed)
    edges = np.full((n, degree), -1, dtype=np.int64)
    if n > 1:
        edges[:, : min(degree, n - 1)] = rng.integers(0, n, (n, min(degree, n - 1)))
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for factor in (1.0, alpha):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            own = order[lo : lo + BATCH]
            # All points have the same norm, so the inner product orders them by distance.
            _, _, visited, near = beam_search(points, edges, entry, points[own], beam)
            keep = np.argsort(-near, axis=1, kind="stable")[:, : 2 * beam]
            pool = np.concatenate([np.take_along_axis(visited, keep, axis=1), edges[own]], axis=1)
            edges[own] = robust_prune(points, own, pool, factor, degree)
            _add_reverse(points, edges, own, factor)
    return Graph(vectors, edges.astype(np.int32), entry)


def _add_reverse(points: np.ndarray, edges: np.ndarray, own: np.ndarray, alpha: float) -> None:
    degree = edges.shape[1]
    to, source = edges[own].ravel(), np.repeat(own, degree)
    real = to >= 0
    to, source = to[real], source[real]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    heads, first, count = np.unique(to, return_index=True, return_counts=True)
    # A head that very many points name takes them in rounds of ``degree``.
    for start in range(0, int(count.max(initial=0)), degree):
        live = count > start
        take = np.minimum(count[live] - start, degree)
        more = np.full((live.sum(), degree), -1, dtype=np.int64)
        row = np.repeat(np.arange(len(take)), take)
        column = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
        more[row, column] = source[np.repeat(first[live] + start, take) + column]
        for lo in range(0, len(more), BATCH):
            part = heads[live][lo : lo + BATCH]
            pool = np.concatenate([edges[part], more[lo : lo + BATCH]], axis=1)
            edges[part] = robust_prune(points, part, pool, alpha, degree)


def search(graph: Graph, queries: np.ndarray, k: int, beam: int = QUERY_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and inner products (in double precision) of each query's ``k`` nearest found; -1 where fewer."""
    k = min(k, len(graph.vectors))
    ids = np.full((len(queries), k), -1, dtype=np.int64)
    scores = np.full((len(queries), k), -np.inf)
    own = graph.vectors.astype(np.float32)
    for lo in range(0, len(queries), BATCH):
        part = queries[lo : lo + BATCH]
        found, _, _, _ = beam_search(own, graph.edges, graph.entry, part.astype(np.float32), max(beam, k))
        exact = np.einsum("ijk,ik->ij", graph.vectors[np.maximum(found, 0)].astype(np.float64), part.astype(np.float64))
        exact[found < 0] = -np.inf
        order = np.lexsort((found, -exact), axis=1)[:, :k]
        ids[lo : lo + BATCH] = np.take_along_axis(found, order, axis=1)
        scores[lo : lo + BATCH] = np.take_along_axis(exact, order, axis=1)
    return ids, scores


# --- tables ------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def build_shards(vectors: DataFrame, seed: int = 0) -> DataFrame:
    """``(dim, shard, names, vectors, edges, entry)``, a row per shard, stored; from distinct ``(name, vector)``."""
    spark = vectors.sparkSession
    sizes = {r.dim: r["count"] for r in vectors.groupBy(F.size("vector").alias("dim")).count().collect()}
    total = sum(-(-c // SHARD_ROWS) for c in sizes.values())
    number = F.lit(1)
    for dim, count in sizes.items():
        number = F.when(F.size("vector") == dim, F.lit(-(-count // SHARD_ROWS))).otherwise(number)
    dealt = vectors.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("name"), number.cast("long")).cast("int").alias("shard"), "name", "vector"
    )
    schema = "dim int, shard int, names array<long>, vectors binary, edges binary, entry int"

    def work(table: pa.Table) -> pa.Table:
        names = np.asarray(table.column("name"))
        order = np.argsort(names, kind="stable")
        graph = build(_matrix(table.column("vector"))[order], seed=seed)
        return pa.table({
            "dim": pa.array([graph.vectors.shape[1]], pa.int32()),
            "shard": table.column("shard").slice(0, 1).cast(pa.int32()),
            "names": pa.array([names[order]], pa.list_(pa.int64())),
            "vectors": pa.array([graph.vectors.astype("<f8").tobytes()], pa.binary()),
            "edges": pa.array([graph.edges.astype("<i4").tobytes()], pa.binary()),
            "entry": pa.array([graph.entry], pa.int32()),
        })

    shards = dealt.repartition(max(1, 4 * total), "dim", "shard").groupBy("dim", "shard").applyInArrow(work, schema)
    return stage(shards, staging_path(spark, "graphs"))


def search_shards(shards: DataFrame, queries: DataFrame, k: int, beam: int = QUERY_BEAM) -> DataFrame:
    """``(query, name, score)``: each shard's ``k`` nearest for every query ``(query, vector)``."""
    spark = shards.sparkSession
    blocks = queries.count() // QUERY_BLOCK + 1
    found = None
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).orderBy("query").toArrow()
        by_dim: dict[int, tuple] = {}
        lengths = np.asarray([len(v) for v in rows.column("vector").to_pylist()], dtype=np.int64)
        for dim in np.unique(lengths):
            own = rows.filter(pa.array(lengths == dim))
            by_dim[int(dim)] = (np.asarray(own.column("query")), _matrix(own.column("vector")).astype(np.float64))
        sent = spark.sparkContext.broadcast(by_dim)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    if r["dim"] not in sent.value:
                        continue
                    names, vectors = sent.value[r["dim"]]
                    own = np.frombuffer(r["vectors"], "<f8").reshape(-1, r["dim"])
                    edges = np.frombuffer(r["edges"], "<i4").reshape(len(own), -1)
                    ids, scores = search(Graph(own, edges, r["entry"]), vectors, k, beam)
                    row, column = np.nonzero(ids >= 0)
                    place = np.asarray(r["names"], dtype=np.int64)[ids[row, column]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[row]), pa.array(place), pa.array(scores[row, column])], ["query", "name", "score"]
                    )

        part = shards.repartition(max(1, shards.count())).mapInArrow(work, "query long, name long, score double")
        found = part if found is None else found.unionAll(part)
    return found


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = QUERY_BEAM
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row of ``vectors`` for which ``queries`` holds."""
    spark = vectors.sparkSession
    known = vectors.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col)))
    asked = known.where(queries).select(F.col(id_col).cast("long").alias("query"), F.col(vector_col).alias("vector"))
    own = known.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).distinct()
    # Of equal vectors the k + 1 smallest ids; the rank filter cuts them before the shuffle.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    ranked = own.withColumn("place", place).where(F.col("place") <= k + 1)
    ranked = ranked.withColumn("hash", F.xxhash64("vector"))
    members = stage(ranked, staging_path(spark, "vectors"))
    first = members.where("place = 1")
    shards = build_shards(first.select(F.col("id").alias("name"), "vector"))
    found = search_shards(shards, asked.dropDuplicates(["query", "vector"]), k + 1, beam)
    several = members.where("place > 1").join(
        first.select("hash", "vector", F.col("id").alias("name")), ["hash", "vector"]
    ).select("name", "id")
    same = found.join(several, "name").select("query", "id", "score")
    every = found.select("query", F.col("name").alias("id"), "score").unionByName(same).where(F.col("id") != F.col("query"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        every.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
    )
