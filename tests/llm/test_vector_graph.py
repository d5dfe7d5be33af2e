import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import vector_graph as V


def brute(rows, k, asked):
    known = {(i, tuple(np.float32(v))) for i, v in rows if i is not None and v and None not in v}
    known = [(i, np.array(v, np.float64)) for i, v in known if np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in known:
        if asked(q):
            near = sorted((-float(v @ w), i) for i, w in known if i != q and len(w) == len(v))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16)) * 2
    rows = [(int(i), (centres[i % 8] + rng.normal(size=16)).tolist()) for i in range(900)]
    common = rng.normal(size=16).tolist()
    rows += [(1000 + i, common) for i in range(300)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] + [1.0] * 15)]
    rows += [(2080, [float("inf")] + [1.0] * 15), (None, common), rows[20], (2100, [1.0, 2.0]), (2120, [2.0, 1.0])]
    return rows


def test_recall_ranks_and_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(V, "SHARD_ROWS", 300)
    monkeypatch.setattr(V, "QUERY_BLOCK", 30)
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    got = {}
    for r in V.nearest(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 20, lambda q: q % 20 == 0)
    assert set(got) == {q for q, near in want.items() if near}
    hits = total = 0
    vectors = {i: np.array(np.float32(v), np.float64) for i, v in rows if i is not None and v and None not in v}
    for q, near in want.items():
        own = sorted(got.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(near) + 1))
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), rel=1e-12, abs=1e-12) for _, i, s in own)
        hits += len({i for i, _ in near} & {i for _, i, _ in own})
        total += len(near)
    assert hits / total >= 0.9


def test_pruning_keeps_the_nearest_and_drops_what_it_covers():
    points = np.array([[0, 0], [1, 0], [2, 0.1], [0, 3]], np.float32)
    kept = V.robust_prune(points, np.array([0]), np.array([[1, 2, 3, -1, 0, 1]]), 1.2, 3)
    assert kept.tolist() == [[1, 3, -1]]


def test_graphs_of_few_and_equal_points():
    for n in (1, 2, 5):
        graph = V.build(np.ones((n, 3)))
        ids, scores = V.search(graph, np.ones((2, 3)), 5)
        assert ids.shape == (2, min(5, n)) and ids[0, 0] >= 0 and scores[0, 0] == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.nearest(df, F.col("vec_id") % 20 == 0).count() == 0
