import numpy as np
import pytest
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postlens.operators import similarity

VECTORS = np.random.default_rng(7).normal(size=(300, 16))


@pytest.fixture
def vectors(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(VECTORS)]
    return spark.createDataFrame(rows, "id int, vector array<float>").repartition(5)


def brute_force(seeds, k):
    unit = VECTORS.astype("float32").astype("float64")
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for seed in seeds:
        cosines = unit @ unit[seed]
        order = sorted((i for i in range(len(unit)) if i != seed), key=lambda i: (-cosines[i], i))
        yield from ((seed, i, cosines[i]) for i in order[:k])


def test_equals_brute_force(vectors):
    got = similarity.similar_vectors(vectors, [3, 250, 17], 10)
    rows = [tuple(r) for r in got.orderBy("seed", F.desc("similarity"), "id").collect()]
    want = sorted(brute_force([3, 17, 250], 10), key=lambda r: (r[0], -r[2], r[1]))
    assert [r[:2] for r in rows] == [r[:2] for r in want]
    assert [r[2] for r in rows] == pytest.approx([r[2] for r in want], abs=1e-12)


def test_seeds_as_a_table(spark, vectors):
    table = spark.createDataFrame([(3,), (17,)], "id int")
    listed = similarity.similar_vectors(vectors, [3, 17], 5)
    assert sorted(similarity.similar_vectors(vectors, table, 5).collect()) == sorted(listed.collect())


def test_unknown_seed_gives_no_rows(vectors):
    got = similarity.similar_vectors(vectors, [9999, 3], 4).collect()
    assert {r.seed for r in got} == {3} and len(got) == 4
    assert similarity.similar_vectors(vectors, [9999], 4).count() == 0


def test_seeds_beyond_a_block_and_other_lengths(spark, vectors, monkeypatch):
    whole = sorted(similarity.similar_vectors(vectors, list(range(40)), 3).select("seed", "id").collect())
    monkeypatch.setattr(similarity, "SEED_BLOCK", 7)
    assert sorted(similarity.similar_vectors(vectors, list(range(40)), 3).select("seed", "id").collect()) == whole
    odd = [(900, [1.0, 2.0]), (901, [2.0, 4.0]), (902, None), (903, [None] * 16)]
    more = vectors.unionByName(spark.createDataFrame(odd, "id int, vector array<float>"))
    got = similarity.similar_vectors(more, [3, 900], 400).collect()
    assert [(r.id, r.similarity) for r in got if r.seed == 900] == [(901, pytest.approx(1))]
    assert len([r for r in got if r.seed == 3]) == 299


def test_zero_vectors_ties_and_threshold(spark):
    rows = [("a", [1.0, 0.0]), ("zero", [0.0, 0.0]), ("c", [2.0, 0.0]), ("b", [3.0, 0.0]), ("d", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, vector array<double>")
    got = similarity.similar_vectors(df, ["a"], 2).collect()
    assert [(r.id, r.similarity) for r in got] == [("b", 1.0), ("c", 1.0)]
    above = similarity.similar_vectors(df, ["a", "zero"], 10, min_similarity=0.5)
    assert {(r.seed, r.id) for r in above.collect()} == {("a", "b"), ("a", "c")}


def test_best_and_strongest(spark):
    rows = [("s", "x", 0.5), ("t", "x", 0.9), ("s", "y", 0.7), ("s", "z", 0.1)]
    df = spark.createDataFrame(rows, "seed string, word string, similarity double")
    best = similarity.best_neighbours(df, "word", 2).collect()
    assert [tuple(r) for r in best] == [("x", 0.9), ("y", 0.7)]
    view = similarity.best_neighbours(df, "word", 3)
    assert [r.word for r in similarity.strongest(view, n=2).collect()] == ["y", "x"]


def test_equals_find_synonyms(spark):
    rows = [([f"w{(i * j) % 23}" for j in range(1, 30)],) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "words array<string>")
    model = Word2Vec(vectorSize=12, minCount=1, seed=1, inputCol="words", outputCol="f").fit(df)
    table = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    mine = similarity.similar_vectors(table, ["w1", "w7"], 5, key="word").collect()
    for seed in ("w1", "w7"):
        want = {r.word: r.similarity for r in model.findSynonyms(seed, 5).collect()}
        assert {r.word: r.similarity for r in mine if r.seed == seed} == pytest.approx(want, abs=1e-5)


@pytest.mark.parametrize("block", [1, 16, 256])
def test_blocks_are_skipped_without_loss(spark, monkeypatch, block):
    """Crowded directions, equal vectors and all seeds: the same neighbours as by brute force, with fewer pairs."""
    monkeypatch.setattr(similarity, "ROW_BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 10))
    rows = centres[rng.integers(0, 12, size=900)] + rng.normal(size=(900, 10)) * 0.05
    rows[:300] = rows[0] + rng.normal(size=(300, 10)) * 1e-9  # a third lies in one direction
    rows[300:320] = rows[300]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, vector array<double>").repartition(6)
    counts = spark.sparkContext.accumulator(np.zeros(2), similarity.PairCounts())
    seeds = list(range(0, 900, 9))
    found = similarity.similar_vectors(df, seeds, 15, skipped=counts).collect()
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    got = {}
    for r in found:
        got.setdefault(r.seed, []).append(r.similarity)
    assert set(got) == set(seeds)
    for seed in seeds:
        cosines = np.delete(unit @ unit[seed], seed)
        assert np.allclose(sorted(got[seed]), np.sort(cosines)[-15:], atol=1e-12)
    skipped, pairs = counts.value
    assert pairs == 900 * len(seeds) and skipped > 0.5 * pairs
    same = {(r.seed, r.id) for r in found if r.seed in (306, 315)}
    assert {(306, i) for i in range(300, 316) if i != 306} <= same
