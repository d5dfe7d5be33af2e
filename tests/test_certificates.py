"""Certificates hold for trained models and fail for others."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.plans import certificates, embedding_classifier, tfidf_classifier


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(5)
    words = [[f"{'good' if c == 0 else 'bad'}{i}" for i in range(12)] + [f"w{i}" for i in range(30)] for c in (0, 1)]
    rows = [(f"s{s}", s % 2, i, " ".join(rng.choices(words[s % 2], k=12))) for s in range(160) for i in range(4)]
    rows += [("empty", 1, 0, "")]
    return spark.createDataFrame(rows, "subject_id string, label int, pos int, text string").repartition(4).cache()


def test_regression(spark, posts):
    fitted = tfidf_classifier.fit(posts, min_df=2.0)
    row = certificates.regression_certificate(fitted).first()
    assert row.difference < 1e-9 and row.distinct_probabilities > 1
    assert row.gradient < 1e-3 * row.gradient_of_constant


def test_a_barely_trained_regression_fails(posts):
    """No iteration leaves the constant model, whose gradient is not small."""
    row = certificates.regression_certificate(tfidf_classifier.fit(posts, min_df=2.0, max_iter=0)).first()
    assert row.distinct_probabilities == 1 and row.gradient > 0.5 * row.gradient_of_constant


def test_only_iterations_that_end_by_themselves_reach_the_optimum(posts):
    made = tfidf_classifier.features(posts, min_df=2.0)
    cut, uncut = (
        certificates.regression_certificate(tfidf_classifier.fit_features(made, n)).first() for n in (3, tfidf_classifier.UNCUT_ITER)
    )
    assert cut.gradient > 1e-3 * cut.gradient_of_constant and uncut.gradient < 1e-5 * uncut.gradient_of_constant
    assert uncut.difference < 1e-9


def test_wrong_weights_are_seen(spark, posts):
    fitted = tfidf_classifier.fit(posts, min_df=2.0)
    weights = certificates.regression_weights(fitted)
    intercept = fitted.model.stages[-1].intercept
    right = {r.subject_id: r.p for r in certificates.replay_regression(fitted.test, weights, intercept).collect()}
    off = weights.withColumn("weight", F.col("weight") + F.when(F.col("index") == 0, 0.01).otherwise(0.0))
    wrong = {r.subject_id: r.p for r in certificates.replay_regression(fitted.test, off, intercept).collect()}
    assert set(right) == set(wrong) and max(abs(right[k] - wrong[k]) for k in right) > 1e-9


def test_gradient_equals_numpy(spark, posts):
    fitted = tfidf_classifier.fit(posts, min_df=2.0, max_iter=3)
    weights = certificates.regression_weights(fitted)
    p = certificates.replay_regression(fitted.train, weights, fitted.model.stages[-1].intercept)
    slopes = {r["index"]: r.slope for r in certificates.gradient(fitted.train, weights, p).collect()}
    known = {r.subject_id: r.p for r in p.collect()}
    idf = fitted.model.stages[-2].idf.toArray()
    rows = fitted.train.collect()
    x = np.array([r.raw_features.toArray() * idf for r in rows])
    error = np.array([known[r.subject_id] - r.label for r in rows])
    want = x.T @ error / len(rows)
    assert slopes.pop(-1) == pytest.approx(error.mean())
    assert all(slopes[i] == pytest.approx(want[i], abs=1e-12) for i in slopes)


def test_forest(posts):
    row = certificates.forest_certificate(embedding_classifier.fit(posts, vector_size=8, min_count=2, num_trees=6)).first()
    assert row.difference < 1e-9 and row.distinct_probabilities > 1
