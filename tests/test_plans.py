import threading

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postlens.catalog import queries
from postlens.operators import corpus, evaluate
from postlens.plans import dashboard, embedding_classifier, etl, roles, tfidf_classifier
from postlens.sources.views import VIEWS, read_dashboard_view


@pytest.fixture(scope="module")
def posts(spark):
    """400 subjects, a quarter of class 1, whose posts hold words of their class and common ones."""
    n = F.col("id")
    subject = (n % 400).cast("int")
    label = (subject % 4 == 0).cast("int")
    # Word counts all differ, so that the vocabulary's order has no ties.
    words = F.concat_ws(
        " ",
        F.transform(
            F.sequence(F.lit(1), F.lit(12)),
            lambda k: F.concat(
                F.when(label == 1, F.lit("low")).otherwise(F.lit("fine")),
                F.pmod(F.xxhash64(n, k), F.lit(9)),
            ),
        ),
        F.transform(F.sequence(F.lit(1), F.lit(8)), lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(k, n), F.lit(40)))),
        F.lit("the and"),
    )
    df = spark.range(4000).select(
        F.concat(F.lit("subject"), subject).alias("subject_id"),
        (n / 400).cast("int").alias("pos"),
        F.timestamp_seconds(1420070400 + n * 3700).alias("date"),
        words.alias("text"),
        label.alias("label"),
    )
    extra = [("quiet", 0, None, None, 0), ("empty", 0, None, "", 0), ("stops", 0, None, "the and", 1)]
    return df.unionByName(spark.createDataFrame(extra, "subject_id string, pos int, date timestamp, text string, label int")).cache()


@pytest.fixture(scope="module")
def tfidf(posts):
    return tfidf_classifier.fit(posts)


@pytest.fixture(scope="module")
def embedded(posts):
    return embedding_classifier.fit(posts, vector_size=20, num_trees=10, num_partitions=1)


def corpus_of(posts):
    """One row per subject and role, as the plain pipelines take it."""
    chosen = roles.train_and_test(posts)
    return corpus.subject_corpus(chosen, ("subject_id", "label", "is_train"))


def test_roles(posts):
    chosen = roles.train_and_test(posts)
    sizes = {
        (r.is_train, r.label): r["count"]
        for r in chosen.select("subject_id", "label", "is_train").distinct().groupBy("is_train", "label").count().collect()
    }
    all_test = posts.where("label is not null").join(chosen.where("is_train"), "subject_id", "left_anti")
    assert 0.6 < sizes[True, 0] / sizes[True, 1] < 1.5
    assert sizes[False, 0] > 2 * sizes[False, 1]
    assert all_test.select("subject_id").distinct().count() >= sizes[False, 0] + sizes[False, 1]


def test_tfidf_fit_equals_the_plain_pipeline(posts, tfidf):
    whole = corpus_of(posts)
    plain = tfidf_classifier.tfidf_lr_pipeline().fit(whole.where("is_train"))
    assert set(plain.stages[2].vocabulary) == set(tfidf.model.stages[2].vocabulary)
    columns = ("subject_id", "label", "prediction", vector_to_array("probability")[1].alias("p"))
    theirs = {r.subject_id: r for r in plain.transform(whole.where("not is_train")).select(*columns).collect()}
    mine = {r.subject_id: r for r in tfidf.predictions().select(*columns).collect()}
    assert mine.keys() == theirs.keys() and len(mine) > 50
    assert all(mine[s].prediction == theirs[s].prediction for s in mine)
    assert [mine[s].p for s in mine] == pytest.approx([theirs[s].p for s in mine], abs=0.02)


def test_fitted_pipeline_runs_on_text(posts, tfidf):
    """Applied to whole texts, the model predicts what it predicts from the counted posts."""
    from_text = tfidf.model.transform(corpus_of(posts).where("not is_train"))
    pairs = from_text.select("subject_id", F.col("prediction").alias("a")).join(
        tfidf.predictions().select("subject_id", F.col("prediction").alias("b")), "subject_id"
    )
    assert pairs.count() == tfidf.test.count() and pairs.where("a <> b").count() == 0


def test_subjects_without_words_are_kept(posts, tfidf, embedded):
    for fitted in (tfidf, embedded):
        rows = fitted.train.unionByName(fitted.test)
        chosen = roles.train_and_test(posts).select("subject_id", "label").distinct()
        assert rows.count() == chosen.count()
    wordless = {"quiet", "empty", "stops"}
    vectors = embedded.train.unionByName(embedded.test).where(F.col("subject_id").isin(list(wordless))).collect()
    assert vectors and all(not np.any(r.features.toArray()) for r in vectors)


def test_models_learn(tfidf, embedded):
    for fitted in (tfidf, embedded):
        rows = evaluate.classification_metrics(evaluate.confusion(fitted.predictions())).collect()
        assert {r.metric_name: r.value for r in rows}["f1_score"] > 0.9


def test_no_vocabulary_raises(posts):
    with pytest.raises(ValueError, match="bounds"):
        tfidf_classifier.fit(posts.limit(40), min_df=10000)


def test_model_vocabulary(spark, tfidf):
    rows = tfidf_classifier.model_vocabulary(tfidf.model, spark).orderBy("index").collect()
    assert [r.word for r in rows] == tfidf.model.stages[2].vocabulary


def test_document_vectors_equal_the_model_on_whole_subjects(posts, embedded):
    whole = embedded.model.transform(corpus_of(posts)).select("subject_id", "features").collect()
    want = {r.subject_id: r.features.toArray() for r in whole}
    mine = embedded.train.unionByName(embedded.test).collect()
    assert len(mine) == len(want)
    assert all(np.allclose(r.features.toArray(), want[r.subject_id], atol=1e-9) for r in mine)


@pytest.mark.parametrize("which", ["tfidf", "embedded"])
def test_prediction_from_posts(posts, request, which):
    """New posts are scored without joining a subject's texts, with and without labels."""
    fitted = request.getfixturevalue(which)
    plan = tfidf_classifier if which == "tfidf" else embedding_classifier
    test = roles.train_and_test(posts).where("not is_train").drop("is_train")
    want = {r.subject_id: r.prediction for r in fitted.predictions().collect()}
    got = plan.predict(fitted.model, test.drop("label"))
    assert "label" not in got.columns
    assert {r.subject_id: r.prediction for r in got.collect()} == want
    assert plan.predict(fitted.model, test).select("label").distinct().count() == 2


def test_training_subjects_are_bounded(posts):
    chosen = roles.train_and_test(posts)
    few = roles.bounded_training(chosen, 40)
    count = lambda df: df.select("subject_id").distinct().count()
    assert 20 < count(few.where("is_train")) < 60
    assert count(few.where("not is_train")) == count(chosen.where("not is_train"))
    assert count(roles.bounded_training(chosen)) == count(chosen)


@pytest.mark.parametrize("which", ["tfidf", "embedded"])
def test_save_and_load(spark, tmp_path, request, which):
    fitted = request.getfixturevalue(which)
    path = str(tmp_path / "model")
    fitted.model.write().overwrite().save(path)
    fitted.model.write().overwrite().save(path)
    loaded = fitted._replace(model=PipelineModel.load(path))
    keep = ("subject_id", "prediction")
    assert sorted(loaded.predictions().select(*keep).collect()) == sorted(fitted.predictions().select(*keep).collect())


def test_similar_words(embedded):
    near = embedding_classifier.similar_words(embedded.model, ["low1", "depression"], k=8)
    rows = near.collect()
    assert len(rows) == 8 and {r.seed for r in rows} == {"low1"} and "low1" not in {r.word for r in rows}
    view = dashboard.semantic_view(near, 5)
    assert view.dtypes == [("word", "string"), ("similarity", "float")] and view.count() == 5


def test_plain_embedding_pipeline(posts):
    whole = corpus_of(posts)
    pipeline = embedding_classifier.w2v_rf_pipeline(vector_size=10, num_trees=5)
    predicted = pipeline.fit(whole.where("is_train")).transform(whole.where("not is_train"))
    assert predicted.count() == whole.where("not is_train").count()


def test_dashboard(spark, posts, tfidf, embedded, tmp_path):
    labels = posts.select("subject_id", "label").distinct()
    facts = dashboard.stage_facts(posts.drop("label"), labels)
    assert "text" not in facts.columns and facts.count() == posts.count()
    metrics = evaluate.classification_metrics(evaluate.confusion(embedded.predictions()))
    near = embedding_classifier.similar_words(embedded.model, ["low1", "w3"])
    views = {
        **dashboard.post_views(facts),
        "dashboard_metrics": dashboard.metrics_view(metrics),
        "dashboard_semantic_words": dashboard.semantic_view(near),
    }
    assert views.keys() == VIEWS.keys()
    dashboard.write_views(views, str(tmp_path))
    for name, (_, schema) in VIEWS.items():
        back = read_dashboard_view(spark, str(tmp_path), name)
        assert back.schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"
        assert back.count() == views[name].count() > 0
    kpi = read_dashboard_view(spark, str(tmp_path), "dashboard_kpi").first()
    assert kpi.total_posts == posts.count()
    similarities = [r.similarity for r in read_dashboard_view(spark, str(tmp_path), "dashboard_semantic_words").collect()]
    assert similarities == sorted(similarities, reverse=True)
    cells = read_dashboard_view(spark, str(tmp_path), "dashboard_time_dep").where("day is not null")
    assert cells.agg(F.sum("count")).first()[0] == posts.where("label = 1 and date is not null").count()


def test_normalized_text(spark):
    df = spark.createDataFrame([("  ABC d ",)], "text string")
    assert etl.normalized_text(df).first().text == "abc d"


def test_subject_vectors_are_made_per_post_without_a_join(spark):
    rows = [("a", 0, ["x", "y", "x"]), ("a", 0, []), ("a", 0, ["z", "unknown"]), ("b", 1, []), ("c", 1, ["unknown"])]
    tokens = spark.createDataFrame(rows, "subject_id string, label int, filtered array<string>")
    train = spark.createDataFrame([(["x", "y", "z"],)] * 5, "filtered array<string>")
    word2vec = Word2Vec(vectorSize=4, minCount=1, seed=1, inputCol="filtered", outputCol="features").fit(train)
    known = {r.word: np.array(r.vector.toArray()) for r in word2vec.getVectors().collect()}
    made = embedding_classifier.subject_vectors(word2vec, tokens)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = {r.subject_id: r.features.toArray() for r in made.collect()}
    assert got["a"] == pytest.approx((2 * known["x"] + known["y"] + known["z"]) / 5, abs=1e-12)
    assert not got["b"].any() and not got["c"].any() and len(got) == 3


def test_doc_embedding_shuffles_sums_and_not_words(spark):
    df = queries.doc_embedding(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "SortMergeJoin [word" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("word#" in line for line in exchanges)


class Thinned(Exception):
    pass


def _train_subjects(df):
    return df.where("is_train").select("subject_id").distinct().count()


@pytest.fixture
def no_thinning(monkeypatch):
    def thin(*_):
        raise Thinned

    monkeypatch.setattr(roles, "bounded_training", thin)


@pytest.fixture(scope="module")
def many(spark):
    """1,050,000 training subjects or so, more than models once trained on."""
    text = F.concat(F.lit("w"), F.col("id") % 7, F.lit(" w"), F.col("id") % 3)
    return spark.range(1_320_000).select(
        F.col("id").alias("subject_id"), F.lit(0).alias("pos"), text.alias("text"), (F.col("id") % 2).cast("int").alias("label")
    )


def test_every_training_subject_gives_words_to_the_vectors(many, no_thinning):
    made = embedding_classifier.token_posts(many)
    assert _train_subjects(made) == _train_subjects(roles.train_and_test(many)) > 1_000_000


def test_every_training_subject_counts_for_the_vocabulary(many, no_thinning):
    made = tfidf_classifier.features(many)
    assert _train_subjects(made.table) == _train_subjects(roles.train_and_test(many)) > 1_000_000


def test_embedding_features_hold_every_subject(posts, no_thinning):
    made = embedding_classifier.features(posts, vector_size=4, num_partitions=1)
    assert made.table.count() == roles.train_and_test(posts).select("subject_id").distinct().count()


def test_training_subjects_are_thinned_only_on_request(posts):
    assert roles.bounded_training(posts) is posts


def test_saved_models_are_made_side_by_side(spark, posts, monkeypatch):
    """The other model does not wait for Word2Vec's fixed number of tasks."""
    meet = threading.Barrier(2)

    def fit(*_):
        meet.wait(60)
        raise Thinned

    monkeypatch.setattr(queries.S, "training_posts", lambda *_: posts)
    monkeypatch.setattr(tfidf_classifier, "fit", fit)
    monkeypatch.setattr(embedding_classifier, "fit", fit)
    with pytest.raises(Thinned):
        queries.model_save_load(spark, "none")
