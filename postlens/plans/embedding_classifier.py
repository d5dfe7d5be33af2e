"""Subject classifier on Word2Vec features with a random forest, and its similar words."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.operators import similarity
from postlens.plans import roles
from postlens.plans.tfidf_classifier import post_tokens, text_stages
from postlens.sources.staging import stage, staging_path

# Model parameters.
VECTOR_SIZE = 100
MIN_COUNT = 5
NUM_TREES = 30
NEIGHBOURS_PER_SEED = 10

# Tasks that train word vectors side by side and average them.  The model depends on it, so
# it is not taken from the cluster.
NUM_PARTITIONS = 8

SEED = 42


def _word2vec(vector_size: int, min_count: int, num_partitions: int) -> Word2Vec:
    return Word2Vec(
        vectorSize=vector_size,
        minCount=min_count,
        numPartitions=num_partitions,
        seed=SEED,
        inputCol="filtered",
        outputCol="features",
    )


def _forest(num_trees: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=num_trees, seed=SEED
    )


def w2v_rf_pipeline(
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    num_trees: int = NUM_TREES,
    num_partitions: int = 1,
) -> Pipeline:
    """Unfitted pipeline over rows ``(all_text, label)``, one per subject.

    For subjects that fit one row.  :func:`fit` trains the same stages from posts.
    """
    return Pipeline(
        stages=[*text_stages(), _word2vec(vector_size, min_count, num_partitions), _forest(num_trees)]
    )


def subject_vectors(word2vec: Word2VecModel, tokens: DataFrame) -> DataFrame:
    """``(*keys, features)``: the mean of a subject's words' vectors, unknown words as zero.

    ``tokens (*keys, filtered)`` has a row per post.  The model gives each post the mean of its
    words, in the task that reads it; a subject's mean weighs its posts by their words.  A
    vector is made per post, not per word, and sums are partial before the shuffle by
    subject, which a subject reaches as a row per task.  The tiny weight of a post without
    words only matters to a subject without any, which gets the zero vector.
    """
    keys = [c for c in tokens.columns if c != "filtered"]
    words = F.size("filtered")
    weight = F.when(words == 0, F.lit(1e-300)).otherwise(words.cast("double"))
    rows = word2vec.transform(tokens).select(*keys, "features", weight.alias("_w"))
    return rows.groupBy(*keys).agg(Summarizer.mean(F.col("features"), F.col("_w")).alias("features"))


class Fitted(NamedTuple):
    model: PipelineModel
    train: DataFrame
    test: DataFrame

    def predictions(self) -> DataFrame:
        """Test subjects with ``rawPrediction``, ``probability`` and ``prediction``."""
        return self.model.stages[-1].transform(self.test)


def token_posts(labelled: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """``(subject_id, label, is_train, filtered)`` of every post of training and test subjects, stored.

    Rows of a file are in a fixed order, so that training on them can be repeated.
    """
    order = ["subject_id", *[c for c in ("chunk", "file", "record") if c in labelled.columns], "pos"]
    chosen = roles.train_and_test(labelled, train_fraction)
    words = text.tokens(F.col("text"), stop_words=text.english_stop_words()).alias("filtered")
    rows = chosen.select(*dict.fromkeys(["subject_id", "label", "is_train", *order]), words)
    return stage(rows, staging_path(labelled.sparkSession, "token-posts"), sort_by=order)


def fit_words(
    tokens: DataFrame,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    num_partitions: int = NUM_PARTITIONS,
) -> Word2VecModel:
    """Word vectors of the training posts; every post is a sentence, so nothing is regrouped."""
    return _word2vec(vector_size, min_count, num_partitions).fit(tokens.where("is_train"))


class Features(NamedTuple):
    """The word vectors' model and ``(subject_id, label, is_train, features)``, stored."""

    word2vec: Word2VecModel
    table: DataFrame


def features(
    labelled: DataFrame,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    num_partitions: int = NUM_PARTITIONS,
    train_fraction: float = 0.8,
) -> Features:
    """Vectors of the training and test subjects of posts ``(subject_id, label, pos, text)``."""
    spark = labelled.sparkSession
    tokens = token_posts(labelled, train_fraction)
    word2vec = fit_words(tokens, vector_size, min_count, num_partitions)
    keys = ["subject_id", "label", "is_train"]
    vectors = subject_vectors(word2vec, tokens.select(*keys, "filtered"))
    return Features(word2vec, stage(vectors, staging_path(spark, "embedding-features"), sort_by=["subject_id", "label"]))


def fit(
    labelled: DataFrame,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    num_trees: int = NUM_TREES,
    num_partitions: int = NUM_PARTITIONS,
    train_fraction: float = 0.8,
) -> Fitted:
    """Train on posts ``(subject_id, label, pos, text)`` of all training subjects.

    Word2Vec keeps its vocabulary, the words of ``min_count`` occurrences, on the driver.
    """
    word2vec, table = features(labelled, vector_size, min_count, num_partitions, train_fraction)
    train, test = table.where("is_train"), table.where("not is_train")
    forest = _forest(num_trees).fit(train)
    return Fitted(PipelineModel([*text_stages(), word2vec, forest]), train, test)


def predict(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """Predictions of a fitted or loaded model for the subjects of ``posts (subject_id, text, …)``.

    The result has ``subject_id``, ``label`` if the posts have it, and the model's columns.
    """
    vectors = subject_vectors(_word_stage(model), post_tokens(model, posts))
    stored = stage(vectors, staging_path(posts.sparkSession, "predict-features"))
    return model.stages[-1].transform(stored)


def vector_table(word2vec: Word2VecModel) -> DataFrame:
    """``(word, vector array<double>)``."""
    return word2vec.getVectors().select("word", vector_to_array("vector").alias("vector"))


def _word_stage(model: PipelineModel) -> Word2VecModel:
    return next(s for s in model.stages if isinstance(s, Word2VecModel))


def word_vectors(model: PipelineModel) -> DataFrame:
    """``(word, vector array<double>)`` of the Word2Vec stage."""
    return vector_table(_word_stage(model))


def similar_words(
    model: PipelineModel | Word2VecModel,
    seeds: Sequence[str] | DataFrame = similarity.SEED_WORDS,
    k: int = NEIGHBOURS_PER_SEED,
    min_similarity: float | None = None,
) -> DataFrame:
    """``(seed, word, similarity)``; seeds outside the vocabulary give no rows."""
    vectors = vector_table(model) if isinstance(model, Word2VecModel) else word_vectors(model)
    return similarity.similar_vectors(vectors, seeds, k, min_similarity, key="word")
