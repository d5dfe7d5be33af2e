"""Subject classifier on TF-IDF features with logistic regression."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, RegexTokenizer, StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import text
from postlens.operators import terms
from postlens.plans import roles
from postlens.sources.staging import stage, staging_path

# Model parameters.
VOCAB_SIZE = 5000
MIN_DF = 5.0
MAX_DF = 0.75
MAX_ITER = 20

# More iterations than the optimizer takes before its tolerance stops it (32 to 39 were seen).
UNCUT_ITER = 1000

TOKEN_PATTERN = r"\W"


def text_stages() -> list:
    """Tokenizer and stop-word filter, with the locale pinned."""
    return [
        RegexTokenizer(inputCol="all_text", outputCol="words", pattern=TOKEN_PATTERN),
        StopWordsRemover(inputCol="words", outputCol="filtered", locale="en_US"),
    ]


def _count_vectorizer_params() -> dict:
    return {"inputCol": "filtered", "outputCol": "raw_features"}


def _weight_stages(max_iter: int) -> list:
    return [
        IDF(inputCol="raw_features", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter),
    ]


def tfidf_lr_pipeline(
    vocab_size: int = VOCAB_SIZE,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    max_iter: int = MAX_ITER,
) -> Pipeline:
    """Unfitted pipeline over rows ``(all_text, label)``, one per subject.

    For subjects that fit one row.  :func:`fit` trains the same model from posts.
    """
    vectorizer = CountVectorizer(
        vocabSize=vocab_size, minDF=min_df, maxDF=max_df, **_count_vectorizer_params()
    )
    return Pipeline(stages=[*text_stages(), vectorizer, *_weight_stages(max_iter)])


class Fitted(NamedTuple):
    model: PipelineModel
    train: DataFrame
    test: DataFrame

    def predictions(self) -> DataFrame:
        """Test subjects with ``rawPrediction``, ``probability`` and ``prediction``."""
        *_, idf_model, classifier = self.model.stages
        return classifier.transform(idf_model.transform(self.test))


def count_vectors(counts: DataFrame, vocab_words: list[str]) -> DataFrame:
    """Sparse term-count vectors ``(*keys, raw_features)``, as structs, from ``(*keys, word, n)``.

    ``vocab_words`` are a model's (``vocab_size`` at most), and are sent to the tasks.  A
    subject without any vocabulary word keeps its row, with an empty vector.  A group
    collects vocabulary words only, so its size is bounded by the vocabulary.
    """
    spark = counts.sparkSession
    keys = [c for c in counts.columns if c not in ("word", "n")]
    vocab = spark.createDataFrame(list(enumerate(vocab_words)), "index int, word string")
    entry = F.when(
        F.col("index").isNotNull(), F.struct("index", F.col("n").cast("double").alias("value"))
    )
    rows = (
        counts.join(F.broadcast(vocab), "word", "left")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(len(vocab_words)).alias("size"),
        F.col("entries.index").alias("indices"),
        F.col("entries.value").alias("values"),
    )
    return rows.select(*keys, vector.alias("raw_features"))


def _vector_schema(df: DataFrame) -> T.StructType:
    """The written struct has the storage layout of an ML vector; read it as one."""
    return T.StructType(
        [
            T.StructField(f.name, VectorUDT() if f.name == "raw_features" else f.dataType)
            for f in df.schema.fields
        ]
    )


def role_words(labelled: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """``(subject_id, label, is_train, word)``: the words of the balanced training and the whole test subjects, without stop words.

    Word NULL stands for what is no word, so that a subject without words is not lost.
    """
    chosen = roles.train_and_test(labelled, train_fraction)
    return terms.text_words(
        chosen,
        ["subject_id", "label", "is_train"],
        stop_words=text.english_stop_words(),
        keep_wordless=True,
    )


def role_counts(labelled: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """:func:`role_words` counted: ``(subject_id, label, is_train, word, n)``."""
    words = role_words(labelled, train_fraction)
    return words.groupBy(*words.columns).agg(F.count("*").alias("n"))


class Features(NamedTuple):
    """The vocabulary, most frequent word first, and ``(subject_id, label, is_train, raw_features)``, stored."""

    vocabulary: list[str]
    table: DataFrame


def features(
    labelled: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    train_fraction: float = 0.8,
) -> Features:
    """Vectors of posts ``(subject_id, label, text)``; no subject's text is ever put in one row.

    Two tables are staged: the term counts, so that the posts are read and tokenized once,
    and the vectors, which the iterations of a fit read.  Only the vocabulary, bounded
    by ``vocab_size``, reaches the driver, as it does in ``CountVectorizer``.
    """
    spark = labelled.sparkSession
    counts = stage(role_counts(labelled, train_fraction), staging_path(spark, "term-counts"))
    train_counts = counts.where("is_train")
    vocab = terms.vocabulary(
        terms.word_statistics(train_counts.where(F.col("word").isNotNull())),
        terms.document_count(train_counts, ["subject_id", "label"]),
        vocab_size,
        min_df,
        max_df,
    )
    vocab_words = [row.word for row in vocab.orderBy(F.desc("n"), "word").collect()]
    if not vocab_words:
        raise ValueError("no word meets the document-frequency bounds")

    vectors = count_vectors(counts, vocab_words)
    table = stage(
        vectors, staging_path(spark, "tfidf-features"), _vector_schema(vectors), ["subject_id", "label"]
    )
    return Features(vocab_words, table)


def fit(
    labelled: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    max_iter: int = MAX_ITER,
    train_fraction: float = 0.8,
) -> Fitted:
    """Train on posts ``(subject_id, label, text)`` of all training subjects."""
    return fit_features(features(labelled, vocab_size, min_df, max_df, train_fraction), max_iter)


def fit_features(made: Features, max_iter: int = MAX_ITER) -> Fitted:
    """:func:`fit` on the result of :func:`features`, so that one table serves several fits."""
    train, test = made.table.where("is_train"), made.table.where("not is_train")
    vectorizer = CountVectorizerModel.from_vocabulary(made.vocabulary, **_count_vectorizer_params())
    weights = Pipeline(stages=_weight_stages(max_iter)).fit(train)
    return Fitted(PipelineModel([*text_stages(), vectorizer, *weights.stages]), train, test)


def post_tokens(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """``(subject_id, [label], filtered)``: each post's words by the model's own tokenizer and stop words."""
    keys = ["subject_id"] + ["label"] * ("label" in posts.columns)
    tokenizer, remover = model.stages[:2]
    rows = posts.select(*keys, F.coalesce("text", F.lit("")).alias("all_text"))
    return remover.transform(tokenizer.transform(rows)).select(*keys, "filtered")


def post_words(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """``(subject_id, [label], word, n)`` of :func:`post_tokens`.

    Word NULL stands for a post without words, so that its subject is not lost.
    """
    tokens = post_tokens(model, posts)
    keys = [c for c in tokens.columns if c != "filtered"]
    return tokens.select(*keys, F.explode_outer("filtered").alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("n"))


def predict(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """Predictions of a fitted or loaded model for the subjects of ``posts (subject_id, text, …)``.

    Counts per subject are relational, so no subject's text is put in one row.  The result
    has ``subject_id``, ``label`` if the posts have it, and the model's columns.
    """
    vectorizer, *weights = model.stages[2:]
    vectors = count_vectors(post_words(model, posts), vectorizer.vocabulary)
    path = staging_path(posts.sparkSession, "predict-features")
    table = stage(vectors, path, _vector_schema(vectors))
    for step in weights:
        table = step.transform(table)
    return table


def vocabulary_table(words: list[str], spark) -> DataFrame:
    """``(index, word)``, most frequent first."""
    return spark.createDataFrame(list(enumerate(words)), "index int, word string")


def model_vocabulary(model: PipelineModel, spark) -> DataFrame:
    """Vocabulary of a fitted pipeline: ``(index, word)``, most frequent first."""
    return vocabulary_table(next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary, spark)
