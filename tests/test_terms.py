import math

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from postlens.catalog import queries
from postlens.operators import terms

DOCS = [list("aaab"), list("bc"), list("cd"), list("db")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "id int, words array<string>")


def vocab_words(df):
    return [r.word for r in df.orderBy(F.desc("n"), "word").collect()]


def test_vocabulary_bounds_are_inclusive(docs):
    counts = terms.word_statistics(terms.term_counts(docs, ["id"]))
    n_docs = terms.document_count(docs)
    assert set(vocab_words(terms.vocabulary(counts, n_docs, min_df=2, max_df=0.5))) == {"c", "d"}
    assert set(vocab_words(terms.vocabulary(counts, n_docs, min_df=0.5, max_df=3))) == {"b", "c", "d"}
    assert vocab_words(terms.vocabulary(counts, n_docs, size=2, min_df=1, max_df=4.0)) == ["a", "b"]


def test_documents_of_several_rows(spark, docs):
    """Rows of one document, e.g. posts of one subject, count as one document."""
    split = docs.select("id", F.explode("words").alias("w")).select("id", F.array("w").alias("words"))
    whole, parts = (terms.term_counts(d, ["id"]) for d in (docs, split))
    assert sorted(whole.collect()) == sorted(parts.collect())
    assert terms.document_count(split, ["id"]).first().n_docs == 4


def test_documents_without_words_count(spark):
    df = spark.createDataFrame([(0, ["a"]), (1, []), (2, None)], "id int, words array<string>")
    assert terms.term_counts(df, ["id"]).collect() == [(0, "a", 1)]
    assert terms.document_count(df).first().n_docs == 3


def test_counts_from_text(spark):
    rows = [(0, "The cat, the CAT!"), (1, "the"), (2, None), (3, "...")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = terms.text_term_counts(df, ["id"], stop_words=["The"])
    assert got.collect() == [(0, "cat", 2)]
    kept = terms.text_term_counts(df, ["id"], stop_words=["the"], keep_wordless=True)
    assert {r.id for r in kept.collect()} == {0, 1, 2, 3}
    assert {(r.id, r.word, r.n) for r in kept.collect() if r.word} == {(0, "cat", 2)}


def test_whole_documents_in_rows(spark):
    rows = [(0, "The cat, the CAT dog"), (1, "the dog"), (2, None), (3, "... --"), (4, "Bird cat cat")]
    df = spark.createDataFrame(rows, "id int, text string")
    counts = terms.text_term_counts(df, ["id"], stop_words=["the"])
    want = sorted(terms.word_statistics(counts).collect())
    statistics = terms.row_word_statistics(df, stop_words=["the"])
    assert sorted(statistics.collect()) == want == [("bird", 1, 1), ("cat", 2, 4), ("dog", 2, 2)]
    by_row = terms.row_term_counts(df, ["id"], ["cat", "bird"])
    assert by_row.dtypes == counts.dtypes
    assert sorted(by_row.collect()) == sorted(counts.where("word <> 'dog'").collect())
    plan = by_row._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_idf_value(docs):
    counts, n_docs = terms.term_counts(docs, ["id"]), terms.document_count(docs)
    vocab = terms.vocabulary(terms.word_statistics(counts), n_docs, min_df=2, max_df=0.5)
    got = {r.word: r.idf for r in terms.idf(vocab, n_docs).collect()}
    assert got == pytest.approx({"c": math.log(5 / 3), "d": math.log(5 / 3)})
    assert got["c"] == pytest.approx(0.510826, abs=1e-6)


@pytest.fixture
def many(spark):
    """Word w_k occurs in every document whose id is a multiple of k, id mod 5 + 1 times."""
    return spark.range(1, 241).select(
        "id",
        F.flatten(
            F.transform(
                F.filter(F.sequence(F.lit(1), F.lit(60)), lambda k: F.col("id") % k == 0),
                lambda k: F.array_repeat(F.concat(F.lit("w"), k), (F.col("id") % 5 + 1).cast("int")),
            )
        ).alias("words"),
    )


def test_relations_equal_the_ml_stages(many):
    vectorizer = CountVectorizer(vocabSize=5000, minDF=5.0, maxDF=0.75, inputCol="words", outputCol="raw").fit(many)
    weights = IDF(inputCol="raw", outputCol="features").fit(vectorizer.transform(many))
    counts, n_docs = terms.term_counts(many, ["id"]), terms.document_count(many)
    vocab = terms.vocabulary(terms.word_statistics(counts), n_docs)
    assert set(vocab_words(vocab)) == set(vectorizer.vocabulary)
    mine = {r.word: r.idf for r in terms.idf(vocab, n_docs).collect()}
    theirs = dict(zip(vectorizer.vocabulary, weights.idf.toArray()))
    assert mine == pytest.approx(theirs, abs=1e-12)
    rows = weights.transform(vectorizer.transform(many)).select("id", "features").collect()
    want = {
        (r.id, vectorizer.vocabulary[i]): v
        for r in rows
        for i, v in zip(r.features.indices, r.features.values)
    }
    got = {(r.id, r.word): r.tfidf for r in terms.tfidf(counts, terms.idf(vocab, n_docs)).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_head_and_tail(docs):
    counts = terms.word_statistics(terms.term_counts(docs, ["id"]))
    vocab = terms.vocabulary(counts, terms.document_count(docs), min_df=1, max_df=4)
    both = terms.vocabulary_head_tail(vocab, 2).collect()
    assert [(r.part, r.word, r.n) for r in both] == [("head", "a", 3), ("head", "b", 3), ("tail", "d", 2), ("tail", "c", 2)]


def test_vocabulary_is_whole_unless_a_size_is_given(docs):
    counts, n_docs = terms.term_counts(docs, ["id"]), terms.document_count(docs)
    statistics = terms.word_statistics(counts)
    whole = terms.vocabulary(statistics, n_docs, min_df=1, max_df=10**9)
    assert whole.count() > 2 and terms.vocabulary(statistics, n_docs, 2, 1, 10**9).count() == 2
    plan = terms.tfidf(counts, terms.idf(whole, n_docs))._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in plan


def test_row_counts_equal_grouped_counts_without_a_shuffle(spark):
    rows = [(0, "b a, a; the B a"), (1, None), (2, ""), (3, "the the"), (4, "z"), (5, " x é x_1 É x"), (6, "a b " * 5000)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = terms.document_term_counts(df, ["id"], stop_words=["The"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = terms.text_term_counts(df, ["id"], stop_words=["the"])
    assert sorted(got.collect()) == sorted(want.collect()) and got.schema["n"].dataType == want.schema["n"].dataType


def test_rows_of_one_document_are_counted_together(spark):
    df = spark.createDataFrame([(0, "a b"), (0, "a"), (1, "a"), (None, "c"), (None, "c")], "id int, text string")
    got = terms.document_term_counts(df, ["id"])
    assert set(got.collect()) == {(0, "a", 2), (0, "b", 1), (1, "a", 1), (None, "c", 2)}


@pytest.mark.parametrize("head", [1, 2, 100])
def test_weights_by_head_lose_no_word(docs, head):
    counts, n_docs = terms.term_counts(docs, ["id"]), terms.document_count(docs)
    weights = terms.idf(terms.vocabulary(terms.word_statistics(counts), n_docs, min_df=1, max_df=10**9), n_docs)
    want = sorted(terms.tfidf(counts, weights).collect())
    assert len(want) > 2 and sorted(terms.tfidf_by_head(counts, weights, head).collect()) == want


@pytest.mark.parametrize("name", ["tfidf", "tfidf_of_counts", "term_counts"])
def test_documents_words_are_not_shuffled(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(word" not in plan
