import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.operators import corpus, words
from postlens.operators import posts as P
from postlens.plans import etl

SAMPLES = [
    "I feel SO empty, see http://a.b/c?d=1 ok-ok it's 42",
    "été naïve don't",
    "a  b ",
    "",
    " lead",
    "tabs\tand\nlines",
    "ÀÉÎ İstanbul straße HTTP://X.y z",
    None,
]


@pytest.fixture
def samples(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "id int, text string")


def by_id(df, col):
    return [r[col] for r in df.orderBy("id").collect()]


def test_clean_text(samples):
    got = by_id(P.clean_text(samples), "clean_text")
    assert got[0] == "i feel so empty see  okok its "
    assert got[1] == "t nave dont"
    assert got[5] == "tabs\tand\nlines"
    assert got[7] is None


def test_clean_equals_the_pattern_with_both_cases(samples):
    spelled = F.regexp_replace(F.regexp_replace(F.lower("text"), r"http\S+", ""), r"[^a-zA-Z\s]", "")
    assert by_id(P.clean_text(samples), "clean_text") == by_id(samples.withColumn("c", spelled), "c")


def test_word_count_counts_pieces(samples):
    got = by_id(P.word_count(samples), "word_count")
    assert got == by_id(samples.withColumn("n", F.size(F.split("text", " "))), "n")
    assert got[2] == 4 and got[3] == 1 and got[7] is None


def test_tokens_equal_the_ml_stages(samples):
    filled = samples.fillna("")
    stages = RegexTokenizer(inputCol="text", outputCol="w", pattern="\\W").transform(filled)
    filtered = StopWordsRemover(inputCol="w", outputCol="f", locale="en_US").transform(stages)
    assert by_id(P.tokens(samples), "words") == by_id(filtered, "w")
    mine = P.tokens(samples, stop_words=text.english_stop_words())
    assert by_id(mine, "words") == by_id(filtered, "f")
    assert by_id(P.tokens(samples), "words")[1] == ["t", "na", "ve", "don", "t"]


def test_unicode_tokens(samples):
    got = by_id(P.tokens(samples, pattern=text.UNICODE_NON_WORD), "words")
    assert got[1] == ["été", "naïve", "don", "t"]


def test_process_chain(spark):
    df = spark.createDataFrame([("s", SAMPLES[0]), ("t", None)], "subject_id string, text string")
    rows = etl.process(df).orderBy("subject_id").collect()
    assert rows[0].words == ["i", "feel", "so", "empty", "see", "okok", "its"]
    assert rows[0].filtered_words == ["feel", "empty", "see", "okok"]
    assert rows[1].words == [] and rows[1].filtered_words == []


def test_short_posts(samples):
    assert {r.id for r in P.drop_short_posts(samples, min_words=3).collect()} == {0, 1, 2, 6}


def test_flatten_drops_subjects_without_writings(spark):
    schema = "ID string, WRITING array<struct<TITLE:string,DATE:string,INFO:string,TEXT:string>>"
    rows = [("a", [(" x ", "2020-02-30", "i", " t ")]), ("b", []), ("c", None)]
    got = P.flatten_posts(spark.createDataFrame(rows, schema)).collect()
    assert got == [("a", 0, "x", None, "i", "t")]


@pytest.fixture
def skewed(spark):
    """One subject holds a third of the posts."""
    hot = spark.range(3000).select(F.lit("hot").alias("subject_id"), F.col("id").cast("int").alias("pos"))
    rest = spark.range(6000).select(
        F.concat(F.lit("s"), F.col("id") % 500).alias("subject_id"), (F.col("id") / 500).cast("int").alias("pos")
    )
    return hot.unionByName(rest).withColumn("text", F.concat(F.lit("w"), F.col("pos") % 7))


@pytest.fixture
def some_labels(spark):
    rows = [("hot", 1)] + [(f"s{i}", i % 2) for i in range(0, 500, 3)] + [("nobody", 1), ("s3", 0)]
    return spark.createDataFrame(rows, "subject_id string, label int")


def test_label_join(skewed, some_labels):
    plain = P.label_posts(skewed, some_labels)
    assert plain.columns == ["subject_id", "pos", "text", "label"]
    assert plain.where("subject_id = 'hot'").count() == 3000
    assert plain.where("subject_id = 's3'").count() == 24  # two label lines
    assert plain.where("subject_id in ('s1', 'nobody')").count() == 0


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_salted_label_join_is_the_same_join(spark, skewed, some_labels, broadcast):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, broadcast)
    try:
        plain = P.label_posts(skewed, some_labels)
        salted = P.label_posts(skewed, some_labels, hot=P.hot_subjects(skewed, 0.1), salts=8)
        assert salted.columns == plain.columns
        assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    finally:
        spark.conf.set(conf, before)


def test_salted_join_does_not_hand_a_subject_to_one_task(spark, skewed, some_labels):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        def shuffles(hot):
            grouped = P.label_posts(skewed, some_labels, hot=hot).groupBy("subject_id", "label").count()
            return grouped._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

        assert shuffles([]) == 2
        assert shuffles(["hot"]) == 3
    finally:
        spark.conf.set(conf, before)


def test_hot_subjects(skewed):
    assert P.hot_subjects(skewed, 0.1) == ["hot"]
    assert P.hot_subjects(skewed.limit(0)) == []


def test_posts_by_class(skewed, some_labels):
    labelled = P.label_posts(skewed, some_labels)
    assert {r.label for r in P.posts_by_class(labelled, 1).select("label").distinct().collect()} == {1}


def test_preview_is_ordered(skewed):
    rows = P.preview(skewed, ["subject_id", "pos"], ["subject_id", "pos"], 3).collect()
    assert [tuple(r) for r in rows] == [("hot", 0), ("hot", 1), ("hot", 2)]


def test_top_words(spark):
    rows = [(1, "Pain pain the http it's __ab"), (1, "pain sleep"), (0, "sleep, SLEEP! ok no-one"), (0, None)]
    df = spark.createDataFrame(rows, "label int, text string")
    got = [tuple(r) for r in words.top_words(df, n=2).orderBy("label", F.desc("count"), "word").collect()]
    assert got == [(0, "sleep", 2), (1, "pain", 3), (1, "__ab", 1)]
    stops = spark.createDataFrame([("pain",), ("sleep",)], "word string")
    table = words.word_frequency(df, stop_words=stops).where("label = 1").collect()
    assert {r.word for r in table} == {"the", "http", "__ab"}
    assert words.word_frequency(df, stop_words=()).where("word = 'the'").count() == 1


def test_subject_corpus(spark):
    rows = [("a", 1, 1, "y"), ("a", 1, 0, "x"), ("a", 1, 2, None), ("b", 0, 0, None), ("a", 1, 3, "z")]
    df = spark.createDataFrame(rows, "subject_id string, label int, pos int, text string")
    got = {(r.subject_id, r.segment): r.all_text for r in corpus.subject_corpus(df).collect()}
    assert got == {("a", 0): "x y z", ("b", 0): ""}
    cut = {(r.subject_id, r.segment): r.all_text for r in corpus.subject_corpus(df, posts_per_segment=2).collect()}
    assert cut == {("a", 0): "x y", ("a", 1): "z", ("b", 0): ""}


def test_records_of_one_subject_stay_apart(spark):
    """Thousands of one-post records of one id, whose positions all start at 0, make no large cell."""
    df = spark.range(5000).selectExpr("'hot' AS subject_id", "1 AS label", "id AS record", "0 AS pos", "'t' || id AS text")
    got = corpus.subject_corpus(df, record=("record",))
    assert got.count() == 5000 and got.where("segment = 0 AND all_text = 't' || record").count() == 5000


@pytest.mark.parametrize("chunk_chars", [7, 100, corpus.CHUNK_CHARS])
def test_rope_is_the_whole_text(spark, chunk_chars):
    """5000 posts of one subject, a very long post, empty and NULL texts: chunks joined are the whole text."""
    few = 5000 if chunk_chars > 7 else 300
    rows = [("hot", 1, i // 50, i % 50, f"pöst {i}" if i % 7 else None) for i in range(few)]
    rows += [("long", 0, 0, 0, "é" * 2000), ("long", 0, 0, 1, ""), ("long", 0, 1, 0, "end"), ("none", 0, 0, 0, None), (None, 0, 0, 0, "x"), ("void", 1, 0, 0, "")]
    df = spark.createDataFrame(rows, "subject_id string, label int, record int, pos int, text string").repartition(6)
    rope = corpus.subject_rope(df, order=("record", "pos"), chunk_chars=chunk_chars).cache()
    texts, want = {}, {}
    for r in rope.orderBy("chunk").collect():
        assert r.start == r.chunk * chunk_chars == len(texts.get(r.subject_id, "")) and r.n_chars == len(r.text) <= chunk_chars
        texts[r.subject_id] = texts.get(r.subject_id, "") + r.text
    for name in ("hot", "long", "none", None, "void"):
        want[name] = " ".join(r[4] for r in rows if r[0] == name and r[4] is not None)
    assert texts == want
    assert {r.subject_id: r.total_chars for r in rope.collect()} == {k: len(v) for k, v in want.items()}
    for start, length in ((0, 5), (95, 30), (350, 1)):
        got = {r.subject_id: r.text for r in corpus.rope_range(rope, start, length, chunk_chars=chunk_chars).collect()}
        assert {k: v for k, v in got.items() if v} == {k: v[start : start + length] for k, v in want.items() if v[start:]}
    rope.unpersist()


def test_rope_of_nothing(spark):
    assert corpus.subject_rope(spark.createDataFrame([], "subject_id string, label int, pos int, text string")).count() == 0
