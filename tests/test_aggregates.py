import datetime as dt

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from postlens.functions import calendar
from postlens.operators import activity as A
from postlens.operators import evaluate, sampling, summary


@pytest.fixture
def facts(spark):
    rows = [
        ("a", 1, dt.datetime(2015, 5, 3, 1, 2, 3), 10),
        ("a", 1, dt.datetime(2015, 5, 3, 1, 59, 0), 20),
        ("b", 0, dt.datetime(2015, 5, 4, 23, 0, 0), None),
        ("b", 0, None, 3),
        ("c", 0, dt.datetime(2015, 5, 9, 0, 0, 0), 4),
    ]
    return spark.createDataFrame(rows, "subject_id string, label int, date timestamp, word_count int")


def test_totals_with_and_without_label_table(spark, facts):
    labels = facts.select("subject_id", "label").distinct()
    joined = summary.subject_totals(facts.drop("label"), labels)
    own = summary.subject_totals(facts)
    assert joined.columns == own.columns == ["subject_id", "label", "posts", "words", "counted"]
    assert sorted(joined.collect()) == sorted(own.collect())


def test_kpis(facts):
    totals = summary.subject_totals(facts)
    row = summary.kpi(totals).first()
    plain = facts.agg(F.count("*"), F.avg("label"), F.avg("word_count")).first()
    assert tuple(row) == pytest.approx(tuple(plain))
    by_class = {r.label: (r.total_posts, r.avg_length) for r in summary.kpi_by_class(totals).collect()}
    assert by_class == {1: (2, 15.0), 0: (3, 3.5)}
    assert tuple(summary.class_counts(totals).first()) == (5, 2, 3)
    assert tuple(summary.class_imbalance(totals).first()) == (3, 1, 2, 50.0)
    verbosity = [tuple(r) for r in summary.subject_verbosity(totals, 2).collect()]
    assert verbosity == [("a", 1, 15.0), ("b", 0, 3.0)]


def test_kpis_of_nothing(facts):
    totals = summary.subject_totals(facts.where("false"))
    assert tuple(summary.kpi(totals).first()) == (0, None, None)
    assert tuple(summary.class_counts(totals).first()) == (0, 0, 0)
    assert summary.class_imbalance(totals).first().imbalance_pct is None


def test_cards_without_metric(spark, facts):
    row = summary.kpi(summary.subject_totals(facts))
    none = spark.createDataFrame([], "metric_name string, value float")
    one = spark.createDataFrame([("f1_score", 0.75), ("accuracy", 0.5)], "metric_name string, value float")
    assert summary.kpi_cards(row, none).first().f1_score == 0.0
    assert summary.kpi_cards(row, one).first().f1_score == 0.75


def test_activity(facts):
    cells = A.activity(facts)
    got = {(r.label, r.day, r.hour): r["count"] for r in cells.collect()}
    assert got == {(1, 1, 1): 2, (0, 2, 23): 1, (0, None, None): 1, (0, 7, 0): 1}
    assert [tuple(r) for r in A.heatmap(cells, 1).collect()] == [(1, 1, 2)]
    assert A.heatmap(cells, 0).columns == ["day", "hour", "count"]


def test_activity_with_a_label_table(facts):
    labels = facts.select("subject_id", "label").distinct()
    joined = A.activity(facts.drop("label"), labels)
    assert joined.exceptAll(A.activity(facts)).count() == 0 and joined.count() == 4


def test_grid_is_dense(facts):
    grid = A.heatmap_grid(A.activity(facts)).cache()
    assert grid.count() == 2 * 7 * 24
    assert grid.agg(F.sum("count")).first()[0] == 4  # posts with a date
    assert grid.where("label = 1 and day = 1 and hour = 1").first().day_name == "Dom"
    matrix = A.heatmap_matrix(grid)
    assert matrix.count() == 14 and matrix.columns[3:] == [f"h{h}" for h in range(24)]
    assert matrix.where("label = 0 and day = 7").first().h0 == 1
    names = {r.day: r.day_name for r in grid.select("day", "day_name").distinct().collect()}
    assert tuple(names[d] for d in range(1, 8)) == calendar.DAY_NAMES


def test_day_name_of_no_day(spark):
    df = spark.createDataFrame([(None,), (0,), (8,), (7,)], "d int")
    got = [r[0] for r in df.select(calendar.day_name(F.col("d"))).collect()]
    assert got == [None, None, None, "Sab"]


def test_hourly_share(facts):
    share = {(r.label, r.hour): r.share for r in A.hourly_share(A.activity(facts)).collect()}
    assert share == {(1, 1): 1.0, (0, 23): 0.5, (0, 0): 0.5}


# --- sampling --------------------------------------------------------------


def subjects(spark, n1, n0, other=0):
    rows = [(f"p{i}", 1) for i in range(n1)] + [(f"c{i}", 0) for i in range(n0)] + [(f"x{i}", None) for i in range(other)]
    return spark.createDataFrame(rows, "subject_id string, label int")


def test_split_is_complete_and_disjoint(spark):
    df = subjects(spark, 500, 1500)
    train, test = sampling.keyed_split(df)
    assert train.count() + test.count() == 2000
    assert train.join(test, "subject_id").count() == 0
    assert 1500 < train.count() < 1700
    again, _ = sampling.keyed_split(df.repartition(13))
    assert again.exceptAll(train).count() == 0


def test_undersample_thins_the_larger_class(spark):
    for n1, n0 in ((200, 2000), (2000, 200)):
        balanced = sampling.undersample(subjects(spark, n1, n0, 5))
        got = {r.label: r["count"] for r in balanced.groupBy("label").count().collect()}
        small, large = (1, 0) if n1 < n0 else (0, 1)
        assert got[small] == 200 and 140 < got[large] < 260 and set(got) == {0, 1}


def test_undersample_with_one_class_keeps_all(spark):
    assert sampling.undersample(subjects(spark, 17, 0, 3)).count() == 17
    assert sampling.undersample(subjects(spark, 0, 9)).count() == 9


def test_sample_is_independent_of_the_split(spark):
    train, test = sampling.keyed_split(subjects(spark, 300, 6000))
    for part in (train, test):
        n1 = part.where("label = 1").count()
        n0 = sampling.undersample(part).where("label = 0").count()
        assert 0.7 * n1 < n0 < 1.3 * n1


# --- evaluation ------------------------------------------------------------

GOLDEN = [(1, 1.0)] * 3 + [(1, 0.0)] * 2 + [(0, 0.0)] * 10 + [(0, 1.0)] * 4
THREE = [(0, 0.0)] * 5 + [(1, 2.0)] * 3 + [(2, 2.0)] * 4 + [(2, 0.0)] + [(1, 1.0)] * 2
NEVER_PREDICTED = [(0, 0.0)] * 4 + [(1, 0.0)] * 2
UNKNOWN_CLASS = [(0, 0.0)] * 4 + [(0, 3.0)] + [(1, 1.0)]


@pytest.mark.parametrize("rows", [GOLDEN, THREE, NEVER_PREDICTED, UNKNOWN_CLASS])
def test_metrics_equal_the_ml_evaluator(spark, rows):
    df = spark.createDataFrame(rows, "label int, prediction double")
    got = {r.metric_name: r.value for r in evaluate.classification_metrics(evaluate.confusion(df)).collect()}
    names = {
        "accuracy": "accuracy",
        "f1_score": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }
    typed = df.withColumn("label", F.col("label").cast("double"))
    for mine, theirs in names.items():
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(typed)
        assert got[mine] == pytest.approx(want, abs=1e-12), mine
    assert got["weighted_recall"] == pytest.approx(got["accuracy"])


def test_golden_metrics(spark):
    df = spark.createDataFrame(GOLDEN, "label int, prediction double")
    got = [round(r.value, 6) for r in evaluate.classification_metrics(evaluate.confusion(df)).collect()]
    assert got == [0.684211, 0.698381, 0.726817, 0.684211]


def test_confusion_has_no_empty_cells(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (0, 0.0)], "label int, prediction double")
    assert {tuple(r) for r in evaluate.confusion(df).collect()} == {(1, 1.0, 1), (0, 0.0, 2)}


def expected_sample(keys, n):
    import hashlib

    own = lambda k: int(hashlib.md5(f"{'' if k is None else k}:sample".encode()).hexdigest()[:8], 16)
    return sorted(keys, key=lambda k: (own(k), k is not None, k))[:n]


@pytest.mark.parametrize("prefix_bits", [16, 4])
def test_exact_sample(spark, monkeypatch, prefix_bits):
    """Exactly n rows by hash, for every n, also where a histogram's bars hold many rows."""
    monkeypatch.setattr(sampling, "PREFIX_BITS", prefix_bits)
    keys = list(range(60))
    df = spark.createDataFrame([(k, "x") for k in keys], "subject_id long, subject_id_rank string").repartition(5)
    for n in (0, 1, 2, 31, 59, 60, 100):
        got = sampling.exact_sample(df, n)
        assert got.columns == df.columns
        assert sorted(r.subject_id for r in got.collect()) == sorted(expected_sample(keys, n))


def test_exact_sample_of_repeated_and_null_keys(spark):
    rows = [(7, i) for i in range(50)] + [(None, 1), (None, 2), (3, 3)]
    df = spark.createDataFrame(rows, "subject_id long, x int")
    for n in (1, 2, 10, 52):
        got = sampling.exact_sample(df, n).collect()
        assert len(got) == n == len(set(got))
        assert sorted(map(str, (r.subject_id for r in got))) == sorted(map(str, expected_sample([k for k, _ in rows], n)))
    assert sampling.exact_sample(df.limit(0), 3).count() == 0


def test_exact_undersample(spark):
    for n1, n0 in ((17, 40), (40, 17), (5, 5)):
        got = sampling.exact_undersample(subjects(spark, n1, n0, 5))
        assert {r.label: r["count"] for r in got.groupBy("label").count().collect()} == {0: min(n1, n0), 1: min(n1, n0)}
    assert sampling.exact_undersample(subjects(spark, 9, 0, 3)).count() == 9


def test_random_split(spark):
    df = spark.range(1000).withColumnRenamed("id", "subject_id")
    train, test = sampling.random_split(df, 0.8, seed=1)
    assert train.unionByName(test).distinct().count() == 1000 and 700 < train.count() < 900
