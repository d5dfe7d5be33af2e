from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import jobs
from postlens.operators import evaluate
from postlens.plans import etl, roles
from postlens.sources.staging import shared_folder
from postlens.sources.subjects import write_subjects_xml
from postlens.sources.views import VIEWS, read_dashboard_view


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """300 subjects in two chunks, XML and label lines."""
    folder = tmp_path_factory.mktemp("data")
    n = F.col("id")
    mood = F.when(n % 3 == 0, F.lit("sad tired alone")).otherwise(F.lit("sunny bright happy"))
    for chunk in (1, 2):
        text = F.concat_ws(" ", mood, F.concat(F.lit("word"), n % 7), F.lit("SEE http://x.y/z"))
        write = F.struct(
            F.lit(" t ").alias("TITLE"),
            F.format_string("2024-0%d-%02d 10:00:00", F.lit(chunk), (n % 28 + 1).cast("int")).alias("DATE"),
            F.lit("i").alias("INFO"),
            text.alias("TEXT"),
        )
        subjects = spark.range(300).select(
            F.concat(F.lit("subject"), "id").alias("ID"), F.array_repeat(write, 3).alias("WRITING")
        )
        write_subjects_xml(subjects, str(folder / f"chunk{chunk}"))
    lines = [f"subject{i} {int(i % 3 == 0)}" for i in range(300)] + ["broken"]
    (folder / "labels.txt").write_text("\n".join(lines))
    return ["--posts", str(folder / "chunk*" / "*.xml")], ["--labels", str(folder / "labels.txt")]


def test_preview(spark, inputs, capsys):
    jobs.main(["preview", *inputs[0]])
    assert "posts: 1800" in capsys.readouterr().out


def test_etl(spark, inputs, tmp_path):
    for _ in range(2):  # a second run replaces the first one's results
        jobs.main(["etl", *inputs[0], *inputs[1], "--out", str(tmp_path / "out")])
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    done = spark.read.parquet(str(tmp_path / "out" / "posts"))
    assert done.count() == 1800
    assert set(done.first().filtered_words) & {"sad", "sunny"} and "http" not in done.first().clean_text
    counts = spark.read.csv(str(tmp_path / "out" / "class_counts"), header=True, inferSchema=True).first()
    assert tuple(counts) == (1800, 600, 1200)
    assert spark.read.parquet(str(tmp_path / "out" / "label_rejects")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "post_rejects")).count() == 0


def test_words(spark, inputs, tmp_path):
    jobs.main(["words", *inputs[0], *inputs[1], "--out", str(tmp_path), "--top", "3"])
    rows = spark.read.csv(str(tmp_path / "top_words"), header=True, inferSchema=True).collect()
    assert [(r.label, r.word) for r in rows] == [
        (0, "bright"), (0, "happy"), (0, "sunny"), (1, "alone"), (1, "sad"), (1, "tired"),
    ]


def test_tfidf(spark, inputs, tmp_path):
    out, model = str(tmp_path / "out"), str(tmp_path / "model")
    folder = Path(shared_folder(spark).removeprefix("file:")) / "postlens"
    before = set(folder.glob("*")) if folder.exists() else set()
    jobs.main(["tfidf", *inputs[0], *inputs[1], "--out", out, "--model", model])
    assert set(folder.glob("*")) == before
    imbalance = spark.read.csv(f"{out}/imbalance", header=True, inferSchema=True).first()
    assert imbalance.n_rows == imbalance.n_class0 + imbalance.n_class1 > 200
    metrics = spark.read.csv(f"{out}/metrics", header=True, inferSchema=True).collect()
    assert {r.metric_name for r in metrics} == set(evaluate.METRICS)
    vocab = spark.read.csv(f"{out}/vocabulary", header=True, inferSchema=True).orderBy("index").collect()
    assert [r.word for r in vocab] == PipelineModel.load(model).stages[2].vocabulary


def test_embedding(spark, inputs, tmp_path):
    out, model = str(tmp_path / "out"), str(tmp_path / "model")
    jobs.main(["embedding", *inputs[0], *inputs[1], "--out", out, "--model", model, "--seeds", "tired", "pain"])
    views = {name: read_dashboard_view(spark, out, name) for name in VIEWS}
    assert views["dashboard_kpi"].first().total_posts == 1800
    assert views["dashboard_scatter"].count() == 300
    assert views["dashboard_time_dep"].agg(F.sum("count")).first()[0] == 600
    assert views["dashboard_semantic_words"].count() > 0
    assert "tired" not in {r.word for r in views["dashboard_semantic_words"].collect()}
    assert len(PipelineModel.load(model).stages) == 4


def test_label_path_must_exist(spark, inputs, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        etl.read_labelled_posts(spark, inputs[0][1], str(Path(tmp_path) / "none.txt"))


def test_jobs_train_on_every_subject(spark, inputs, tmp_path, monkeypatch):
    """No job leaves out training subjects beyond the balance of the classes."""
    def thin(*_):
        raise AssertionError("training subjects are thinned")

    monkeypatch.setattr(roles, "bounded_training", thin)
    model = str(tmp_path / "model")
    jobs.main(["tfidf", *inputs[0], *inputs[1], "--out", str(tmp_path / "out"), "--model", model])
    assert len(PipelineModel.load(model).stages) == 5
