"""Command line: ``spark-submit jobs.py <job> --posts 'data/chunk*/*.xml' --labels labels.txt ...``.

Jobs: ``preview`` of the posts, ``etl`` (clean and tokenize, with class counts), ``words``
(most frequent words per class), ``tfidf`` and ``embedding`` (train, evaluate and save a
classifier; ``embedding`` also writes the dashboard's views).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators import evaluate, sampling, similarity, summary, words
from postlens.operators.posts import preview
from postlens.plans import dashboard, embedding_classifier, etl, tfidf_classifier
from postlens.sources.labels import label_rejects, read_labels
from postlens.sources.staging import scratch, stage, staging_path
from postlens.sources.subjects import accepted, read_subjects_xml, rejects
from postlens.sources.views import write_view


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = args.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str):
        sub = jobs.add_parser(name)
        sub.add_argument("--posts", required=True, help="path or glob of the XML files")
        sub.add_argument("--encoding", default="UTF-8", help="of the XML files")
        for option in options:
            sub.add_argument(option, required=True)
        return sub

    job("preview").add_argument("--rows", type=int, default=5)
    job("etl", "--labels", "--out")
    job("words", "--labels", "--out").add_argument("--top", type=int, default=100)
    job("tfidf", "--labels", "--model", "--out")
    embedding = job("embedding", "--labels", "--model", "--out")
    embedding.add_argument("--seeds", nargs="+", default=list(similarity.SEED_WORDS))
    embedding.add_argument("--min-similarity", type=float)
    embedding.add_argument("--partitions", type=int, default=embedding_classifier.NUM_PARTITIONS, help="Word2Vec tasks")
    return args


def training_posts(spark: SparkSession, args, fields: tuple[str, ...]) -> DataFrame:
    """Labelled posts with normalized text, parsed and joined once."""
    labelled = etl.read_labelled_posts(spark, args.posts, args.labels, fields, args.encoding)
    return stage(etl.normalized_text(labelled), staging_path(spark, "posts"))


def write_imbalance(posts: DataFrame, args) -> None:
    """How many training subjects each class has, before balancing."""
    train = posts.where(sampling.in_train("subject_id")).select("subject_id", "label").distinct()
    write_view(summary.class_imbalance(train), f"{args.out}/imbalance", "csv")


def run_preview(spark, args):
    posts = etl.read_posts(spark, args.posts, encoding=args.encoding)
    posts.printSchema()
    preview(posts, posts.columns, ["subject_id", "chunk", "pos"], args.rows).show(truncate=40)
    print("posts:", posts.count())


def run_etl(spark, args):
    # The records are parsed once, for the posts and for the rejects.
    subjects = read_subjects_xml(spark, args.posts, corrupt=True, encoding=args.encoding)
    subjects = stage(subjects, staging_path(spark, "subjects"))
    labelled = etl.flatten_labelled(accepted(subjects), read_labels(spark, args.labels), etl.RECORD)
    etl.process(labelled).write.mode("overwrite").parquet(f"{args.out}/posts")
    done = spark.read.parquet(f"{args.out}/posts")
    rejects(subjects).write.mode("overwrite").parquet(f"{args.out}/post_rejects")
    label_rejects(spark, args.labels).write.mode("overwrite").parquet(f"{args.out}/label_rejects")
    counts = summary.class_counts(summary.subject_totals(done))
    write_view(counts, f"{args.out}/class_counts", "csv")
    counts.show()
    preview(done, ["subject_id", "label", "filtered_words"], ["subject_id", "pos"]).show(truncate=80)


def run_words(spark, args):
    labelled = etl.read_labelled_posts(spark, args.posts, args.labels, ("TEXT",), args.encoding)
    top = words.top_words(labelled, n=args.top)
    write_view(top, f"{args.out}/top_words", "csv", ("label", F.desc("count"), "word"))


def _evaluate(fitted, args) -> DataFrame:
    fitted.model.write().overwrite().save(args.model)
    matrix = stage(
        evaluate.confusion(fitted.predictions()), staging_path(fitted.test.sparkSession, "confusion")
    )
    matrix.show()
    metrics = evaluate.classification_metrics(matrix)
    metrics.show()
    return metrics


def run_tfidf(spark, args):
    posts = training_posts(spark, args, ("TEXT",))
    write_imbalance(posts, args)
    fitted = tfidf_classifier.fit(posts)
    write_view(_evaluate(fitted, args), f"{args.out}/metrics", "csv", ("metric_name",))
    vocab = tfidf_classifier.model_vocabulary(fitted.model, spark)
    write_view(vocab, f"{args.out}/vocabulary", "csv", ("index",))


def run_embedding(spark, args):
    posts = training_posts(spark, args, ("DATE", "TEXT"))
    write_imbalance(posts, args)
    facts = dashboard.stage_facts(posts)
    fitted = embedding_classifier.fit(posts, num_partitions=args.partitions)
    metrics = _evaluate(fitted, args)
    near = embedding_classifier.similar_words(
        fitted.model, args.seeds, min_similarity=args.min_similarity
    )
    views = {
        **dashboard.post_views(facts),
        "dashboard_metrics": dashboard.metrics_view(metrics),
        "dashboard_semantic_words": dashboard.semantic_view(near),
    }
    dashboard.write_views(views, args.out)


JOBS = {
    "preview": run_preview,
    "etl": run_etl,
    "words": run_words,
    "tfidf": run_tfidf,
    "embedding": run_embedding,
}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"postlens-{args.job}").getOrCreate()
    # Hours and weekdays must not depend on the machine.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    with scratch(spark):
        JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
