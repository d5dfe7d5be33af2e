"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs per query after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from postlens.catalog.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "class_counts",
    "kpi",
    "class_imbalance",
    "heatmap_all",
    "heatmap_grid",
    "subject_verbosity",
    "top_words",
    "clean_text",
    "tokens_filtered",
    "etl_process",
    "subject_corpus",
    "vocabulary",
    "tfidf",
    "balanced_train",
    "classification_metrics",
    "similar_vectors",
    "xml_posts_roundtrip",
    "lr_metrics",
    "rf_metrics",
    "similar_words",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("postlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    # The noop sink computes every row and column, and brings none to the driver.
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = session()
    seconds = {}
    for name in names:
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
