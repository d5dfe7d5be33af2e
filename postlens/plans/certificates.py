"""Certificates of fitted classifiers: predictions replayed by joins and aggregates from a model's tables.

A model's parameters become relations: a regression's weights per vocabulary word, a
forest's nodes per tree.  Both are bounded by the models' parameters.  Replaying predictions from them checks
what a model computed without its own code, and the regression's gradient tells whether it is an optimum.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.plans import embedding_classifier, tfidf_classifier
from postlens.sources.staging import staging_path

KEYS = ("subject_id", "label")


def regression_weights(fitted: tfidf_classifier.Fitted) -> DataFrame:
    """``(index, idf, weight)`` of the words that the regression knows."""
    *_, idf, classifier = fitted.model.stages
    rows = [(i, float(x), float(w)) for i, (x, w) in enumerate(zip(idf.idf.toArray(), classifier.coefficients.toArray(), strict=True))]
    return fitted.train.sparkSession.createDataFrame(rows, "index int, idf double, weight double")


def _entries(table: DataFrame) -> DataFrame:
    """``(*keys, index, n)``: the entries of count vectors."""
    vector = F.unwrap_udt("raw_features")
    return table.select(*KEYS, F.inline(F.arrays_zip(vector["indices"].alias("index"), vector["values"].alias("n"))))


def replay_regression(table: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """``(*keys, p)``: the probability of class 1 as a sum over joined entries; a subject without words has its intercept."""
    sums = _entries(table).join(weights, "index").groupBy(*KEYS).agg(F.sum(F.col("n") * F.col("idf") * F.col("weight")).alias("sum"))
    margin = F.lit(intercept) + F.coalesce("sum", F.lit(0.0))
    return table.select(*KEYS).join(sums, list(KEYS), "left").select(*KEYS, (1 / (1 + F.exp(-margin))).alias("p"))


def gradient(table: DataFrame, weights: DataFrame, probabilities: DataFrame) -> DataFrame:
    """``(index, slope)``: the mean loss's derivative by each weight; index -1 is the intercept."""
    count = probabilities.agg(F.count("*")).scalar()
    errors = probabilities.select(*KEYS, (F.col("p") - F.col("label")).alias("error"))
    by_word = (
        _entries(table).join(weights, "index").join(errors, list(KEYS))
        .groupBy("index").agg((F.sum(F.col("error") * F.col("n") * F.col("idf")) / count).alias("slope"))
    )
    return by_word.unionByName(errors.agg(F.lit(-1).alias("index"), (F.sum("error") / count).alias("slope")))


def regression_certificate(fitted: tfidf_classifier.Fitted) -> DataFrame:
    """One row: the largest difference of a replayed test probability, the gradient's norm, and that of the best constant.

    A regression trained to its end minimizes the training loss, so its gradient is far smaller than
    that of the model which gives every subject the classes' share, where iterations begin.  One that
    a number of iterations cut short may not be there yet.
    """
    classifier = fitted.model.stages[-1]
    weights = F.broadcast(regression_weights(fitted))
    test = replay_regression(fitted.test, weights, classifier.intercept)
    own = fitted.predictions().select(*KEYS, vector_to_array("probability")[1].alias("q"))
    differences = own.join(test, list(KEYS), "left").agg(
        F.count("*").alias("n_test"),
        F.max(F.coalesce(F.abs(F.col("p") - F.col("q")), F.lit(1.0))).alias("difference"),
        F.count_distinct(F.round("q", 6)).alias("distinct_probabilities"),
    )
    train = replay_regression(fitted.train, weights, classifier.intercept)
    share = train.agg(F.avg("label")).scalar()
    at_constant = gradient(fitted.train, weights, train.select(*KEYS, share.alias("p")))
    at_model = gradient(fitted.train, weights, train)
    norm = lambda slopes, name: slopes.agg(F.sqrt(F.sum(F.col("slope") ** 2)).alias(name)).scalar()
    return differences.withColumns({"gradient": norm(at_model, "g"), "gradient_of_constant": norm(at_constant, "g")})


def forest_nodes(forest: RandomForestClassificationModel, spark) -> DataFrame:
    """``(tree, node, feature, threshold, left, right, shares)``: the saved model's node table; a leaf has no children (-1).

    ``shares`` are a node's class counts, normalized.
    """
    path = staging_path(spark, "forest")
    forest.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.transform("impurityStats", lambda x: F.try_divide(x, total)).alias("shares"),
    )


def replay_forest(table: DataFrame, nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """``(*keys, p)``: each subject walks every tree, one join a level, and averages the shares of class 1 where it ends."""
    features = vector_to_array("features").alias("x")
    at = table.select(*KEYS, features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for level in range(depth + 1):
        joined = at.join(F.broadcast(nodes), ["tree", "node"])
        if level == depth:
            break
        inner = F.col("left") >= 0
        goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
        node = F.when(~inner, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = joined.select(*KEYS, "x", "tree", node.alias("node"))
    return joined.groupBy(*KEYS).agg(F.avg(F.get("shares", F.lit(1))).alias("p"))


def forest_certificate(fitted: embedding_classifier.Fitted) -> DataFrame:
    """One row: the largest difference of a replayed test probability, and how many different ones there are."""
    forest = fitted.model.stages[-1]
    nodes = forest_nodes(forest, fitted.test.sparkSession)
    own = fitted.predictions().select(*KEYS, vector_to_array("probability")[1].alias("q"))
    return own.join(replay_forest(fitted.test, nodes, forest.getNumTrees, forest.getMaxDepth()), list(KEYS), "left").agg(
        F.count("*").alias("n_test"),
        F.max(F.coalesce(F.abs(F.col("p") - F.col("q")), F.lit(1.0))).alias("difference"),
        F.count_distinct(F.round("q", 6)).alias("distinct_probabilities"),
    )
