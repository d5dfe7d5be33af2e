"""Which subjects train a model and which test it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.hashing import KEY_BITS_RANGE, key_bits
from postlens.operators import sampling


def bounded_training(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows`` with those training subjects left out that exceed ``most``, chosen by key hash; all rows without it.

    A threshold on the hash keeps about ``most`` subjects; test subjects all stay.  For
    callers that want fewer subjects: the fits of this package take all of them.
    """
    if most is None:
        return rows
    count = rows.where("is_train").agg(F.count_distinct("subject_id").alias("n")).scalar()
    limit = F.least(F.lit(1.0), F.try_divide(F.lit(float(most)), count)) * KEY_BITS_RANGE
    return rows.where(~F.col("is_train") | (key_bits(F.col("subject_id"), ":bound") < limit))


def train_and_test(labelled: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """Posts of the balanced training subjects and of all test subjects, with ``is_train``.

    Both decisions are functions of the subject id and of two class sizes, so posts are
    filtered where they are: no join of a subject list, no shuffle of text.  The sizes need
    a pass of their own over ids and labels, so ``labelled`` should be a stored table.
    """
    is_train = sampling.in_train("subject_id", train_fraction)
    train_subjects = labelled.where(is_train).select("subject_id", "label").distinct()
    limits = sampling.balance_limits(train_subjects).scalar()
    return labelled.withColumn("is_train", is_train).where(
        ~F.col("is_train") | sampling.kept_by_balance("subject_id", limits)
    )
