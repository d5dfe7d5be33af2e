"""Reproducible split and balancing, decided row by row from the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.hashing import KEY_BITS_RANGE, key_bits, key_bucket

# Hash values are narrowed down by so many bits in a pass, so a histogram has at most 2**16 rows.
PREFIX_BITS = 16

# Balancing must not reuse the hash of the split, or the two would be correlated.
SAMPLE_SALT = ":sample"


def in_train(key: str, fraction: float = 0.8, salt: str = "") -> Column:
    """True for about ``fraction`` (whole percents) of the keys."""
    return key_bucket(F.col(key), 100, salt) < round(fraction * 100)


def keyed_split(
    df: DataFrame, key: str = "subject_id", fraction: float = 0.8, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``.  All rows of a key land on the same side, on any cluster, without a shuffle."""
    train = in_train(key, fraction, salt)
    return df.where(train), df.where(~train)


def random_split(df: DataFrame, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by Spark's own row-wise random split, as an option to :func:`keyed_split`.

    Rows of a key may land on both sides, and the split depends on how ``df`` is
    partitioned, so ``df`` should be a stored table of one row per key.
    """
    train, test = df.randomSplit([fraction, 1 - fraction], seed)
    return train, test


def _histogram_cut(rows: DataFrame, prefix: Column, n: int) -> tuple[int, int]:
    """``(p, r)``: the ``n``-th smallest row has prefix ``p`` and is the ``r``-th smallest row of that prefix."""
    counts = rows.groupBy(prefix.alias("p")).agg(F.count("*").alias("c"))
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    # At most 2**PREFIX_BITS rows meet in this window.
    cut = counts.withColumn("upto", F.sum("c").over(upto)).where(F.col("upto") >= n).orderBy("p").first()
    return cut.p, n - (cut.upto - cut.c)


def exact_sample(df: DataFrame, n: int, key: str = "subject_id", salt: str = SAMPLE_SALT) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer: those of the smallest ``(hash of key, key)``.

    The rows are not sorted.  Two histograms of hash prefixes, of at most 2**16 rows each,
    narrow the cut down to one hash value; only rows of that very value, some N / 2**32, are
    ranked by key.  Which rows stay depends on the keys alone.  A null key has the hash of
    the empty text; of equal keys, so of rows that the cut would divide, those of the smaller row hash stay.
    """
    bits = key_bits(F.coalesce(F.col(key).cast("string"), F.lit("")), salt)
    count = df.count()
    if count <= n:
        return df
    if n <= 0:
        return df.limit(0)
    low = 1 << (32 - PREFIX_BITS)
    prefix, rest = _histogram_cut(df, F.shiftright(bits, 32 - PREFIX_BITS), n)
    inside = df.where(F.shiftright(bits, 32 - PREFIX_BITS) == prefix)
    suffix, rest = _histogram_cut(inside, bits % low, rest)
    cut = prefix * low + suffix
    order = Window.orderBy(F.col(key).asc_nulls_first(), F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))
    rank = "".join(df.columns) + "_rank"  # no column has this name
    last = df.where(bits == cut).withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= rest).drop(rank)
    return df.where(bits < cut).unionByName(last)


def exact_undersample(subjects: DataFrame, key: str = "subject_id", label: str = "label") -> DataFrame:
    """Balanced rows: exactly as many of the larger class as the smaller one has; see :func:`exact_sample`.

    When a class is empty nothing is thinned; rows of other labels go.
    """
    classes = [subjects.where(F.col(label) == c) for c in (0, 1)]
    sizes = [own.count() for own in classes]
    n = min(sizes) or max(sizes)
    return exact_sample(classes[0], n, key).unionByName(exact_sample(classes[1], n, key))


def balance_limits(subjects: DataFrame) -> DataFrame:
    """One row, one array ``limits``: the key bits below which a row of class 0 or 1 is kept.

    The smaller class is kept whole, the larger one in proportion.  When a class is empty
    nothing is thinned.
    """
    n0, n1 = F.col("n0"), F.col("n1")
    smaller = F.least(n0, n1)
    limit = lambda own: F.when(smaller > 0, smaller / own).otherwise(1.0) * KEY_BITS_RANGE
    return subjects.agg(
        F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")
    ).select(F.array(limit(n0), limit(n1)).alias("limits"))


def kept_by_balance(key: str, limits: Column) -> Column:
    """Whether a row stays; ``limits`` is the value of :func:`balance_limits`.  Other labels go."""
    own = F.get(limits, F.col("label"))
    return F.coalesce(key_bits(F.col(key), SAMPLE_SALT) < own, F.lit(False))


def undersample(subjects: DataFrame, key: str = "subject_id") -> DataFrame:
    """Balanced rows: the larger class is thinned at random (by key) to about the smaller's size.

    One filter stands for sampling one class and uniting it with the other.  The class
    sizes come from a scalar subquery, not through the driver program.
    """
    return subjects.where(kept_by_balance(key, balance_limits(subjects).scalar()))
