"""Hash expressions whose value depends only on the key, never on partitioning or retries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS_RANGE = 2**32


def key_bits(key: Column, salt: str = "") -> Column:
    """Uniform value in [0, 2^32) from the key; other salts give independent values."""
    text = key.cast("string")
    if salt:
        text = F.concat(text, F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def key_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    return key_bits(key, salt) % buckets
