"""Joins and counts that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than 1 / HOT_KEYS of all rows; so there are fewer than HOT_KEYS of them, and as hashes of
# 16 bytes they take a few MB. Other keys are smaller than a task's share, even of a shuffle of tens of thousands of tasks.
HOT_KEYS = 1 << 16


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key, ``key, n``; combined before the shuffle, so a hot key costs one row per task."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def drop_frequent(rows: DataFrame, key: str, max_times: int) -> DataFrame:
    """Drop all rows whose key occurs more than ``max_times`` times.

    Hot keys are dropped first, against a broadcast that can hold at most ``HOT_KEYS`` keys whatever the
    data. After that no key is large enough to unbalance the shuffle for the other repeated keys. Keys should be
    short, such as hashes, and rows light: they are shuffled.
    """
    counts = key_counts(rows, key).filter(F.col(key).isNotNull())
    frequent = counts.filter(F.col("n") > max_times)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    hot = frequent.filter(F.col("n") * HOT_KEYS > total).select(key)
    warm = frequent.filter(F.col("n") * HOT_KEYS <= total).select(key)
    return rows.join(F.broadcast(hot), key, "left_anti").join(warm, key, "left_anti")
