"""Buckets of a numeric key with about equally many rows each, however the keys cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 128


def cut_points(df: DataFrame, key: str, buckets: int = BUCKETS) -> list[float]:
    """Quantiles of a key (a mergeable sketch of bounded size; nulls left out)."""
    got = df.select(F.col(key).cast("double").alias("k")).approxQuantile(
        "k", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    return sorted(set(got))


def bucket_of(key: Column, cuts: list[float]) -> Column:
    """Number of cuts below the key, by comparisons in a balanced tree; null keys get -1.

    The cast to double keeps the order of keys (equal at worst), so buckets
    follow it, and the exact key decides inside a bucket.
    """
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key.cast("double") <= cuts[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(key.isNull(), F.lit(-1)).otherwise(tree(0, len(cuts)))
