"""Sums of the vectors that tasks return, one a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT = 1 << 22  # numbers that may reach the driver one by one (32 MB)


def partitions(df: DataFrame) -> int:
    """Partitions of a written table that have rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def sum_vectors(rows: DataFrame, tasks: int, width: int) -> np.ndarray:
    """The sum of the arrays ``v``: added up here while they are few, by position on executors beyond that."""
    if tasks * width <= DIRECT:
        got = [v.values.to_numpy() for v in rows.select("v").toArrow().column(0)]
        return np.sum(got, axis=0) if got else np.zeros(width)
    got = rows.select(F.posexplode("v").alias("pos", "s")).groupBy("pos").agg(F.sum("s").alias("s")).toArrow()
    return got.column("s").to_numpy()[np.argsort(got.column("pos").to_numpy())]
