"""K-means in Arrow batches, nearest centroid, and majority-label error.

A round is one scan: every task assigns its batches with NumPy and returns, per
cluster, the member count and the feature sums, so that only k rows per task
are shuffled.  The k centroids travel to the tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from locuspark.functions.rng import hash60


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Row number of the nearest centroid (squared Euclidean); the first of equals."""
    gaps = np.stack([((points - c) ** 2).sum(1) for c in centroids], 1)
    return gaps.argmin(1).astype(np.int32)


def assign_nearest(vectors: DataFrame, centroids, features: str = "features", out: str = "cluster") -> DataFrame:
    """``out`` = index of the nearest centroid, lowest index on ties."""
    cents = np.asarray(centroids, dtype=float)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: nearest(np.stack(pdf[features]), cents) if len(pdf) else np.empty(0, np.int32)})

    schema = StructType([*vectors.schema.fields]).add(out, IntegerType())
    return vectors.mapInPandas(label, schema)


def _drawn(vectors: DataFrame, n: int, key: list, id_col: str, features: str) -> list:
    """The ``n`` rows first in a hashed order (a top-n, no full sort)."""
    order = hash60(*[F.lit(x) for x in key], F.col(id_col))
    return vectors.select(id_col, features, order.alias("_h")).orderBy("_h", id_col).limit(n).collect()


def sample_k(vectors: DataFrame, k: int, seed: int, id_col: str = "vec_id", features: str = "features"):
    """R2: features and ids of k distinct rows in hashed draw order; an error where the table is shorter."""
    rows = _drawn(vectors, k, [seed], id_col, features)
    if len(rows) < k:
        raise ValueError(f"cannot draw {k} rows from a table of {len(rows)}")
    return np.array([r[features] for r in rows], dtype=float), [r[id_col] for r in rows]


def centroid_means(assigned: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """A10 (partial): member mean per cluster: cluster, n, mean ARRAY<DOUBLE>."""
    v = assigned.select(cluster, array_to_vector(F.col(features)).alias("_v"))
    g = v.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("_m"))
    return g.select(cluster, "n", vector_to_array("_m").alias("mean"))


def round_means(vectors: DataFrame, centroids: np.ndarray, features: str = "features") -> dict[int, np.ndarray]:
    """Mean of the members that each centroid attracts; clusters without members are absent."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape)
        for pdf in batches:
            if len(pdf):
                points = np.stack(pdf[features])
                member = nearest(points, centroids)
                count += np.bincount(member, minlength=len(count))
                np.add.at(total, member, points)
        held = np.flatnonzero(count)
        if len(held):
            yield pd.DataFrame({"cluster": held, "n": count[held], "total": [total[c] for c in held]})

    parts = vectors.select(features).mapInPandas(sums, "cluster int, n long, total array<double>")
    rows = parts.select("cluster", "n", array_to_vector("total").alias("t")).groupBy("cluster").agg(
        F.sum("n").alias("n"), vector_to_array(Summarizer.sum(F.col("t"))).alias("total")).collect()  # k rows
    return {r["cluster"]: np.array(r["total"]) / r["n"] for r in rows}


def kmeans(vectors: DataFrame, k: int, max_iters: int = 300, tol: float = 1e-4, seed: int = 0,
           id_col: str = "vec_id", features: str = "features"):
    """M1: (labels DataFrame, centroids, rounds).  Labels belong to the centroids before the last update.

    A cluster that lost all members gets a newly drawn row; the rounds end when
    no centroid moves by ``tol`` or more.
    """
    after, _ = sample_k(vectors, k, seed, id_col, features)
    before, rounds, moved = after, 0, np.inf
    while rounds < max_iters and moved >= tol:
        before, rounds = after, rounds + 1
        means = round_means(vectors, before, features)
        for lost in set(range(k)) - means.keys():
            means[lost] = np.array(_drawn(vectors, 1, [seed, rounds, lost], id_col, features)[0][features], dtype=float)
        after = np.stack([means[c] for c in range(k)])
        moved = np.sqrt(((after - before) ** 2).sum(1)).max()
    return assign_nearest(vectors, before, features), after, rounds


def clustering_error(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Sum over clusters of (size - majority label count)."""
    c = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("cnt"))
    per = c.groupBy(cluster).agg((F.sum("cnt") - F.max("cnt")).alias("err"))
    return per.agg(F.coalesce(F.sum("err"), F.lit(0)).cast("bigint").alias("error"))
