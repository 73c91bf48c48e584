"""Covariance, PCA (fit / transform / inverse), row normalisation and NMF.

The d x d covariance is accumulated on executors (one BLAS product per
Arrow batch, added up within the task, then summed by a grouped aggregate); only d x d numbers reach the
driver, where the eigendecomposition runs.  Scores and reconstructions are
JVM-side expressions over broadcast literals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.functions.sums import partitions, sum_vectors

MAX_DIM = 4096   # widest dense d x d matrix; beyond, pca_fit works on d x (k + EXTRA) numbers
EXTRA, MAX_PASSES, RITZ_TOL = 10, 300, 1e-10  # wide vectors: extra directions, passes at most, change of the eigenvalues at the end


def column_means(vectors: DataFrame, features: str = "features") -> np.ndarray:
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    r = vectors.select(Summarizer.mean(array_to_vector(F.col(features))).alias("m")).first()
    return np.asarray(r["m"].toArray(), dtype=float)


def center(vectors: DataFrame, mean, features: str = "features", out: str | None = None) -> DataFrame:
    """Subtract the column mean (broadcast literal)."""
    mu = F.array(*[F.lit(float(x)) for x in mean])
    return vectors.withColumn(out or features, F.zip_with(F.col(features), mu, lambda a, b: a - b))


def covariance(vectors: DataFrame, features: str = "features", mean=None) -> DataFrame:
    """Sample covariance (n-1) as a long table (i, j, cov).

    Two passes: the mean, then centred cross products per Arrow batch,
    summed per cell.  Output rows: d*d.
    """
    mu = column_means(vectors, features) if mean is None else np.asarray(mean, dtype=float)
    d = len(mu)
    if d > MAX_DIM:
        raise ValueError(f"width {d}: the covariance table would have {d * d} cells; pca_fit works without it")

    def gram(x: np.ndarray) -> np.ndarray:
        c = x - mu
        return np.append((c.T @ c).ravel(), len(c))

    from locuspark.session import spread
    cells = task_sums(spread(vectors.select(features)), features, gram).withColumn(
        "n", F.max(F.when(F.col("pos") == d * d, F.col("s"))).over(Window.partitionBy()))  # d * d + 1 rows
    return cells.where(F.col("pos") < d * d).select(
        F.expr(f"CAST(pos div {d} AS INT)").alias("i"), F.expr(f"CAST(pos % {d} AS INT)").alias("j"),
        (F.col("s") / (F.col("n") - 1)).alias("cov"))


def _task_vectors(vectors: DataFrame, features: str, numbers) -> DataFrame:
    """``v``: the vectors ``numbers(matrix)`` of a task's Arrow batches, added up; one row a task."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                column = batch.column(0)
                x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
                part = numbers(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])
    return vectors.select(features).mapInArrow(run, "v array<double>")


def task_sums(vectors: DataFrame, features: str, numbers) -> DataFrame:
    """``pos, s``: the vectors of all tasks, added up by position."""
    sums = _task_vectors(vectors, features, numbers)
    return sums.select(F.posexplode("v").alias("pos", "s")).groupBy("pos").agg(F.sum("s").alias("s"))


def _to_matrix(cov: DataFrame) -> np.ndarray:
    cells = cov.toArrow()  # d * d numbers as columns
    i, j = (cells.column(c).to_numpy() for c in ("i", "j"))
    m = np.zeros((int(i.max()) + 1,) * 2)
    m[i, j] = cells.column("cov").to_numpy()
    return m


def pca_fit(vectors: DataFrame, k: int, features: str = "features"):
    """M4: (mean, components k x d, eigenvalues, ratios).

    Eigenpairs sorted by eigenvalue descending; each component's sign is
    fixed so its largest-magnitude loading is positive.  Ratio = lambda_i /
    sum of all eigenvalues.  Vectors wider than ``MAX_DIM`` go to :func:`pca_fit_wide`.
    """
    mu = column_means(vectors, features)
    if len(mu) > MAX_DIM:
        return pca_fit_wide(vectors, k, features, mean=mu)
    c = _to_matrix(covariance(vectors, features, mu))
    evals, evecs = np.linalg.eigh(c)
    order = np.argsort(evals)[::-1]
    evals, evecs = evals[order], evecs[:, order]
    total = float(evals.sum())
    ratios = evals[:k] / total if total > 0 else np.zeros(k)
    return mu, _signed(evecs[:, :k].T), evals[:k], ratios


def _signed(comps: np.ndarray) -> np.ndarray:
    """Each component with its largest-magnitude loading positive."""
    largest = np.take_along_axis(comps, np.abs(comps).argmax(axis=1)[:, None], axis=1)
    return np.where(largest < 0, -comps, comps)


def pca_fit_wide(vectors: DataFrame, k: int, features: str = "features", seed: int = 1, mean=None, tol: float = RITZ_TOL,
                 max_passes: int = MAX_PASSES):
    """M4 for wide vectors, as :func:`pca_fit`, without a d x d matrix anywhere.

    A randomised range finder: k + ``EXTRA`` seeded random directions are multiplied by the covariance C, made
    orthonormal (QR of a d x (k + EXTRA) matrix), and so on.  Products with C are sums over the rows, so a pass sends the
    directions along and each task returns d x (k + EXTRA) sums.  Each pass gives the eigenvalues of C within
    the directions; passes end when the first k change by no more than ``tol`` of the largest, or after ``max_passes``.
    """
    from locuspark.session import cut_lineage, spread
    mu = column_means(vectors, features) if mean is None else np.asarray(mean, dtype=float)
    data, d = cut_lineage(spread(vectors.select(features))), len(mu)
    tasks, width = partitions(data), min(k + EXTRA, len(mu))
    square, n = sum_vectors(_task_vectors(data, features, lambda x: np.array([((x - mu) ** 2).sum(), len(x)])), tasks, 2)
    total, q = square / (n - 1), np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    values = np.full(width, np.inf)
    for _ in range(max_passes):
        sent = data.sparkSession.sparkContext.broadcast(q)  # d x (k + EXTRA) numbers

        def product(x: np.ndarray, sent=sent) -> np.ndarray:
            c = x - mu
            return (c.T @ (c @ sent.value)).ravel()
        cq = sum_vectors(_task_vectors(data, features, product), tasks, d * width).reshape(d, width) / (n - 1)
        inside = q.T @ cq
        before, (values, turn) = values, np.linalg.eigh((inside + inside.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        comps = (q @ turn[:, :k]).T
        sent.unpersist()
        if np.abs(values[:k] - before[:k]).max(initial=0.0) <= tol * max(values[0], 1e-300):
            break
        q = np.linalg.qr(cq @ turn)[0]
    ratios = values[:k] / total if total > 0 else np.zeros(k)
    return mu, _signed(comps), values[:k], ratios


def components_df(spark, comps, evals, ratios) -> DataFrame:
    rows = [(i + 1, float(evals[i]), float(ratios[i]), [float(x) for x in comps[i]]) for i in range(len(evals))]
    return spark.createDataFrame(rows, "pc int, eigenvalue double, ratio double, loading array<double>")


def _dot(x: Column, v) -> Column:
    lit = F.array(*[F.lit(float(a)) for a in v])
    return F.aggregate(F.zip_with(x, lit, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)


def pca_transform(vectors: DataFrame, mean, comps, features: str = "features", prefix: str = "pc") -> DataFrame:
    """M5: centred projection on each component -> columns pc1..pck."""
    out = center(vectors, mean, features, "_centred")
    for i, v in enumerate(comps):
        out = out.withColumn(f"{prefix}{i + 1}", _dot(F.col("_centred"), v))
    return out.drop("_centred")


def pca_inverse(scores: DataFrame, mean, comps, score_cols, out: str = "reconstruction") -> DataFrame:
    """M6: mean + sum_k z_k * component_k as ARRAY<DOUBLE>."""
    d = len(mean)
    terms = []
    for j in range(d):
        e = F.lit(float(mean[j]))
        for zc, comp in zip(score_cols, comps):
            e = e + F.col(zc) * F.lit(float(comp[j]))
        terms.append(e)
    return scores.withColumn(out, F.array(*terms))


def row_normalize(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Divide a row vector by its sum (zero rows divided by 1)."""
    df = df.withColumn("_rs", F.aggregate(F.col(col), F.lit(0.0), lambda acc, v: acc + v))
    s = F.when(F.col("_rs") == 0, 1.0).otherwise(F.col("_rs"))
    return df.withColumn(out or col, F.transform(F.col(col), lambda v: v / s)).drop("_rs")


# ---------------------------------------------------------------- NMF

SWEEPS, INNER_TOL = 200, 1e-6


def nonneg_rows(cross: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Rows w >= 0 that minimise w gram w' / 2 - cross w' each, by cyclic coordinate descent over all rows at once."""
    w = np.zeros_like(cross)
    for _ in range(SWEEPS):
        moved = 0.0
        for t in range(len(gram)):
            if gram[t, t] <= 0:
                continue
            new = np.maximum(w[:, t] - (w @ gram[:, t] - cross[:, t]) / gram[t, t], 0.0)
            moved = max(moved, float(np.abs(new - w[:, t]).max(initial=0.0)))
            w[:, t] = new
        if moved <= INNER_TOL * max(1.0, float(np.abs(w).max(initial=0.0))):
            break
    return w


def _first_components(summed, k: int, gram: np.ndarray, mean: float) -> np.ndarray:
    """Start of H: of each leading singular pair the sign part that carries more, zeros filled with the mean.

    The right vectors come from the d x d Gram matrix; the sizes of the left vectors' parts from one pass over the rows.
    """
    values, right = np.linalg.eigh(gram)
    right = right[:, np.argsort(values)[::-1][:k]].T
    parts = summed(lambda x: np.concatenate(
        [(np.maximum(s * (x @ right.T), 0.0) ** 2).sum(axis=0) for s in (1, -1)]), 2 * k).reshape(2, -1)
    sizes = np.sqrt(parts) * np.stack([np.linalg.norm(np.maximum(s * right, 0.0), axis=1) for s in (1, -1)])
    sign = np.where(sizes[0] >= sizes[1], 1.0, -1.0)
    h = np.maximum(sign[:, None] * right, 0.0)
    h[0] = np.abs(right[0])
    return np.where(h == 0, mean, h)


def nmf(vectors: DataFrame, k: int, max_iter: int = 1000, tol: float = 1e-4, features: str = "features",
        id_col: str = "vec_id"):
    """M8: X ~ W H with W, H >= 0, least squares, by alternating coordinate descent.

    Given H (k x d, sent along), a row of W depends on its own row of X only, so tasks solve for their rows from H H^T
    and return the sums W^T W, W^T X alone: one pass a round, no state on executors, and a lost task is
    simply run again.  H is then swept on the driver, and goes on a little in the direction of its last change; where
    that raises the error it is taken back.  Rounds end when H's projected gradient, taken before its sweep,
    has fallen to ``tol`` of the first round's, or after ``max_iter``.
    Returns (W as a DataFrame of id and w, H, rounds, relative error).
    """
    from locuspark.session import cut_lineage, spread
    data = cut_lineage(spread(vectors.select(id_col, features), id_col))
    tasks, d = partitions(data), len(data.select(features).first()[0])
    if d > MAX_DIM:
        raise ValueError(f"width {d} too large")
    summed = lambda numbers, width: sum_vectors(_task_vectors(data, features, numbers), tasks, width)
    sums = summed(lambda x: np.concatenate([(x.T @ x).ravel(), x.sum(axis=0), [len(x)]]), d * d + d + 1)
    gram = sums[:d * d].reshape(d, d)
    square = float(np.trace(gram))
    h = _first_components(summed, k, gram, float(sums[d * d:-1].sum() / (sums[-1] * d)))
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    h = unit(h)
    swept, first, before, ahead, most, rounds, error = h, None, np.inf, 0.5, 1.0, 0, 0.0
    for rounds in range(1, max_iter + 1):
        own, hh = h, h @ h.T

        def both(x: np.ndarray, own=own, hh=hh) -> np.ndarray:
            w = nonneg_rows(x @ own.T, hh)
            return np.concatenate([(w.T @ w).ravel(), (w.T @ x).ravel()])
        got = summed(both, k * (k + d))
        ww, wx = got[:k * k].reshape(k, k), got[k * k:].reshape(k, d)
        slope = ww @ h - wx
        slope = float(np.abs(np.where(h > 0, slope, np.minimum(slope, 0.0))).sum())
        error = max(square - 2.0 * float((h * wx).sum()) + float(((ww @ h) * h).sum()), 0.0)
        first = slope if first is None else first
        if slope <= tol * first or rounds == max_iter:
            break
        if error > before:  # went too far: back to the last swept H, and shorter steps
            h, before, most, ahead = swept, np.inf, max(0.95 * ahead, 0.1), ahead / 1.5
            continue
        new, before = unit(nonneg_rows(wx.T, ww).T), error
        h, swept = unit(np.maximum(new + ahead * (new - swept), 0.0)), new
        most = min(1.0, 1.01 * most)
        ahead = min(most, 1.05 * ahead)

    def rows(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            w = nonneg_rows(x @ own.T, hh) if len(x) else np.zeros((0, k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(w), pa.list_(pa.float64()))], ["id", "w"])
    kind = data.schema[id_col].dataType.simpleString()
    w = data.mapInArrow(rows, f"id {kind}, w array<double>").withColumnRenamed("id", id_col)
    return w, own, rounds, float(np.sqrt(error / square)) if square > 0 else 0.0


def ancestry_summary(w: DataFrame, groups: DataFrame, id_col: str, group_col: str, k: int,
                     prefix: str = "ancestry", digits: int = 2) -> DataFrame:
    """M9: row proportions -> per-group mean -> columns ranked by mean over
    groups (each group weighted equally) -> renamed prefix1..k -> rounded."""
    props = row_normalize(w, "w")
    j = props.join(groups.select(id_col, group_col), id_col)
    gm = j.groupBy(group_col).agg(*[F.avg(F.col("w")[i]).alias(f"comp{i + 1}") for i in range(k)])
    order = rank_columns(gm, [f"comp{i + 1}" for i in range(k)])
    return gm.select(group_col, *[F.bround(F.col(c), digits).alias(f"{prefix}{r + 1}") for r, c in enumerate(order)]) \
        .orderBy(group_col)


def rank_columns(df: DataFrame, cols) -> list[str]:
    """Column names ordered by their mean over rows (descending, stable)."""
    r = df.agg(*[F.avg(c).alias(c) for c in cols]).first()   # one row of len(cols) values
    return sorted(cols, key=lambda c: (-(r[c] if r[c] is not None else float("-inf")), cols.index(c)))
