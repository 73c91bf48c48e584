import numpy as np
from pyspark.sql import functions as F

from locuspark.operators import clustering as cl, decomposition as dc, merge_tree as mt, prediction as pr
from locuspark.plans import fixtures as fx


def test_clustering_error_fixture(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "b"), (1, "b"), (2, "a"), (2, "c")],
                               "cluster int, label string")
    assert cl.clustering_error(df).first().error == 2


def test_kmeans_runs_and_labels_valid(spark):
    v = fx.vectors(spark, "/root/testdata/sf0.001")
    labels, cents, it = cl.kmeans(v, 4, max_iters=20, seed=1)
    assert cents.shape == (4, 64) and 1 <= it <= 20
    assert {r.cluster for r in labels.select("cluster").distinct().collect()} <= set(range(4))


def test_pca_properties(spark):
    v = fx.vectors(spark, "/root/testdata/sf0.001")
    mu, comps, ev, ratio = dc.pca_fit(v, 3)
    assert np.allclose(comps @ comps.T, np.eye(3), atol=1e-9)
    assert ev[0] >= ev[1] >= ev[2] and 0 < ratio.sum() <= 1 + 1e-12
    s = dc.pca_transform(v, mu, comps).select("pc1", "pc2").toPandas()
    assert abs(s["pc1"].mean()) < 1e-9 and abs(np.corrcoef(s["pc1"], s["pc2"])[0, 1]) < 1e-6


def test_nmf_nonnegative(spark):
    v = fx.vectors(spark, "/root/testdata/sf0.001").withColumn("features", F.transform("features", F.abs))
    w, h, it, rel = dc.nmf(v, 3, max_iter=15)
    assert (h >= 0).all() and 0 <= rel < 1
    assert w.where(F.exists("w", lambda x: x < 0)).count() == 0


def test_nonneg_rows_against_all_supports():
    """Each row against the least squares of every support."""
    from itertools import combinations
    rng = np.random.default_rng(1)
    h, x = rng.random((3, 6)), rng.normal(0.3, 1, (40, 6))
    got = dc.nonneg_rows(x @ h.T, h @ h.T)
    for row, w in zip(x, got):
        best = float(row @ row)
        for n in (1, 2, 3):
            for pick in combinations(range(3), n):
                sol = np.linalg.lstsq(h[list(pick)].T, row, rcond=None)[0]
                if (sol >= 0).all():
                    best = min(best, float(((row - sol @ h[list(pick)]) ** 2).sum()))
        assert (w >= 0).all() and abs(((row - w @ h) ** 2).sum() - best) < 1e-6


def test_nmf_finds_exact_factors(spark):
    """Rows that are mixtures of two known parts: the error goes to nothing, and so does a zero matrix's."""
    rng = np.random.default_rng(5)
    x = rng.random((60, 2)) @ np.array([[1, 2, 0, 0, 1.0], [0, 0, 3, 1, 1.0]])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, features array<double>").repartition(4)
    w, h, rounds, rel = dc.nmf(df, 2, max_iter=40, tol=1e-6)
    assert rel < 0.05 and rounds <= 40
    got = np.array([r.w for r in w.orderBy("vec_id").collect()]) @ h
    assert np.abs(got - x).max() < 0.3
    zero = df.withColumn("features", F.transform("features", lambda v: F.lit(0.0)))
    assert dc.nmf(zero, 2)[3] == 0.0


def test_sgd_step_against_plain():
    """One mini-batch step against the derivative taken number by number."""
    rng = np.random.default_rng(2)
    x, y, weight, w, alpha = rng.normal(size=(7, 3)), rng.integers(0, 2, 7).astype(float), rng.random(7) + 0.5, rng.normal(size=4), 0.01

    def loss(c):
        z = x @ c[:-1] + c[-1]
        return float(((np.logaddexp(0, z) - y * z) * weight).mean() + alpha / 2 * (c[:-1] ** 2).sum())
    slope = np.array([(loss(w + e) - loss(w - e)) / 2e-6 for e in np.eye(4) * 1e-6])
    first = 1 / (1 + alpha ** 0.5)
    for step in (0, 10):
        rate = 1 / (1 / first + alpha * step)
        assert np.allclose(pr.sgd_step(w, x, y, weight, alpha, step), w - rate * slope, atol=1e-6)


def test_sgd_model(spark):
    """Separable classes of unequal size: near the L-BFGS model, early stop, and the same result when run again."""
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), "u" if i % 2 else "v", int(a + 0.5 * b + 0.3 * n > 0.8))
            for i, (a, b, n) in enumerate(rng.normal(size=(1500, 3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, y int").repartition(4)
    model = pr.fit_sgd(df, ["a", "b"], ["c"], "y", 2, 1e-3, "id")
    assert 5 <= model.rounds < 200 and min(h[0] for h in model.history[1:]) < 0.5 * model.history[0][0]
    other, factors, _ = pr.fit_logistic(df.drop("id"), ["a", "b"], ["c"], "y", 2, 1e-3)
    auc = [pr.roc_auc(x, "score", "y").first().auc for x in (pr.predict_sgd(model, df), pr.predict_proba(other, factors, df))]
    assert abs(auc[0] - auc[1]) < 0.01 and auc[0] > 0.95


def test_cut_tree_keeps_ties_together(spark):
    """Two merges of equal height: asking for 3 of 4 leaves gives 2 clusters."""
    merges = spark.createDataFrame([(0, 0, 1, 1.0), (1, 2, 3, 1.0), (2, 4, 5, 2.0)],
                                   "step long, left long, right long, height double")
    cut = lambda k: sorted((r.leaf, r.cluster) for r in mt.cut_tree(merges, 4, k).collect())
    assert cut(3) == cut(2) == [(0, 1), (1, 1), (2, 2), (3, 2)]
    assert cut(4) == [(0, 1), (1, 2), (2, 3), (3, 4)] and cut(1) == [(i, 1) for i in range(4)]
    assert {r.node: r["size"] for r in mt.subtree_sizes(merges, 4).collect()} == {4: 2, 5: 2, 6: 4}
    assert {r.node: r["size"] for r in mt.truncate_tree(merges, 4, 3).collect()} == {4: 2, 2: 1, 3: 1}


def test_deep_tree(spark):
    n = 700  # a chain: step i joins leaf i + 1 to all before
    rows = [(i, 0 if i == 0 else n + i - 1, i + 1, float(i)) for i in range(n - 1)]
    merges = spark.createDataFrame(rows, "step long, left long, right long, height double")
    assert {r.node: r["size"] for r in mt.subtree_sizes(merges, n).collect()} == {n + i: i + 2 for i in range(n - 1)}
    assert {r.cluster for r in mt.cut_tree(merges, n, 5).collect()} == set(range(1, 6))


def test_nearest_ties_and_empty_cluster(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(6)], "vec_id long, features array<double>")
    got = {r.vec_id: r.cluster for r in cl.assign_nearest(df, [[0.5, 0], [0.5, 0]]).collect()}
    assert set(got.values()) == {0}
    labels, cents, rounds = cl.kmeans(df, 3, max_iters=5, seed=3)  # two distinct points, three clusters
    assert labels.count() == 6 and cents.shape == (3, 2) and rounds <= 5


def test_column_roles_and_ids(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "Id long, a double, race string, y int")
    assert pr.column_roles(df, "y") == {"Id": "id", "a": "numeric", "race": "categorical", "y": "target"}
    numeric = spark.createDataFrame([(1, 2.0, 3)], "race long, a double, y int")
    assert pr.column_roles(numeric, "y") == {"race": "categorical", "a": "numeric", "y": "target"}
    assert pr.ensure_id(df)[1] == "Id"
    rows, name = pr.ensure_id(spark.range(0, 1000, 1, 7).select((F.col("id") * 2).alias("v")))
    assert {r.v: r[name] for r in rows.collect()} == {2 * i: i for i in range(1000)}


def test_anova_constant_and_large_means(spark):
    rows = [(7.0, 1e9 + v, float(y), y) for v, y in ((0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1))]
    df = spark.createDataFrame(rows, "c double, big double, same double, y int")
    f = {r.feature: r.f_value for r in pr.anova_f(df, ["c", "big", "same"], "y").collect()}
    small = pr.anova_f(df.withColumn("big", F.col("big") - 1e9), ["big"], "y").first().f_value
    assert f["c"] is None and f["same"] is None and abs(f["big"] - small) < 1e-4
    assert pr.select_k_best(df, ["c", "big", "same"], "y", 2)[0] == "big"


def test_auc_with_crowded_scores(spark):
    """Nearly all scores lie in a thousandth of the range; buckets follow the scores."""
    df = spark.range(4000).select(F.when(F.col("id") == 0, 1e6).otherwise(F.col("id") / 1e6).alias("s"),
                                  (F.col("id") % 2).cast("int").alias("y"))
    p = df.toPandas()
    r = p["s"].rank()
    pos = p["y"] == 1
    want = (r[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert abs(pr.roc_auc(df, "s", "y").first().auc - want) < 1e-9


def test_stratified_split_exact(spark):
    df = spark.range(0, 997).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    s = pr.stratified_split(df, "y", "doc_id", 0.2, 42)
    c = {r.y: r.n for r in s.where("is_val").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert c == {1: round(333 * 0.2), 0: round(664 * 0.2)} and s.count() == 997


def test_auc_and_anova(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)], "s double, y int")
    assert abs(pr.roc_auc(df, "s", "y").first().auc - (1 + 0.5 + 2 + 2) / 6 * 0 - 4.5 / 6) < 1e-12
    f = pr.anova_f(df, ["s"], "y").first().f_value
    a, b = np.array([0.1, 0.4]), np.array([0.35, 0.8, 0.4])
    allx = np.r_[a, b]
    ssb = len(a) * (a.mean() - allx.mean()) ** 2 + len(b) * (b.mean() - allx.mean()) ** 2
    ssw = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
    assert abs(f - (ssb / 1) / (ssw / 3)) < 1e-9


def test_random_trees(spark):
    """Sizes of every node against counting, for trees of any shape and the smallest ones."""
    import random
    rng = random.Random(8)
    for n in (2, 3, 50):
        alive, rows, leaves = list(range(n)), [], {i: 1 for i in range(n)}
        for step in range(n - 1):
            a, b = (alive.pop(rng.randrange(len(alive))) for _ in range(2))
            rows.append((step, a, b, float(step)))
            alive.append(n + step)
            leaves[n + step] = leaves[a] + leaves[b]
        merges = spark.createDataFrame(rows, "step long, left long, right long, height double")
        got = {r.node: r["size"] for r in mt.subtree_sizes(merges, n).collect()}
        assert got == {k: v for k, v in leaves.items() if k >= n}


def test_pca_of_10_000_wide_vectors(spark):
    """Three strong directions in noise, against the SVD; pca_fit takes this way by itself beyond MAX_DIM."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 3)) * [9.0, 6.0, 4.0] @ rng.standard_normal((3, 10_000)) / 100 + 0.01 * rng.standard_normal((200, 10_000)) + 2.0
    df = spark.createDataFrame([(i, [float(a) for a in row]) for i, row in enumerate(x)], "vec_id long, features array<double>")
    mu, comps, evals, ratios = dc.pca_fit(df, 3)
    c = x - x.mean(axis=0)
    _, size, right = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(mu, x.mean(axis=0)) and np.allclose(evals, size[:3] ** 2 / 199, rtol=1e-8)
    assert np.allclose(np.abs((comps * right[:3]).sum(axis=1)), 1.0, atol=1e-7)
    assert np.allclose(ratios, size[:3] ** 2 / (size ** 2).sum(), rtol=1e-8)
    narrow = spark.createDataFrame([(i, [float(a) for a in row[:12]]) for i, row in enumerate(x)], "vec_id long, features array<double>")
    one, two = dc.pca_fit(narrow, 2), dc.pca_fit_wide(narrow, 2)
    assert all(np.allclose(a, b, atol=1e-7) for a, b in zip(one, two))
