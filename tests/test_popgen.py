import random

import pytest
from pyspark.sql import functions as F

from locuspark.operators import asof, popgen as pg


def test_diversity_golden_row(spark):
    haps = spark.createDataFrame([("p", h, 7, 1) for h in range(5)], "pop string, hap long, site long, allele int")
    r = pg.diversity(haps, ["pop"], 20, 1000).first()
    assert r.segregating_sites == 1
    assert round(r.theta_w, 6) == 0.000282 and round(r.pi, 6) == 0.000395
    r1 = pg.diversity(haps, ["pop"], 1, 1000).first()
    assert (r1.segregating_sites, r1.pi, r1.theta_w) == (0, 0.0, 0.0)


def test_asof_fixture(spark):
    steps = spark.createDataFrame([(0.0, 10000.0), (50.0, 100.0), (100.0, 10000.0)], "t double, value double")
    ts = [0.0, 49.9, 50.0, 99.0, 100.0, 1e6, -1.0]
    pts = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id long, t double")
    got = {r.id: r.value for r in asof.asof_step(pts, steps).collect()}
    assert [got[i] for i in range(len(ts))] == [10000, 10000, 100, 100, 10000, 10000, 10000]
    nx = {r.id: r.next_t for r in asof.next_step(pts, steps, buckets=2).collect()}
    assert (nx[0], nx[2], nx[4]) == (50.0, 100.0, None)
    first = steps.orderBy("t").limit(1).select("value").first().value
    b = {r.id: (r.value if r.value is not None else first)
         for r in asof.asof_join(pts, steps, "t", "t", ["value"], buckets=3).collect()}
    assert [b[i] for i in range(len(ts))] == [10000, 10000, 100, 100, 10000, 10000, 10000]


def test_trees(spark):
    nodes = spark.createDataFrame([(1, 1, None, 10.0), (1, 2, 1, 4.0), (1, 3, 1, 0.0), (1, 4, 2, 0.0), (1, 5, 2, 0.0)],
                                  "tree_id long, node long, parent long, time double")
    m = pg.tree_metrics(nodes).first()
    assert m.total_tree_length == 6 + 10 + 4 + 4 and m.time_to_mrca == 10.0 and m.n_leaves == 3
    d = sorted((r.node, r.leaf) for r in pg.leaf_descendants(nodes).collect())
    assert d == [(1, 3), (1, 4), (1, 5), (2, 4), (2, 5), (3, 3), (4, 4), (5, 5)]


def _leaves_below(nodes):
    """(tree, node) -> its leaves, from the rows (tree, node, parent)."""
    kids = {}
    for t, x, p in nodes:
        kids.setdefault((t, p), []).append(x)
    out = {}
    for t, x, _ in reversed(nodes):  # parents come before their children
        below = kids.get((t, x))
        out[t, x] = set().union(*(out[t, c] for c in below)) if below else {x}
    return out


def test_leaf_ranges_and_haplotypes(spark):
    """Random trees, a star, a forest with several roots and a chain, against sets."""
    draw = random.Random(5)
    nodes = [(1, i, draw.randrange(i) if i else None) for i in range(60)]
    nodes += [(2, i, 0 if i else None) for i in range(150)] + [(3, i, None if i < 4 else draw.randrange(i)) for i in range(40)]
    nodes += [(4, i, i - 1 if i else None) for i in range(30)] + [(5, 7, None)]
    below = _leaves_below(nodes)
    df = spark.createDataFrame(nodes + [(None, 1, None), (1, None, 3)], "tree_id long, node long, parent long")
    got = {(r.tree_id, r.node): r for r in pg.leaf_ranges(df).collect()}
    assert set(got) == set(below)
    place = {(t, x): r.lo for (t, x), r in got.items() if r.leaf}
    for (t, x), leaves in below.items():
        r = got[t, x]
        assert r.leaf == (leaves == {x}) and {place[t, y] for y in leaves} == set(range(r.lo, r.hi))
    pairs = sorted(map(tuple, pg.leaf_descendants(df).select("tree_id", "node", "leaf").collect()))
    assert pairs == sorted((t, x, y) for (t, x), leaves in below.items() for y in leaves)
    muts = [(t, x, draw.randrange(3)) for t, x, _ in draw.choices(nodes, k=60)] * 2 + [(9, 1, 1), (1, 999, 0)]
    haps = pg.mutations_to_haplotypes(spark.createDataFrame(muts, "tree_id long, node long, site long"), pg.leaf_ranges(df))
    want = {(t, y, s) for t, x, s in muts for y in below.get((t, x), ())}
    assert sorted(map(tuple, haps.select("tree_id", "hap", "site").collect())) == sorted(want)


def test_chain_of_10_000_nodes(spark):
    chain = spark.range(10_000).select(F.lit(1).alias("tree_id"), F.col("id").alias("node"),
                                       F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    ranges = pg.leaf_ranges(chain)
    assert ranges.where("lo = 0 AND hi = 1").count() == 10_000 and ranges.where("leaf").first().node == 9_999
    with pytest.raises(ValueError):
        pg.leaf_ranges(spark.createDataFrame([(1, 0, 1), (1, 1, 0)], "tree_id long, node long, parent long"))


def test_weighted_sample_exact(spark):
    items = spark.createDataFrame([(1, 3), (2, 0), (3, 5), (4, 2)], "item long, w long")
    draws = spark.createDataFrame([(i,) for i in range(200)], "draw_id long")
    cum = [(1, 3), (3, 8), (4, 10)]
    for sent, block in ((100, 100), (0, 100), (0, 1)):
        got = pg.weighted_sample(items, draws, seed=7, sent_items=sent, block_items=block).collect()
        assert sorted(r.draw_id for r in got) == list(range(200)) and {r.item for r in got} == {1, 3, 4}
        for r in got:
            assert 1 <= r.u <= 10
            assert r.item == next(i for i, c in cum if c >= r.u)
    zero = items.withColumn("w", F.lit(0).cast("long"))
    assert {r.item for r in pg.weighted_sample(zero, draws).collect()} == {1, 2, 3, 4}
    assert pg.weighted_sample(items.limit(0), draws).count() == 0


def test_weighted_sample_large_weights(spark):
    """Sums beyond 2^53, and an item with nearly all of the weight, which several tasks share."""
    weights = [(i, 2 ** 53 + 1) for i in range(50)] + [(50, 2 ** 60), (51, 1), (52, 3)]
    items = spark.createDataFrame(weights, "item long, w long").repartition(5)
    draws = spark.range(3000).withColumnRenamed("id", "draw_id")
    upto, total = {}, 0
    for i, w in weights:
        total += w
        upto[i] = total
    for sent in (1000, 0):
        got = pg.weighted_sample(items, draws, sent_items=sent, block_items=4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
        try:
            rows = got.withColumn("p", F.spark_partition_id()).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(rows) == 3000
        for r in rows:
            assert r.item == min(i for i, c in upto.items() if c >= r.u)
    assert len({r.p for r in rows if r.item == 50}) > 2


def test_asof_null_keys_and_crowded_keys(spark):
    """A null t gets no value in any plan; nearly all keys in a billionth of the range change nothing."""
    pts = spark.createDataFrame([(i, None if i == 0 else (1e9 if i == 1 else i * 1e-6)) for i in range(500)],
                                "id long, t double")
    steps = spark.createDataFrame([(float(i) * 1e-5, float(i)) for i in range(40)], "t double, value double")
    got = {r.id: r.value for r in asof.asof_step(pts, steps).collect()}
    want = {i: None if i == 0 else (39.0 if i == 1 else max([s for s in range(40) if s * 1e-5 <= i * 1e-6]) * 1.0)
            for i in range(500)}
    assert got == want and {r.id: r.value for r in asof.asof_step(pts, steps, buckets=5).collect()} == want


def test_asof_keeps_large_integers(spark):
    draws = spark.createDataFrame([(1, 2 ** 53 + 4)], "id long, u long")
    cum = spark.createDataFrame([("A", 2 ** 53 + 3), ("B", 2 ** 53 + 10)], "item string, cum long")
    assert asof.asof_join(draws, cum, "u", "cum", ["item"], (), "forward", True).first().item == "B"


def test_running_sum_sparse_keys(spark):
    df = spark.range(3000).select((F.col("id") * F.col("id") * 1000).alias("k"), F.lit(2).alias("v"))
    got = {r.k: r.cum for r in asof.running_sum(df, "k", "v").collect()}
    assert got == {i * i * 1000: 2 * (i + 1) for i in range(3000)}


def _nearest(left, right, backward, inclusive):
    """{id: value} row by row; right keys are unique within a group."""
    out = {}
    for i, g, k in left:
        fit = [(t, v) for h, t, v in right if h == g and t is not None and k is not None
               and (t == k and inclusive or (t < k if backward else t > k))]
        out[i] = (max(fit) if backward else min(fit))[1] if fit else None
    return out


def test_asof_plans_against_plain(spark):
    """Sent table and range exchange, both directions, null groups and keys, ranges that cut groups and repeated keys."""
    import random
    rng = random.Random(6)
    groups = ["a", "b", None, "c"]
    left = [(i, rng.choice(groups + ["only left"]), rng.choice([None, 5, 5, 5, rng.randrange(40)])) for i in range(300)]
    right = [(g, t, f"{g}{t}") for g in groups + ["only right"] for t in rng.sample(range(40), 8)] + [("a", None, "none")]
    lf = spark.createDataFrame(left, "id long, g string, k long").repartition(3)
    rf = spark.createDataFrame(right, "g string, t long, v string").repartition(2)
    for direction in ("backward", "forward"):
        for inclusive in (True, False):
            want = _nearest(left, right, direction == "backward", inclusive)
            for buckets in (None, 1, 7, 60):
                got = asof.asof_join(lf, rf, "k", "t", ["v"], ["g"], direction, inclusive, buckets)
                assert got.columns == ["id", "g", "k", "v"]
                assert {r.id: r.v for r in got.collect()} == want, (direction, inclusive, buckets)
    empty = rf.limit(0)
    for buckets in (None, 4):
        assert {r.v for r in asof.asof_join(lf, empty, "k", "t", ["v"], ["g"], buckets=buckets).collect()} == {None}
        assert asof.asof_join(lf.limit(0), rf, "k", "t", ["v"], ["g"], buckets=buckets).count() == 0


def test_asof_equal_and_null_keys_are_spread(spark):
    """A million equal and a million null keys: no range holds much more than its share."""
    n = 1_000_000
    pts = spark.range(0, 2 * n, 1, 8).select("id", F.when(F.col("id") < n, 7.0).alias("t"))
    steps = spark.createDataFrame([(float(i), i * 10) for i in range(20)], "t double, value long")
    got = asof.asof_join(pts, steps, "t", "t", ["value"], buckets=8).withColumn("p", F.spark_partition_id())
    rows = {(r.value): r["n"] for r in got.groupBy("value").agg(F.count("*").alias("n")).collect()}
    assert rows == {70: n, None: n}
    sizes = [r["n"] for r in got.groupBy("p").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) <= 3 * 2 * n / 16


def test_small_trees_are_numbered_without_rounds(spark, monkeypatch):
    """Trees in bins and large ones by their tours have the same leaves; small ones alone take no round of joins."""
    rows = [(t, 10 * i, None if i == 0 else 10 * ((i - 1) // (t + 1))) for t in range(4) for i in range(3 + 5 * t)]
    rows += [(2, 5000, None), (3, 6000, 7000), (3, 6001, 6000)]  # a second root; nodes under a node that is not there
    df = spark.createDataFrame(rows, "tree_id long, node long, parent long")

    def below(small):
        monkeypatch.setattr(pg, "SMALL_TREE", small, raising=False)
        got = pg.leaf_ranges(df).collect()
        name = {(r.tree_id, r.lo): r.node for r in got if r.leaf}
        assert len(name) == sum(r.leaf for r in got)
        return {(r.tree_id, r.node): {name[r.tree_id, i] for i in range(r.lo, r.hi)} for r in got}

    toured = below(10)
    monkeypatch.setattr(pg, "suffix_sums", None)
    assert below(1 << 14) == toured and len(toured) == len(rows) - 2
