"""Exact dedup, SimHash, substring dedup and components against plain versions."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from locuspark.llm.components import connected_components
from locuspark.llm.exact_dedup import exact_dedup
from locuspark.llm.simhash import fingerprint, simhash_near_dedup
from locuspark.llm.substring_dedup import RollingHash, _pack, _positions, intervals_of, substring_dedup

PAIRS = [(r[0], r[1]) for r in odd_rows()]


def tuples(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("keep,fan_in", [("max", 2), ("min", 16)])
def test_exact_dedup_odd(odd, keep, fan_in):
    got = exact_dedup(odd, keep=keep, fan_in=fan_in)
    groups = defaultdict(list)
    for d, t in PAIRS:
        groups[brute.low(t)].append(d)
    pick = max if keep == "max" else min
    want = Counter()
    for d, t in PAIRS:
        own = groups[brute.low(t)]
        want[(d, pick([x for x in own if x is not None], default=None), len(own), brute.sha(brute.low(t)))] += 1
    assert tuples(got, "doc_id", "keep_id", "group_size", "text_sha256") == want
    kept = Counter(r.text_sha256 for r in got.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert got.where("kept and not doc_id <=> keep_id").count() == 0


def test_exact_dedup_many_runs(spark):
    """More runs than one round merges; a third of the rows share one text."""
    df = spark.range(0, 3000, 1, 37).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("text"))
    got = exact_dedup(df, keep="max", fan_in=2)
    want = df.groupBy(F.lower("text").alias("t")).agg(F.max("doc_id").alias("m"), F.count("*").alias("n"))
    assert tuples(got.where("kept"), "doc_id", "group_size") == tuples(want, "m", "n")
    assert got.count() == 3000


def test_exact_dedup_partitions_of_many_batches(spark):
    """Runs of more rows than an Arrow batch has; groups lie across batches and runs."""
    df = spark.range(0, 50_000, 1, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 12_000).cast("string")).alias("text"))
    got = exact_dedup(df, keep="max")
    want = df.groupBy("text").agg(F.max("doc_id").alias("m"), F.count("*").alias("n"))
    assert tuples(got.where("kept"), "doc_id", "group_size") == tuples(want, "m", "n")
    assert got.count() == 50_000


def test_empty_tables(none):
    assert exact_dedup(none).count() == 0
    assert simhash_near_dedup(none).count() == 0
    assert substring_dedup(none).count() == 0


@pytest.mark.parametrize("hot", [256, 1])
def test_simhash_odd(odd, hot):
    got = simhash_near_dedup(odd, hot=hot)
    assert tuples(got, "doc_id", "fingerprint", "component_id") == Counter(brute.near_copies(PAIRS))
    comps = {c for _, _, c in brute.near_copies([(i, t) for i, (_, t) in enumerate(PAIRS)])}
    assert got.where("keep").count() == len(comps)


def test_simhash_links_at_one_and_two_bits(spark):
    """Random prints with planted neighbours: pairs and hubs give the same components as brute force."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for p in base[:25]:
        for k in (1, 2, 3):
            q = p
            for b in rng.sample(range(64), k):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    from locuspark.llm.simhash import _links
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bits in (1, 2):
        edges = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits]
        want = brute.labels_of(edges, len(prints))
        for segment, hot in ((2, 256), (4, 256), (8, 1), (2, 1)):
            got = {(r.u, r.v) for r in _links(df, bits, segment, hot).collect()}
            at = {p: i for i, p in enumerate(signed)}
            label = brute.labels_of([(at[u], at[v]) for u, v in got], len(prints))
            assert (label == want).all(), (bits, segment, hot)


def test_fingerprint_matches_brute_force():
    for text in ("", "a", "A b", "a b c", "the quick Brown fox jumps", "é à ü " * 50):
        assert fingerprint(text.encode()) & ((1 << 64) - 1) == brute.fingerprint(text)


def test_substring_odd(odd):
    got = substring_dedup(odd)
    assert tuples(got, "doc_id", "n_words", "n_removed", "kept_text") == Counter(brute.without_repeats(PAIRS))


def test_substring_small_batches(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(12)]
    share = [rng.choice(vocabulary) for _ in range(300)]
    docs = []
    for i in range(60):
        a = rng.randrange(250)
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        docs.append((i, " ".join(own + share[a:a + rng.randrange(60)] + own[:10])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for width, batch in ((3, 50), (35, 1), (5, 1_000_000)):
        got = substring_dedup(df, width=width, batch_words=batch)
        assert tuples(got, "doc_id", "n_words", "n_removed", "kept_text") == Counter(brute.without_repeats(docs, width))


def test_positions_round_trip_with_wide_steps():
    n = 400_000
    first, second = np.arange(n, dtype=np.uint64), np.zeros(n, np.uint64)
    second[[0, 65_535, 65_536, 200_000, 399_999]] = np.uint64(1) << np.uint64(63)
    packed, decided = _pack("b", first, second, 1)
    assert len(decided) == 0
    for row in range(len(packed)):
        at = _positions(packed.column("steps")[row].as_py())
        assert (np.frombuffer(packed.column("hashes")[row].as_py(), np.uint64) == at).all()


def test_repeats_within_a_batch_are_sent_once():
    """Equal windows of one batch: all positions decided there, one hash sent on; equal stored bits in two buckets are no repeat."""
    first = np.array([7, 5, 7, 9, 7, 5, 8, 9], np.uint64)
    second = np.array([0, 0, 0, 0, 0, 0, 0, 1 << 63], np.uint64)
    packed, decided = _pack("b", first, second, 1)
    assert decided.tolist() == [0, 1, 2, 4, 5]
    got = {b: [np.frombuffer(x, np.uint64).tolist() for x in (h, s)] + [_positions(c).tolist()] for b, h, s, c in zip(
        *(packed.column(n).to_pylist() for n in ("bucket", "hashes", "seen", "steps")))}
    assert got == {0: [[9, 8], [5, 7], [3, 6]], 1: [[9], [], [7]]}
    rng = np.random.default_rng(2)
    first, second = rng.integers(0, 40, 5000).astype(np.uint64), rng.integers(0, 8, 5000).astype(np.uint64) << np.uint64(61)
    packed, decided = _pack("b", first, second, 3)
    count = Counter(zip(first.tolist(), second.tolist()))
    assert decided.tolist() == [i for i, w in enumerate(zip(first.tolist(), second.tolist())) if count[w] > 1]
    assert sum(len(x) for c in ("hashes", "seen") for x in packed.column(c).to_pylist()) == 8 * len(count)


def test_batches_do_not_depend_on_the_order_of_rows(spark):
    """What a task packs is the same when its rows come in another order, as they may when it is run again."""
    from locuspark.llm.common import row_key
    from locuspark.llm.substring_dedup import PACK_SCHEMA, _scan
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(20 + i % 9))) for i in range(60)]

    def packed(some):
        df = spark.createDataFrame(some, "doc_id long, text string").coalesce(1)
        slim = df.select(F.spark_partition_id().alias("part"), row_key(F.col("doc_id"), F.col("text")).alias("k"), "text")
        return sorted(map(tuple, slim.sortWithinPartitions("k").mapInArrow(_scan(5, 3, 200), PACK_SCHEMA).collect()))
    assert packed(rows) == packed(rows[::-1])


def test_rolling_hash_equal_iff_equal_windows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 5000)
    hashes = np.array([11, 0xFFFFFFFFFFFFFFFF, 1 << 63], np.uint64)[words]
    a, b = RollingHash(6)(hashes)
    by = {}
    for i in range(len(a)):
        by.setdefault(tuple(words[i:i + 6]), set()).add((int(a[i]), int(b[i])))
    assert all(len(x) == 1 for x in by.values()) and len(set().union(*by.values())) == len(by)


def test_intervals():
    assert intervals_of(np.array([0, 2, 5, 9, 30]), 4) == [(0, 13), (30, 34)]


def test_components_random(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = brute.labels_of(edges, 500)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: int(want[x]) for x in touched}


def test_exact_dedup_smallest_and_largest_ids(spark):
    """The ends of the 64-bit range, kept by either rule."""
    from locuspark.llm.exact_dedup import exact_dedup
    low, high = -(2 ** 63), 2 ** 63 - 1
    docs = spark.createDataFrame([(low, "A"), (high, "a"), (0, "a"), (low, "b"), (None, "b"), (None, "c")], "doc_id long, text string")
    for keep, a in (("min", low), ("max", high)):
        got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs, keep=keep).collect()}
        assert sorted(v[0] is None for v in got.values()) == [False] * 5 + [True]
        assert {v[0] for v in got.values()} == {a, low, None} and sum(v[2] for v in got.values()) == 3
