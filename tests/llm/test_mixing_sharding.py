import itertools
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from locuspark.llm.mixing import Mix, mix_documents, mix_plan
from locuspark.llm.sharding import min_cost_flow, plan_reshard, reshard, with_slots

def domain():
    return F.substring("source", 1, 3)


def rows_of(raw):
    return [(d, (s or "")[:3], g or "", s or "", len(brute.SPACED.findall(t or "")), brute.row_key(d, t))
            for d, t, g, s in raw]


@pytest.mark.parametrize("mix", [Mix({}, {}, {}), Mix({"src": 3}, {"en": 7, "fr": 2}, {"src0": 2}, 900, 1),
                                 Mix({"now": 50}, {}, {}, 1000, 3, 7)])
def test_mix_odd(odd, mix):
    want = Counter()
    rows = rows_of(odd_rows())
    for r, n in zip(rows, brute.mixed(rows, mix)):
        want[(*r[:5], n)] += 1
    got = mix_plan(odd, domain(), mix, block_rows=2)
    assert Counter(tuple(r) for r in got.select("doc_id", "domain", "lang", "source", "n_tokens", "copies").collect()) == want
    out = mix_documents(odd, domain(), mix)
    assert out.columns == odd.columns
    many = Counter()
    for (d, t, g, s), n in zip(odd_rows(), brute.mixed(rows, mix)):
        many[(d, t)] += n
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +many


def test_mix_shortage_stays_with_siblings(spark):
    """A source short of tokens passes its share to its siblings before another language gets any."""
    docs = [(i, "a b c d e f g h i j", "en", "s1" if i < 2 else "s2") for i in range(50)] + [
        (100 + i, "a b c d e f g h i j", "fr", "s3") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = mix_plan(df, F.lit("d"), Mix({}, {}, {}, 500, 1))
    used = {r.source: r.n for r in got.where("copies > 0").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert used == {"s1": 20, "s2": 230, "s3": 250}


def test_mix_empty(none):
    assert mix_plan(none, domain(), Mix({}, {}, {})).count() == 0
    assert mix_documents(none, domain(), Mix({}, {}, {})).count() == 0


def test_flow_is_cheapest():
    rng = random.Random(1)
    for _ in range(30):
        supply = [rng.randrange(4) for _ in range(3)]
        capacity = [rng.randrange(1, 4) for _ in range(3)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        cost = np.array([[rng.randrange(5) for _ in range(3)] for _ in range(3)], float)
        flow = min_cost_flow(supply, capacity, cost)
        assert (flow >= 0).all() and flow.sum(1).tolist() == supply and (flow.sum(0) <= capacity).all()
        units = [i for i, n in enumerate(supply) for _ in range(n)]
        best = min((sum(cost[i, j] for i, j in zip(units, to)) for to in itertools.product(range(3), repeat=len(units))
                    if all(to.count(j) <= capacity[j] for j in range(3))), default=0)
        assert (flow * cost).sum() == best
    with pytest.raises(ValueError):
        min_cost_flow([3], [1, 1], np.zeros((1, 2)))


@pytest.mark.parametrize("n_new", [1, 3, 16])
def test_reshard_odd(odd, n_new):
    old = F.pmod(F.col("doc_id"), F.lit(4)).cast("int")
    out = reshard(odd, old, n_new, block_rows=2)
    assert out.columns[:-1] == odd.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r[0], r[1]) for r in odd_rows())
    name = out.columns[-1]
    assert {r[0] for r in out.select(name).collect()} <= set(range(n_new))
    slots = defaultdict(list)
    for r in with_slots(out, name, out="slot_no", block_rows=2).collect():
        slots[r[name]].append(r.slot_no)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_reshard_balances_and_moves_little(spark):
    rng = random.Random(2)
    docs = [(i, "x" * rng.randrange(0, 300), 0 if rng.random() < 0.4 else rng.randrange(1, 6)) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, old int").repartition(6)
    plan = plan_reshard(df, F.col("old"), 5, block_rows=50)
    size, by_old = Counter(), Counter()
    total = sum(len(t) + 1 for _, t, _ in docs)
    for _, t, o in docs:
        by_old[o] += len(t) + 1
    assert plan.moved_bytes == sum(max(0, by_old[o] - (total // 5 + (o < total % 5) if o < 5 else 0)) for o in by_old)
    moved = 0
    for r in reshard(df, F.col("old"), 5, block_rows=50).collect():
        size[r.shard] += len(r.text) + 1
        moved += (len(r.text) + 1) * (r.shard != r.old)
    assert max(size.values()) - min(size.values()) <= 300
    assert abs(moved - plan.moved_bytes) <= 5 * 300


def test_unaffected_shards_are_not_rewritten(spark, tmp_path):
    docs = [(i, "x" * 99, i % 4) for i in range(400)] + [(1000, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, old int")
    plan = plan_reshard(df, F.col("old"), 4)
    assert plan.moved_bytes == 1 and len(plan.affected) == 1  # where the row without a shard goes
    out = reshard(df, F.col("old"), 4, path=str(tmp_path / "s"))
    assert out.where("old is not null and shard != old").count() == 0 and out.count() == 401
    assert len(list((tmp_path / "s").glob("shard=*"))) == 1


def test_reshard_empty(none):
    out = reshard(none, F.lit(0), 4)
    assert out.count() == 0 and with_slots(out, out.columns[-1], out="slot_no").count() == 0


def test_query_columns(spark):
    from conftest import SCHEMA  # noqa: F401
    from locuspark.llm.queries import QUERIES
    rows = QUERIES["op7_resharding"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= max(r.size for r in rows)


def test_weight_zero_is_no_capacity(spark):
    """A source of weight 0 does not hold its siblings' share: the shortage goes to the other language."""
    from locuspark.llm.mixing import Mix, leaf_budgets
    leaves = spark.createDataFrame([("d", "a", "x", 1, 100), ("d", "a", "y", 1, 10), ("d", "b", "z", 1, 200)],
                                   "domain string, lang string, source string, docs long, tokens long")
    got = {r.source: r.budget for r in leaf_budgets(leaves, Mix({}, {}, {"x": 0}, permille=500, max_epochs=1)).collect()}
    assert {k: v for k, v in got.items() if v} == {"y": 10, "z": 145}
