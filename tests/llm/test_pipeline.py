"""The pipeline, stage by stage, against plain versions; its guard in the entry module."""

import os
import subprocess
import sys
from collections import Counter

import brute
import pytest
from conftest import odd_rows

import __spark_entry__ as entry
import corpus_pipeline as cp
from locuspark.llm import queries as q
from locuspark.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / f"{i}")
        stage(spark, docs, SF).write.parquet(path)
        new = spark.read.parquet(path)
        out.append((name, docs.collect(), new.collect(), docs.columns, new.columns))
        docs = new
    return {name: rest for name, *rest in out}


def test_stages_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(steps[n][2] == steps[n][3] for n, _ in cp.STAGES[:-1])


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"][:2]
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~q.held_out())
    index = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    want = set()
    for r in before:
        counts = toxicity.terms_of(toxicity.words((r.text or "").encode()))
        bag = Counter({t: n for t, n in counts.items() if index and t in index.idf})
        if index is None or (index.score(index.nearest(index.vector(bag), toxicity.NEIGHBOURS)) if bag else index.bare) < 0.5:
            want.add(r.doc_id)
    assert {r.doc_id for r in after} == want


def test_one_of_each_near_copy_group_stays(steps):
    before, after = steps["near_dedup"][:2]
    comps = brute.near_copies([(r.doc_id, r.text) for r in before])
    assert Counter(r.doc_id for r in after) == Counter({c for _, _, c in comps})


def test_contaminated_go(spark, steps):
    before, after = steps["decontamination"][:2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination([(r.doc_id, r.text) for r in before], items) if r[-1]}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - bad and len(after) == len(before) - len(bad)


def test_mix(steps):
    before, after = steps["mixing"][:2]
    names = ["web", "reference", "forum", "news"]
    rows = [(r.doc_id, names[int(r.source[3:]) % 4], r.lang, r.source, len(brute.SPACED.findall(r.text or "")),
             brute.row_key(r.doc_id, r.text)) for r in before]
    copies = brute.mixed(rows, q.mix_target(max_epochs=1))
    assert Counter(r.doc_id for r in after) == +Counter({r.doc_id: n for r, n in zip(before, copies)})
    assert max(copies) == 1


def test_shards(steps):
    before, after = steps["sharding"][:2]
    assert Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in before)
    size, slots = Counter(), {}
    for r in after:
        size[r.shard] += len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) <= max(len((r.text or "").encode()) for r in after) + 1


def test_run_matches_the_stages(spark, steps):
    assert Counter(r.doc_id for r in cp.run(spark, SF).collect()) == Counter(r.doc_id for r in steps["sharding"][1])


def test_every_stage_takes_odd_and_empty_tables(spark, odd, none):
    for name, stage in cp.STAGES:
        out = stage(spark, odd, SF)
        assert out.columns[:len(odd.columns)] == odd.columns, name
        assert out.count() <= len(odd_rows())
        assert stage(spark, none, SF).count() == 0
    kept = cp.drop_near_copies(spark, odd, SF)
    comps = brute.near_copies([(i, r[1]) for i, r in enumerate(odd_rows())])
    assert kept.count() == len({c for _, _, c in comps})


def test_entry_works_without_the_subpackage(tmp_path):
    """The rest of the library imports and lists its queries when llm/ and the pipeline are gone."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = ("import sys; sys.modules['locuspark.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)\n"
            "assert not any(k.startswith('op1_') for k in q)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_registered_once_each():
    names = entry.queries()
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_oracles(spark, name):
    import duckdb

    from tools.check_oracle import TABLES, rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = q.QUERIES[name](spark, SF)
    cur = con.execute(q.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())
