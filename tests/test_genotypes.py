import itertools

import numpy as np
from pyspark.sql import functions as F

from locuspark import session
from locuspark.operators import genotypes as gt


def test_genotype_calls(spark):
    vals = ["0/0", "0|1", "1/1", "1/2", "./.", ".", "0/.", "0", None]
    df = spark.createDataFrame([(v,) for v in vals], "gt string")
    got = [r.call for r in gt.genotype_calls(df).collect()]
    assert got == ["hom", "het", "hom", "het", None, None, None, None, None]


def _score(path, pos, ps, calls):
    emit = gt.emission_scores(np.array(ps), np.array(calls, dtype=object))
    move = gt.transition_scores(np.diff(pos, prepend=pos[0]))
    s = gt.start_scores()[path[0]] + emit[0][path[0]]
    return s + sum(move[i][path[i - 1]][path[i]] + emit[i][path[i]] for i in range(1, len(path)))


def test_model_values():
    """Two sites by hand: 1 Mb apart, a heterozygous and a missing call at p = 0.3."""
    e = gt.emission_scores(np.array([0.3, 0.3]), np.array(["het", None], dtype=object))
    assert np.allclose(np.exp(e), [[0.001, 0.42], [1, 1]])
    t = np.exp(gt.transition_scores(np.array([1e6, 0.0, -5.0])))
    assert np.allclose(t[0], [[np.exp(-1 / 1.5), 1 - np.exp(-1 / 1.5)], [1 - np.exp(-1 / 4), np.exp(-1 / 4)]])
    assert (t[1:] == np.eye(2)).all()
    assert np.allclose(np.exp(gt.start_scores()), [3 / 11, 8 / 11])


def test_viterbi_is_optimal_and_chunking_exact(spark):
    rng = np.random.default_rng(5)
    rows = []
    for smp in range(4):
        pos = np.sort(rng.choice(np.arange(1, 4_000_000, 997), size=9, replace=False))
        for p in pos:
            g = rng.choice(["0/0", "0/1", "1|1", "./."], p=[0.5, 0.2, 0.2, 0.1])
            rows.append((f"s{smp}", "chr1", int(p), f"AF={0.2 + 0.01 * (p % 50):.2f}", str(g)))
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, info string, gt string")
    a = sorted((r.sample, r.pos, r.state) for r in gt.viterbi_states(df).collect())
    b = sorted((r.sample, r.pos, r.state) for r in gt.viterbi_states(df, chunk_bp=500_000).collect())
    assert a == b
    calls = gt.genotype_calls(df)
    freq = {(r.chrom, r.pos): r.p for r in gt.site_frequency(calls).collect()}
    cl = {(r.sample, r.pos): r.call for r in calls.collect()}
    for smp in {r[0] for r in a}:
        sites = [(p, st) for s_, p, st in a if s_ == smp]
        pos = [p for p, _ in sites]
        ps = [freq[("chr1", p)] for p in pos]
        cs = [cl[(smp, p)] for p in pos]
        best = max(_score(path, pos, ps, cs) for path in itertools.product((0, 1), repeat=len(pos)))
        assert abs(_score([st for _, st in sites], pos, ps, cs) - best) < 1e-9


def test_segments(spark):
    df = spark.createDataFrame([("x", "c", 1, 1, 0), ("x", "c", 2, 1, 0), ("x", "c", 3, 2, 1), ("x", "c", 4, 2, 0)],
                               "sample string, chrom string, pos long, chunk long, state int")
    seg = sorted((r.start_position, r.stop_position) for r in gt.state_runs(df).collect())
    assert seg == [(1, 2), (4, 4)]
    df2 = df.withColumn("chunk", F.lit(0).cast("long"))
    assert sorted((r.start_position, r.stop_position) for r in gt.state_runs(df2).collect()) == seg


def test_file_order_across_chromosomes(spark):
    """by=["sample"] decodes in file order, not in position order; two records at one position keep their own AF."""
    rows = [("s", "chr1", 100_000 * i, "AF=0.5", "0/0", i) for i in range(30)]
    rows += [("s", "chr2", 100_000 * i, "AF=0.5", "0/1", 30 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, info string, gt string, site_ord long")
    got = [r.state for r in gt.viterbi_states(df, by=["sample"]).orderBy("ord").collect()]
    assert got[:25] == [0] * 25 and got[35:] == [1] * 25
    small = [r.state for r in gt.viterbi_states(df, by=["sample"], chunk_sites=7, bin_sites=10).orderBy("ord").collect()]
    assert small == got
    seg = gt.inbred_segments(df, by=["sample"]).collect()
    assert len(seg) == 1 and seg[0].start_position == 0
    twice = spark.createDataFrame([("s", "c", 5, "AF=0.1", "0/0", 0), ("s", "c", 5, "AF=0.4", "0/1", 1)], df.schema)
    assert sorted(r.p for r in gt.site_frequency(gt.genotype_calls(twice)).collect()) == [0.1, 0.4]


def test_dense_positions_do_not_share_a_chunk(spark):
    """All but ten sites lie close together; no chunk holds more than its share and one histogram cell."""
    rows = [("s", "c", 50_000_000 + i * 7 if i >= 10 else i * 5_000_000, "AF=0.3", "0/0") for i in range(3000)]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, info string, gt string")
    states = gt.viterbi_states(df, chunk_sites=100)
    sizes = [r["count"] for r in states.groupBy("chunk").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 100 + 1024 // 7 + 1
    one = gt.viterbi_states(df)
    assert {(r.pos, r.state) for r in states.collect()} == {(r.pos, r.state) for r in one.collect()}


def test_input_is_read_once(spark):
    """The rows are computed once, however many steps need them; groups of one chunk and of several in one table."""
    seen = spark.sparkContext.accumulator(0)

    def counted(gt_):
        seen.add(1)
        return gt_
    rows = [(f"s{i % 400}", "c", i // 400 * 9_000, "AF=0.3", ["0/0", "0/1", "./."][i * 7919 % 3]) for i in range(20_000)]
    rows += [(None, "c", 9_000, "AF=0.3", "0/0"), ("s1", None, 5, "AF=0.3", "0/0"), ("s1", "c", None, "AF=0.3", "0/0")]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, info string, gt string")
    df = df.withColumn("gt", F.udf(counted)("gt"))
    states = gt.viterbi_states(df, bin_sites=500)
    assert states.count() == 20_000
    assert seen.value <= len(rows)  # rows whose site is null need not be read
    mixed = gt.viterbi_states(df.where("sample = 's1' OR pos < 90000"), chunk_sites=20)  # one group in chunks, others whole
    plain = gt.viterbi_states(df.where("sample = 's1' OR pos < 90000"))
    key = lambda d: sorted((r.sample, r.pos, r.state) for r in d.collect())
    assert key(mixed) == key(plain)


def test_segments_are_dealt_by_rows(spark, monkeypatch):
    """Runs inside a group of one chunk stay in the tasks that hold its sites; there are more of them than partitions of the session."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 200, raising=False)
    rows = [(f"s{i % 200}", "c", i // 200 * 2_000_000 + (i // 200) ** 2 * 1_000, "AF=0.3", "0/1" if i // 200 % 7 == 3 else "0/0") for i in range(6_000)]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, info string, gt string")
    got = gt.inbred_segments(df).select("*", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in got}) > 10 and {r.individual for r in got} == {f"s{i}" for i in range(200)}
    pieces = gt.state_runs(gt.viterbi_states(df, chunk_bp=6_000_000)).collect()
    key = lambda r: (r.chrom, r.start_position, r.stop_position)
    assert sorted((r.individual, *key(r)) for r in got) == sorted((r.sample, *key(r)) for r in pieces)
