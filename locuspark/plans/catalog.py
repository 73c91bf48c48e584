"""Named queries over the driver tables, each paired with DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` must
produce the same columns (names and values).  Doubles are rounded to 6
places on both sides; all queries read whole tables.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.functions.rng import hash60_sql
from locuspark.plans import fixtures as fx
from locuspark.session import saved

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

N_PERM = 1000  # permutations of the tests
N_LISTED = 20  # permutations whose intervals `permuted_intervals` lists
SEED = 42


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ====================================================================== intervals
from locuspark.functions.draws import draw_sql  # noqa: E402
from locuspark.operators import intervals as iv  # noqa: E402
from locuspark.operators import permutation as pm  # noqa: E402

A_CTE = f"A AS ({fx.INTERVALS_A_SQL})"
B_CTE = f"B AS ({fx.INTERVALS_B_SQL})"
SZ_CTE = f"SZ AS ({fx.CHROM_SIZES_SQL})"


@query("interval_stats", f"""
WITH {A_CTE}
SELECT count(*) AS regions, CAST(coalesce(sum("end" - start), 0) AS BIGINT) AS total_bases FROM A""")
def q_interval_stats(spark, d):
    return iv.interval_stats(fx.intervals_a(spark, d))


@query("interval_overlap_pairs", f"""
WITH {A_CTE}, {B_CTE}
SELECT a.region_id AS a_id, b.region_id AS b_id, a.chrom,
       CAST(least(a."end", b."end") - greatest(a.start, b.start) AS BIGINT) AS overlap_bp
FROM A a JOIN B b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" """)
def q_pairs(spark, d):
    return iv.interval_overlap_pairs(fx.intervals_a(spark, d), fx.intervals_b(spark, d))


@query("overlap_per_region", f"""
WITH {A_CTE}, {B_CTE}
SELECT b.region_id,
       CAST(coalesce(sum(CASE WHEN a.region_id IS NOT NULL
                              THEN least(a."end", b."end") - greatest(a.start, b.start) END), 0) AS BIGINT) AS overlap
FROM B b LEFT JOIN A a ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end"
GROUP BY b.region_id""")
def q_overlap_per_region(spark, d):
    return iv.coverage_per_region(fx.intervals_a(spark, d), fx.intervals_b(spark, d))


@query("overlap_total", f"""
WITH {A_CTE}, {B_CTE}
SELECT CAST(coalesce(sum(least(a."end", b."end") - greatest(a.start, b.start)), 0) AS BIGINT) AS overlap_total
FROM A a JOIN B b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" """)
def q_overlap_total(spark, d):
    return iv.overlap_total(fx.intervals_a(spark, d), fx.intervals_b(spark, d))


_H = draw_sql(SEED, "p.perm", "a.region_id")


def _pa_cte(n: int) -> str:
    """Set A as it is (perm 0) and in n permutations."""
    return f"""PA AS (
  SELECT 0 AS perm, region_id, chrom, start, "end" FROM A
  UNION ALL
  SELECT perm, region_id, chrom, CASE WHEN len >= clen THEN 0 ELSE h % (clen - len + 1) END AS start,
         CASE WHEN len >= clen THEN clen ELSE h % (clen - len + 1) + len END AS "end"
  FROM (SELECT p.perm, a.region_id, a.chrom, a."end" - a.start AS len, s.length AS clen, {_H} AS h
        FROM A a JOIN SZ s ON a.chrom = s.chrom AND s.length > 0
        CROSS JOIN (SELECT unnest(range(1, {n} + 1)) AS perm) p))"""


# overlap of every region in every permutation where it is not 0, joined by bins of 1 kb
OV_CTE = f"""{A_CTE}, {B_CTE}, {SZ_CTE}, {_pa_cte(N_PERM)},
BB AS (SELECT *, unnest(range(start // 1024, ("end" - 1) // 1024 + 1)) AS bin FROM B),
PB AS (SELECT perm, chrom, start, "end", unnest(range(start // 1024, ("end" - 1) // 1024 + 1)) AS bin FROM PA),
OV AS (SELECT p.perm, b.region_id, sum(least(p."end", b."end") - greatest(p.start, b.start)) AS overlap
       FROM PB p JOIN BB b ON p.chrom = b.chrom AND p.bin = b.bin
       WHERE p.start < b."end" AND b.start < p."end" AND greatest(p.start, b.start) // 1024 = p.bin GROUP BY ALL),
T AS (SELECT perm, sum(overlap) AS total FROM OV GROUP BY perm),
G AS (SELECT coalesce((SELECT total FROM T WHERE perm = 0), 0) AS obs,
             CASE WHEN coalesce((SELECT total FROM T WHERE perm = 0), 0) <= 0 THEN {N_PERM} ELSE
             (SELECT count(*) FROM T WHERE perm > 0 AND total >= (SELECT total FROM T WHERE perm = 0)) END AS exceed_count),
C AS (SELECT b.region_id, b.chrom, b.start, b."end", coalesce(o.overlap, 0) AS obs,
             CASE WHEN o.overlap IS NULL THEN {N_PERM} ELSE coalesce(e.n, 0) END AS exceed_count
      FROM B b LEFT JOIN (SELECT * FROM OV WHERE perm = 0) o USING (region_id)
      LEFT JOIN (SELECT v.region_id, count(*) AS n FROM OV v JOIN (SELECT * FROM OV WHERE perm = 0) w USING (region_id)
                 WHERE v.perm > 0 AND v.overlap >= w.overlap GROUP BY v.region_id) e USING (region_id)),
N AS (SELECT count(*) AS n_b, coalesce(sum("end" - start), 0) AS bases FROM B)"""


@query("permuted_intervals", f"""
WITH {A_CTE}, {SZ_CTE}, {_pa_cte(N_LISTED)}
SELECT perm, region_id, chrom, start, "end" FROM PA WHERE perm > 0""")
def q_permuted(spark, d):
    return iv.permute_intervals(fx.intervals_a(spark, d), fx.chrom_sizes(spark, d), N_LISTED, SEED,
                                include_observed=False)


@query("permutation_global", f"""
WITH {OV_CTE}
SELECT CAST(obs AS BIGINT) AS observed_overlap, CAST(exceed_count AS BIGINT) AS exceed_count,
       CAST({N_PERM} AS BIGINT) AS num_permutations, round((exceed_count + 1.0) / {N_PERM + 1}.0, 6) AS global_p_value
FROM G""")
def q_perm_global(spark, d):
    r = pm.permutation_global(fx.intervals_a(spark, d), fx.intervals_b(spark, d), fx.chrom_sizes(spark, d), N_PERM, SEED)
    return r.withColumn("global_p_value", F.round("global_p_value", 6))


@query("permutation_per_region", f"""
WITH {OV_CTE}
SELECT region_id, chrom, start, "end", CAST(obs AS BIGINT) AS observed_overlap, CAST(exceed_count AS BIGINT) AS exceed_count,
       round((exceed_count + 1.0) / {N_PERM + 1}.0, 6) AS p_value,
       (exceed_count + 1.0) / {N_PERM + 1}.0 < 0.05 / greatest(n_b, 1) AS significant_bonferroni
FROM C, N""")
def q_perm_region(spark, d):
    r = pm.permutation_per_region(fx.intervals_a(spark, d), fx.intervals_b(spark, d), fx.chrom_sizes(spark, d), N_PERM, SEED)
    return r.withColumn("p_value", F.round("p_value", 6))


@query("permutation_summary", f"""
WITH {OV_CTE},
M AS (SELECT count(*) AS n_a, coalesce(sum("end" - start), 0) AS bases FROM A)
SELECT CAST(G.obs AS BIGINT) AS observed_overlap, (G.exceed_count + 1.0) / {N_PERM + 1} AS global_p_value,
       CAST({N_PERM} AS BIGINT) AS num_permutations, M.n_a AS "setA_regions", N.n_b AS "setB_regions",
       CAST(M.bases AS BIGINT) AS "setA_total_bases", CAST(N.bases AS BIGINT) AS "setB_total_bases",
       0.05::DOUBLE / greatest(N.n_b, 1) AS bonferroni_threshold,
       (SELECT count(*) FROM C WHERE (exceed_count + 1.0) / {N_PERM + 1}.0 < 0.05 / greatest(N.n_b, 1))
         AS significant_regions_bonferroni,
       (SELECT count(*) FROM A WHERE chrom NOT IN (SELECT chrom FROM SZ WHERE length > 0)) AS permutation_dropped,
       1.0::DOUBLE / {N_PERM + 1} AS min_attainable_p
FROM M, N, G""")
def q_perm_summary(spark, d):
    return pm.permutation_summary(fx.intervals_a(spark, d), fx.intervals_b(spark, d), fx.chrom_sizes(spark, d), N_PERM, SEED)


# ====================================================================== sequences / ORFs
from locuspark.functions import dna as _dna  # noqa: E402
from locuspark.operators import sequences as sq  # noqa: E402

_CODON_MAP_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sorted(_dna.CODON_TABLE.items())) + "}"
_RC = f"reverse(translate({{x}}, '{_dna.COMPLEMENT_FROM}', '{_dna.COMPLEMENT_TO}'))"
_STARTS = "('ATG', 'CTG', 'TTG')"
_STOPS = "('TAA', 'TAG', 'TGA')"
ORF_CTE = f"""S AS ({fx.SEQUENCES_SQL}), CM AS (SELECT {_CODON_MAP_SQL} AS cm),
ST AS (SELECT record_no, '+' AS strand, seq AS sseq FROM S
       UNION ALL SELECT record_no, '-' AS strand, {_RC.format(x='seq')} AS sseq FROM S),
CH AS (SELECT record_no, strand, unnest(string_split(sseq, '')) AS ch,
              unnest(range(0, length(sseq))) AS i FROM ST),
P AS (SELECT * FROM (
        SELECT record_no, strand, i AS pos, i % 3 AS frame,
               ch || lead(ch, 1) OVER w || lead(ch, 2) OVER w AS codon
        FROM CH WINDOW w AS (PARTITION BY record_no, strand ORDER BY i)) x
      WHERE codon IN {_STARTS} OR codon IN {_STOPS}),
STA AS (SELECT * FROM P WHERE codon IN {_STARTS}),
STO AS (SELECT * FROM P WHERE codon IN {_STOPS}),
NX AS (SELECT s.record_no, s.strand, s.frame, s.pos, s.codon AS start_codon, t.pos AS stop_pos, t.codon AS stop_codon
       FROM STA s ASOF JOIN STO t
         ON s.record_no = t.record_no AND s.strand = t.strand AND s.frame = t.frame AND t.pos > s.pos),
SP AS (SELECT record_no, strand, frame, min(pos) AS start, arg_min(start_codon, pos) AS start_codon,
              stop_pos AS stop, any_value(stop_codon) AS stop_codon
       FROM NX GROUP BY record_no, strand, frame, stop_pos),
O1 AS (SELECT sp.*, s.seqid, s.seq, CAST(sp.stop + 3 - sp.start AS BIGINT) AS nt_len,
              CAST(CASE WHEN sp.strand = '+' THEN sp.start + 1 ELSE length(s.seq) - (sp.stop + 2) END AS BIGINT) AS start_1b,
              CAST(CASE WHEN sp.strand = '+' THEN sp.stop + 3 ELSE length(s.seq) - sp.start END AS BIGINT) AS end_1b
       FROM SP sp JOIN S s USING (record_no)),
O2 AS (SELECT *, CASE WHEN strand = '+' THEN substr(seq, start_1b, nt_len)
                      ELSE {_RC.format(x='substr(seq, start_1b, nt_len)')} END AS dna_seq FROM O1),
ORFS AS (SELECT record_no, seqid, strand, CAST(frame AS INTEGER) AS frame, start_1b, end_1b, nt_len,
                CAST(nt_len // 3 AS BIGINT) AS aa_len, start_codon, stop_codon,
                CASE WHEN length(dna_seq) = 0 THEN 0.0
                     ELSE (length(dna_seq) - length(regexp_replace(dna_seq, '[GCgc]', '', 'g'))) / length(dna_seq)::DOUBLE END AS gc,
                dna_seq, translate(dna_seq, 'Tt', 'Uu') AS rna_seq,
                split_part(array_to_string(list_transform(range(0, nt_len // 3),
                    lambda k: coalesce(cm[upper(substr(dna_seq, 3 * k + 1, 3))], 'X')), ''), '*', 1) AS protein
         FROM O2 CROSS JOIN CM)"""


def _orfs(spark, d):
    return sq.find_orfs(fx.sequences(spark, d))


@query("orfs", f"WITH {ORF_CTE} SELECT record_no, seqid, strand, frame, start_1b, end_1b, nt_len, aa_len, "
               "start_codon, stop_codon, round(gc, 6) AS gc, dna_seq, rna_seq, protein FROM ORFS")
def q_orfs(spark, d):
    return _orfs(spark, d).withColumn("gc", F.round("gc", 6))


@query("orf_summary", f"""WITH {ORF_CTE}
SELECT record_no, seqid, strand, frame, CAST(start_1b AS VARCHAR) || '..' || CAST(end_1b AS VARCHAR) AS coords,
       nt_len, aa_len, start_codon, stop_codon, round_even(gc * 100, 1) AS gc_pct,
       CASE WHEN length(protein) = 0 THEN '-' ELSE substr(protein, 1, 1) END AS protein_start,
       CASE WHEN length(protein) = 0 THEN '-'
            ELSE substr(protein, 1, 15) || CASE WHEN length(protein) > 15 THEN '…' ELSE '' END END AS protein_preview
FROM ORFS""")
def q_orf_summary(spark, d):
    return sq.orf_summary(_orfs(spark, d))


@query("orf_counts", f"""WITH {ORF_CTE}
SELECT s.record_no, s.seqid, CAST(length(s.seq) AS BIGINT) AS seq_len, CAST(count(o.record_no) AS BIGINT) AS n_orfs
FROM S s LEFT JOIN ORFS o USING (record_no) GROUP BY s.record_no, s.seqid, s.seq""")
def q_orf_counts(spark, d):
    return sq.count_orfs(fx.sequences(spark, d))


@query("gc_content", f"""WITH S AS ({fx.SEQUENCES_SQL})
SELECT record_no, CAST(length(seq) AS BIGINT) AS seq_len,
       round(CASE WHEN length(seq) = 0 THEN 0.0
             ELSE (length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) / length(seq)::DOUBLE END, 6) AS gc
FROM S""")
def q_gc(spark, d):
    s = fx.sequences(spark, d)
    return s.select("record_no", F.length("seq").cast("bigint").alias("seq_len"),
                    F.round(_dna.gc_fraction(F.col("seq")), 6).alias("gc"))


@query("reverse_complement", f"""WITH S AS ({fx.SEQUENCES_SQL})
SELECT record_no, md5({_RC.format(x='seq')}) AS rc_md5, md5(translate(seq, 'Tt', 'Uu')) AS rna_md5 FROM S""")
def q_rc(spark, d):
    s = fx.sequences(spark, d)
    return s.select("record_no", F.md5(_dna.reverse_complement(F.col("seq"))).alias("rc_md5"),
                    F.md5(_dna.to_rna(F.col("seq"))).alias("rna_md5"))


@query("orf_fasta", f"""WITH {ORF_CTE}
SELECT record_no, start_1b, end_1b, strand, frame,
       '>' || seqid || '|strand:' || strand || '|frame:' || CAST(frame AS VARCHAR) || '|coords:' ||
       CAST(start_1b AS VARCHAR) || '..' || CAST(end_1b AS VARCHAR) || '|len_nt:' || CAST(nt_len AS VARCHAR) ||
       '|len_aa:' || CAST(aa_len AS VARCHAR) || '|start:' || start_codon || '|stop:' || stop_codon AS header,
       array_to_string(list_transform(range(0, CAST(ceil(length(rna_seq) / 60) AS BIGINT)),
                                      lambda i: substr(rna_seq, i * 60 + 1, 60)), chr(10)) AS body
FROM ORFS""")
def q_orf_fasta(spark, d):
    return sq.orf_fasta_records(_orfs(spark, d))


# ====================================================================== genotypes / HMM
from locuspark.operators import genotypes as gt  # noqa: E402

GENO_CTE = f"""G AS ({fx.GENOTYPES_SQL}),
G2 AS (SELECT *, CASE WHEN strpos(gt, '/') > 0 THEN '/' WHEN strpos(gt, '|') > 0 THEN '|' END AS sep FROM G),
G3 AS (SELECT *, CASE WHEN sep IS NOT NULL THEN substr(gt, 1, strpos(gt, sep) - 1) END AS a1,
                 CASE WHEN sep IS NOT NULL THEN substr(gt, strpos(gt, sep) + 1) END AS a2 FROM G2),
C AS (SELECT *, CASE WHEN gt IS NULL OR gt = '.' OR starts_with(gt, '.') OR sep IS NULL OR a1 = '.' OR a2 = '.'
                     THEN NULL WHEN a1 = a2 THEN 'hom' ELSE 'het' END AS call FROM G3),
C2 AS (SELECT *, CASE WHEN call IS NULL THEN 0 ELSE CAST(a1 = '0' AS INTEGER) + CAST(a2 = '0' AS INTEGER) END AS ref_n,
                 CASE WHEN call IS NULL THEN 0 ELSE CAST(a1 = '1' AS INTEGER) + CAST(a2 = '1' AS INTEGER) END AS alt_n
       FROM C),
FQ AS (SELECT chrom, pos,
              coalesce(max(CASE WHEN regexp_matches(info, '(?:^|;)AF=')
                                THEN TRY_CAST(split_part(regexp_extract(info, '(?:^|;)AF=([^;]*)', 1), ',', 1) AS DOUBLE) END),
                       CASE WHEN sum(ref_n) + sum(alt_n) > 0 THEN sum(ref_n) / (sum(ref_n) + sum(alt_n))::DOUBLE END,
                       0.5) AS p
       FROM C2 GROUP BY chrom, pos)"""


def _dl(x: float) -> str:
    return f"'{x!r}'::DOUBLE" if math.isfinite(x) else "'-inf'::DOUBLE"


def _ln(expr: str) -> str:
    return f"(CASE WHEN ({expr}) <= 0 THEN '-inf'::DOUBLE ELSE ln({expr}) END)"


_PRI = [math.log((1 / 4e6) / (1 / 1.5e6 + 1 / 4e6)), math.log((1 / 1.5e6) / (1 / 1.5e6 + 1 / 4e6))]
_ONE = "1.0::DOUBLE"
_RIO = f"({_ONE} / 1.5e6::DOUBLE)"
_ROI = f"({_ONE} / 4e6::DOUBLE)"
_ERR = f"({_ONE} / 1000.0::DOUBLE)"
_PQ2 = f"(2.0::DOUBLE * p * ({_ONE} - p))"
VITERBI_CTE = f"""{GENO_CTE},
E AS MATERIALIZED (
  SELECT c.sample, c.chrom, c.pos, c.call, f.p,
         row_number() OVER (PARTITION BY c.sample, c.chrom ORDER BY c.pos) AS rn,
         c.pos - lag(c.pos) OVER (PARTITION BY c.sample, c.chrom ORDER BY c.pos) AS d
  FROM C2 c JOIN FQ f USING (chrom, pos)),
E2 AS MATERIALIZED (
  SELECT sample, chrom, pos, rn,
    CASE WHEN call IS NULL THEN 0.0::DOUBLE WHEN call = 'hom' THEN {_ln(f'{_ONE} - {_ERR}')} ELSE {_ln(_ERR)} END AS eI,
    CASE WHEN call IS NULL THEN 0.0::DOUBLE WHEN call = 'hom' THEN {_ln(f'{_ONE} - {_PQ2}')} ELSE {_ln(_PQ2)} END AS eO,
    CASE WHEN d IS NULL OR d <= 0 THEN 0.0::DOUBLE ELSE {_ln(f'exp(-{_RIO} * d)')} END AS tII,
    CASE WHEN d IS NULL OR d <= 0 THEN '-inf'::DOUBLE ELSE {_ln(f'{_ONE} - exp(-{_RIO} * d)')} END AS tIO,
    CASE WHEN d IS NULL OR d <= 0 THEN '-inf'::DOUBLE ELSE {_ln(f'{_ONE} - exp(-{_ROI} * d)')} END AS tOI,
    CASE WHEN d IS NULL OR d <= 0 THEN 0.0::DOUBLE ELSE {_ln(f'exp(-{_ROI} * d)')} END AS tOO
  FROM E),
R AS MATERIALIZED (
  WITH RECURSIVE RR(sample, chrom, rn, scI, scO, bI, bO) AS (
    SELECT sample, chrom, rn, {_dl(_PRI[0])} + eI, {_dl(_PRI[1])} + eO, 0, 0 FROM E2 WHERE rn = 1
    UNION ALL
    SELECT e.sample, e.chrom, e.rn,
      (CASE WHEN r.scO + e.tOI > r.scI + e.tII THEN r.scO + e.tOI ELSE r.scI + e.tII END) + e.eI,
      (CASE WHEN r.scO + e.tOO > r.scI + e.tIO THEN r.scO + e.tOO ELSE r.scI + e.tIO END) + e.eO,
      CASE WHEN r.scO + e.tOI > r.scI + e.tII THEN 1 ELSE 0 END,
      CASE WHEN r.scO + e.tOO > r.scI + e.tIO THEN 1 ELSE 0 END
    FROM RR r JOIN E2 e ON e.sample = r.sample AND e.chrom = r.chrom AND e.rn = r.rn + 1)
  SELECT * FROM RR),
NN AS (SELECT sample, chrom, max(rn) AS n FROM E2 GROUP BY sample, chrom),
BT AS MATERIALIZED (
  WITH RECURSIVE B(sample, chrom, rn, state) AS (
    SELECT r.sample, r.chrom, r.rn, CASE WHEN r.scI > r.scO THEN 0 ELSE 1 END
    FROM R r JOIN NN n ON r.sample = n.sample AND r.chrom = n.chrom AND r.rn = n.n
    UNION ALL
    SELECT b.sample, b.chrom, b.rn - 1, CASE WHEN b.state = 0 THEN nx.bI ELSE nx.bO END
    FROM B b JOIN R nx ON nx.sample = b.sample AND nx.chrom = b.chrom AND nx.rn = b.rn
    WHERE b.rn > 1)
  SELECT * FROM B),
ST AS (SELECT e.sample, e.chrom, e.pos, e.rn, CAST(b.state AS INTEGER) AS state
       FROM BT b JOIN E2 e ON e.sample = b.sample AND e.chrom = b.chrom AND e.rn = b.rn)"""


@query("genotype_calls", f"""WITH {GENO_CTE}
SELECT sample, chrom, pos, gt, call, CAST(ref_n AS INTEGER) AS ref_n, CAST(alt_n AS INTEGER) AS alt_n FROM C2""")
def q_geno_calls(spark, d):
    return gt.genotype_calls(fx.genotypes(spark, d)).select("sample", "chrom", "pos", "gt", "call", "ref_n", "alt_n")


@query("site_frequency", f"WITH {GENO_CTE} SELECT chrom, pos, round(p, 6) AS p FROM FQ")
def q_site_freq(spark, d):
    f = gt.site_frequency(gt.genotype_calls(fx.genotypes(spark, d)))
    return f.withColumn("p", F.round("p", 6))


@query("viterbi_states", f"WITH {VITERBI_CTE} SELECT sample, chrom, pos, state FROM ST")
def q_viterbi(spark, d):
    return gt.viterbi_states(fx.genotypes(spark, d)).select("sample", "chrom", "pos", "state")


@query("inbred_segments", f"""WITH {VITERBI_CTE},
RUNS AS (SELECT *, rn - row_number() OVER (PARTITION BY sample, chrom, state ORDER BY rn) AS grp FROM ST)
SELECT sample AS individual, chrom, min(pos) AS start_position, max(pos) AS stop_position
FROM RUNS WHERE state = 0 GROUP BY sample, chrom, grp""")
def q_inbred(spark, d):
    return gt.inbred_segments(fx.genotypes(spark, d))


# ====================================================================== population genetics
from locuspark.operators import asof as asf  # noqa: E402
from locuspark.operators import popgen as pg  # noqa: E402

HAPS_CTE = f"H AS ({fx.HAPLOTYPES_SQL}), K AS (SELECT pop, site, count(DISTINCT hap) AS k FROM H WHERE allele = 1 GROUP BY pop, site)"


def _a1_sql(n: str) -> str:
    return f"(SELECT coalesce(sum(1.0::DOUBLE / i), 0.0) FROM range(1, {n}) t(i))"


@query("allele_freq", f"""WITH {HAPS_CTE}
SELECT pop, site, CAST(k AS BIGINT) AS k, round(k / {fx.N_HAPS}.0::DOUBLE, 6) AS freq FROM K""")
def q_allele_freq(spark, d):
    r = pg.allele_freq(fx.haplotypes(spark, d), ["pop"], fx.N_HAPS)
    return r.withColumn("freq", F.round("freq", 6))


@query("diversity", f"""WITH {HAPS_CTE}
SELECT pop, CAST(sum(CASE WHEN k > 0 AND k < {fx.N_HAPS} THEN 1 ELSE 0 END) AS BIGINT) AS segregating_sites,
       round(sum(2.0 * k * ({fx.N_HAPS} - k) / ({fx.N_HAPS} * ({fx.N_HAPS} - 1.0))) / {fx.SEQ_LEN}.0, 6) AS pi,
       round(sum(CASE WHEN k > 0 AND k < {fx.N_HAPS} THEN 1 ELSE 0 END) / {_a1_sql(fx.N_HAPS)} / {fx.SEQ_LEN}.0, 6) AS theta_w
FROM K GROUP BY pop""")
def q_diversity(spark, d):
    r = pg.diversity(fx.haplotypes(spark, d), ["pop"], fx.N_HAPS, fx.SEQ_LEN)
    return r.withColumn("pi", F.round("pi", 6)).withColumn("theta_w", F.round("theta_w", 6))


@query("asof_step", f"""WITH P AS ({fx.STEP_POINTS_SQL}), S AS ({fx.STEPS_SQL})
SELECT p.l_orderkey, p.l_linenumber, round(p.t, 6) AS t,
       coalesce(s.value, (SELECT value FROM S ORDER BY t LIMIT 1)) AS value
FROM P p ASOF LEFT JOIN S s ON p.t >= s.t""")
def q_asof(spark, d):
    r = asf.asof_step(fx.step_points(spark, d), fx.steps_df(spark))
    return r.select("l_orderkey", "l_linenumber", F.round("t", 6).alias("t"), "value")


@query("asof_step_bucketed", f"""WITH P AS ({fx.STEP_POINTS_SQL}), S AS ({fx.STEPS_SQL})
SELECT p.l_orderkey, p.l_linenumber, round(p.t, 6) AS t,
       coalesce(s.value, (SELECT value FROM S ORDER BY t LIMIT 1)) AS value
FROM P p ASOF LEFT JOIN S s ON p.t >= s.t""")
def q_asof_b(spark, d):
    pts = fx.step_points(spark, d)
    steps = fx.steps_df(spark)
    first = steps.agg(F.min_by("value", "t")).first()[0]   # one scalar
    r = asf.asof_join(pts, steps, "t", "t", ["value"], (), "backward", True, buckets=16)
    r = r.withColumn("value", F.coalesce(F.col("value"), F.lit(first)))
    return r.select("l_orderkey", "l_linenumber", F.round("t", 6).alias("t"), "value")


@query("next_step", f"""WITH P AS ({fx.STEP_POINTS_SQL}), S AS ({fx.STEPS_SQL})
SELECT p.l_orderkey, p.l_linenumber, round(p.t, 6) AS t, s.t AS next_t
FROM P p ASOF LEFT JOIN S s ON s.t > p.t""")
def q_next(spark, d):
    r = asf.next_step(fx.step_points(spark, d), fx.steps_df(spark), buckets=16)
    return r.select("l_orderkey", "l_linenumber", F.round("t", 6).alias("t"), "next_t")


TREE_CTE = f"T AS ({fx.TREE_NODES_SQL})"
DESC_CTE = f"""{TREE_CTE},
LV AS (SELECT tree_id, node FROM T t WHERE NOT EXISTS (SELECT 1 FROM T c WHERE c.tree_id = t.tree_id AND c.parent = t.node)),
D AS (WITH RECURSIVE W(tree_id, node, leaf) AS (
        SELECT tree_id, node, node FROM LV
        UNION ALL
        SELECT w.tree_id, t.parent, w.leaf FROM W w JOIN T t ON t.tree_id = w.tree_id AND t.node = w.node
        WHERE t.parent IS NOT NULL)
      SELECT * FROM W)"""


@query("branch_lengths", f"""WITH {TREE_CTE}
SELECT c.tree_id, c.node, c.parent, round(greatest(p.time - c.time, 0.0), 6) AS branch_length
FROM T c JOIN T p ON p.tree_id = c.tree_id AND p.node = c.parent""")
def q_branch(spark, d):
    return pg.branch_lengths(fx.tree_nodes(spark, d)).withColumn("branch_length", F.round("branch_length", 6))


@query("tree_metrics", f"""WITH {DESC_CTE},
BL AS (SELECT c.tree_id, sum(greatest(p.time - c.time, 0.0)) AS tl
       FROM T c JOIN T p ON p.tree_id = c.tree_id AND p.node = c.parent GROUP BY c.tree_id)
SELECT r.tree_id, round(coalesce(bl.tl, 0.0), 6) AS total_tree_length, round(r.time, 6) AS time_to_mrca,
       CAST((SELECT count(*) FROM LV WHERE LV.tree_id = r.tree_id) AS BIGINT) AS n_leaves
FROM T r LEFT JOIN BL bl USING (tree_id) WHERE r.parent IS NULL""")
def q_tree_metrics(spark, d):
    r = pg.tree_metrics(fx.tree_nodes(spark, d))
    return r.select("tree_id", F.round("total_tree_length", 6).alias("total_tree_length"),
                    F.round("time_to_mrca", 6).alias("time_to_mrca"), "n_leaves")


@query("leaf_descendants", f"WITH {DESC_CTE} SELECT tree_id, node, leaf FROM D")
def q_desc(spark, d):
    return pg.leaf_descendants(fx.tree_nodes(spark, d))


@query("tree_diversity", f"""WITH {DESC_CTE},
M AS (SELECT t.tree_id, t.node, l_partkey % {fx.SEQ_LEN} AS site
      FROM lineitem li JOIN T t ON li.l_orderkey = t.order_key),
HP AS (SELECT DISTINCT m.tree_id, d.leaf AS hap, m.site FROM M m JOIN D d ON d.tree_id = m.tree_id AND d.node = m.node),
NL AS (SELECT tree_id, count(*) AS n FROM LV GROUP BY tree_id),
KK AS (SELECT tree_id, site, count(*) AS k FROM HP GROUP BY tree_id, site),
AG AS (SELECT nl.tree_id, nl.n,
              coalesce(sum(CASE WHEN kk.k > 0 AND kk.k < nl.n THEN 1 ELSE 0 END), 0) AS s,
              coalesce(sum(CASE WHEN nl.n >= 2 THEN 2.0 * kk.k * (nl.n - kk.k) / (nl.n * (nl.n - 1.0)) ELSE 0.0 END), 0.0) AS pis
       FROM NL nl LEFT JOIN KK kk USING (tree_id) GROUP BY nl.tree_id, nl.n),
MC AS (SELECT tree_id, count(*) AS mutation_count FROM M GROUP BY tree_id)
SELECT ag.tree_id, CAST(CASE WHEN n < 2 THEN 0 ELSE s END AS BIGINT) AS segregating_sites,
       CAST(coalesce(mc.mutation_count, 0) AS BIGINT) AS mutation_count,
       round(CASE WHEN n < 2 THEN 0.0 ELSE pis / {fx.SEQ_LEN}.0 END, 6) AS pi,
       round(CASE WHEN n < 2 THEN 0.0 ELSE s / (SELECT sum(1.0::DOUBLE / i) FROM range(1, n) t(i)) / {fx.SEQ_LEN}.0 END, 6) AS theta_w
FROM AG ag LEFT JOIN MC mc USING (tree_id)""")
def q_tree_div(spark, d):
    nodes = fx.tree_nodes(spark, d)
    ranges = saved(pg.leaf_ranges(nodes))
    muts = fx.mutations(spark, d, nodes)
    haps = pg.mutations_to_haplotypes(muts, ranges)
    sizes = ranges.where("leaf").groupBy("tree_id").agg(F.count(F.lit(1)).alias("n"))
    div = pg.diversity(haps, ["tree_id"], "n", fx.SEQ_LEN, group_sizes=sizes)
    mc = muts.groupBy("tree_id").agg(F.count(F.lit(1)).alias("mutation_count"))
    r = div.join(mc, "tree_id", "left")
    return r.select("tree_id", "segregating_sites",
                    F.coalesce("mutation_count", F.lit(0)).cast("bigint").alias("mutation_count"),
                    F.round("pi", 6).alias("pi"), F.round("theta_w", 6).alias("theta_w"))


_HD = hash60_sql("7", "o_orderkey")


@query("weighted_sample", f"""WITH W AS ({fx.WEIGHTS_SQL}),
C AS (SELECT item, w, sum(w) OVER (ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM W),
TT AS (SELECT sum(w) AS total FROM W),
DR AS (SELECT o_orderkey AS draw_id, 1 + {_HD} % (SELECT total FROM TT) AS u FROM orders)
SELECT dr.draw_id, dr.u, c.item FROM DR dr ASOF LEFT JOIN (SELECT * FROM C WHERE w > 0) c ON c.cum >= dr.u""")
def q_wsample(spark, d):
    draws = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("draw_id"))
    return pg.weighted_sample(fx.weights(spark, d), draws, seed=7)


# ====================================================================== clustering
from locuspark.operators import clustering as cl  # noqa: E402
from locuspark.operators import decomposition as dc  # noqa: E402

K_CLUSTERS = 10
KM_SEED = 0
_HV = hash60_sql(str(KM_SEED), "vec_id")
VLONG_CTE = """V AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS j,
                    CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""
INIT_CTE = f"""C0 AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY h, vec_id) - 1 AS INTEGER) AS cluster
       FROM (SELECT vec_id, {_HV} AS h FROM embeddings) x ORDER BY h, vec_id LIMIT {K_CLUSTERS}),
CL0 AS (SELECT c.cluster, v.j, v.v AS c FROM C0 c JOIN V v USING (vec_id))"""


def _km_round(r: int) -> str:
    return f"""D{r} AS (SELECT v.vec_id, c.cluster, sum((v.v - c.c) * (v.v - c.c)) AS d
        FROM V v JOIN CL{r - 1} c USING (j) GROUP BY v.vec_id, c.cluster),
A{r} AS (SELECT vec_id, cluster FROM D{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1),
CL{r} AS (SELECT a.cluster, v.j, avg(v.v) AS c FROM A{r} a JOIN V v USING (vec_id) GROUP BY a.cluster, v.j)"""


KM3_CTE = f"{VLONG_CTE}, {INIT_CTE}, " + ", ".join(_km_round(r) for r in (1, 2, 3))


@query("initial_centroids", f"""WITH {VLONG_CTE}, {INIT_CTE} SELECT vec_id, cluster AS rank FROM C0""")
def q_init(spark, d):
    _, ids = cl.sample_k(fx.vectors(spark, d), K_CLUSTERS, KM_SEED)
    return spark.createDataFrame([(int(i), r) for r, i in enumerate(ids)], "vec_id long, rank int")


@query("nearest_centroid", f"WITH {KM3_CTE} SELECT vec_id, cluster FROM A1")
def q_nearest(spark, d):
    v = fx.vectors(spark, d)
    cents, _ = cl.sample_k(v, K_CLUSTERS, KM_SEED)
    return cl.assign_nearest(v, cents).select("vec_id", "cluster")


@query("centroid_update", f"""WITH {KM3_CTE}
SELECT cluster, CAST((SELECT count(*) FROM A1 WHERE A1.cluster = c.cluster) AS BIGINT) AS n,
       list(round(c, 6) ORDER BY j) AS mean FROM CL1 c GROUP BY cluster""")
def q_centroid_update(spark, d):
    v = fx.vectors(spark, d)
    cents, _ = cl.sample_k(v, K_CLUSTERS, KM_SEED)
    m = cl.centroid_means(cl.assign_nearest(v, cents))
    return m.select("cluster", "n", F.transform("mean", lambda x: F.round(x, 6)).alias("mean"))


def _km3(spark, d):
    labels, _, _ = cl.kmeans(fx.vectors(spark, d), K_CLUSTERS, max_iters=3, tol=0.0, seed=KM_SEED)
    return labels


@query("kmeans_3_rounds", f"WITH {KM3_CTE} SELECT a.vec_id, e.label, a.cluster FROM A3 a JOIN embeddings e USING (vec_id)")
def q_km3(spark, d):
    return _km3(spark, d).select("vec_id", "label", "cluster")


@query("clustering_error", f"""WITH {KM3_CTE},
CC AS (SELECT a.cluster, e.label, count(*) AS cnt FROM A3 a JOIN embeddings e USING (vec_id) GROUP BY 1, 2),
PE AS (SELECT cluster, sum(cnt) - max(cnt) AS err FROM CC GROUP BY cluster)
SELECT CAST(coalesce(sum(err), 0) AS BIGINT) AS error FROM PE""")
def q_cl_err(spark, d):
    return cl.clustering_error(_km3(spark, d))


KM_ROUNDS = 60  # more than the labels need to settle; further rounds change nothing
KM_ALL_CTE = f"{VLONG_CTE}, {INIT_CTE}, " + ", ".join(_km_round(r) for r in range(1, KM_ROUNDS + 1))


@query("kmeans", f"""WITH {KM_ALL_CTE}
SELECT a.vec_id, e.label, a.cluster FROM A{KM_ROUNDS} a JOIN embeddings e USING (vec_id)""")
def q_kmeans(spark, d):
    labels, _, _ = cl.kmeans(fx.vectors(spark, d), K_CLUSTERS, max_iters=300, tol=1e-4, seed=KM_SEED)
    return labels.select("vec_id", "label", "cluster")


@query("kmeans_error", f"""WITH {KM_ALL_CTE},
CC AS (SELECT a.cluster, e.label, count(*) AS cnt FROM A{KM_ROUNDS} a JOIN embeddings e USING (vec_id) GROUP BY 1, 2),
PE AS (SELECT cluster, sum(cnt) - max(cnt) AS err FROM CC GROUP BY cluster)
SELECT CAST(coalesce(sum(err), 0) AS BIGINT) AS error FROM PE""")
def q_kmeans_err(spark, d):
    labels, _, _ = cl.kmeans(fx.vectors(spark, d), K_CLUSTERS, max_iters=300, tol=1e-4, seed=KM_SEED)
    return cl.clustering_error(labels)


# ====================================================================== PCA
@query("covariance", f"""WITH {VLONG_CTE}
SELECT CAST(a.j AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, round(covar_samp(a.v, b.v), 6) + 0.0 AS cov
FROM V a JOIN V b USING (vec_id) GROUP BY a.j, b.j""")
def q_cov(spark, d):
    return dc.covariance(fx.vectors(spark, d)).withColumn("cov", F.round("cov", 6) + F.lit(0.0))


SQUARINGS = 14  # powers of the covariance up to 2^14: the leading eigenvector to the last digits even at a gap of 1 %


def _leading_sql(c: str, name: str) -> str:
    """CTEs for the leading eigenpair of the symmetric table ``c`` (i, j, c): ``{name}`` (j, x) and ``{name}E`` (ev)."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM {c} WHERE i = j) AS c FROM {c})"]
    for n in range(1, SQUARINGS + 1):
        was = f"{name}{n - 1}"
        parts.append(f"""{name}{n} AS MATERIALIZED (SELECT a.i, b.j, sum(a.c * b.c) / (SELECT sum(c * c) FROM {was}) AS c
  FROM {was} a JOIN {was} b ON a.j = b.i GROUP BY a.i, b.j)""")
    last = f"{name}{SQUARINGS}"
    return ",\n".join([*parts, f"""{name}U AS MATERIALIZED (SELECT i AS j, c FROM {last}
  WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY c DESC, i LIMIT 1))""", f"""{name} AS MATERIALIZED (SELECT j,
  c / (SELECT sqrt(sum(c * c)) FROM {name}U) * (SELECT sign(arg_max(c, abs(c))) FROM {name}U) AS x FROM {name}U)""",
                       f"{name}E AS MATERIALIZED (SELECT sum(m.c * p.x * q.x) AS ev FROM {c} m JOIN {name} p ON p.j = m.i JOIN {name} q ON q.j = m.j)"])


# the two leading components of all dimensions, by squaring the covariance and by deflation
P2_CTE = f"""{VLONG_CTE},
MU AS MATERIALIZED (SELECT j, avg(v) AS m FROM V GROUP BY j),
CV AS MATERIALIZED (SELECT a.j AS i, b.j, covar_samp(a.v, b.v) AS c FROM V a JOIN V b USING (vec_id) GROUP BY a.j, b.j),
{_leading_sql("CV", "P")},
CW AS MATERIALIZED (SELECT i, m.j, c - (SELECT ev FROM PE) * p.x * q.x AS c FROM CV m JOIN P p ON p.j = m.i JOIN P q ON q.j = m.j),
{_leading_sql("CW", "Q")},
SC AS MATERIALIZED (SELECT vec_id, label, sum((v - m) * p.x) AS pc1, sum((v - m) * q.x) AS pc2
  FROM V JOIN MU USING (j) JOIN P p USING (j) JOIN Q q USING (j) GROUP BY vec_id, label)"""


@query("pca_2d", f"""WITH {P2_CTE}, T AS (SELECT sum(c) AS total FROM CV WHERE i = j)
SELECT 1 AS pc, round(ev, 6) AS eigenvalue, round(ev / total, 6) AS ratio FROM PE, T
UNION ALL SELECT 2, round(ev, 6), round(ev / total, 6) FROM QE, T""")
def q_pca2d(spark, d):
    """The two leading components of all dimensions."""
    _, comps, ev, ratio = dc.pca_fit(fx.vectors(spark, d), 2)
    rows = [(i + 1, round(float(ev[i]), 6), round(float(ratio[i]), 6)) for i in range(2)]
    return spark.createDataFrame(rows, "pc int, eigenvalue double, ratio double")


@query("pca_scores_2d", f"""WITH {P2_CTE}
SELECT vec_id, round(pc1, 6) + 0.0 AS pc1, round(pc2, 6) + 0.0 AS pc2 FROM SC""")
def q_pca_scores(spark, d):
    v = fx.vectors(spark, d)
    mu, comps, _, _ = dc.pca_fit(v, 2)
    s = dc.pca_transform(v, mu, comps)
    return s.select("vec_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("pc1", "pc2")])


@query("pca_reconstruct_2d", f"""WITH {P2_CTE}
SELECT vec_id, CAST(j AS INTEGER) AS j, round(m + pc1 * p.x + pc2 * q.x, 5) + 0.0 AS r
FROM SC CROSS JOIN MU JOIN P p USING (j) JOIN Q q USING (j)""")
def q_pca_recon(spark, d):
    """Every coordinate of every vector, rebuilt from its two scores."""
    v = fx.vectors(spark, d)
    mu, comps, _, _ = dc.pca_fit(v, 2)
    s = dc.pca_inverse(dc.pca_transform(v, mu, comps), mu, comps, ["pc1", "pc2"])
    return s.select("vec_id", F.posexplode("reconstruction").alias("j", "r")).withColumn("r", F.round("r", 5) + F.lit(0.0))


@query("class_centroid_point", f"""WITH {P2_CTE},
Z AS (SELECT avg(pc1) + 0.5 AS z1, avg(pc2) - 0.5 AS z2 FROM SC WHERE label = 1)
SELECT CAST(j AS INTEGER) AS j, round(m + z1 * p.x + z2 * q.x, 6) + 0.0 AS x FROM Z CROSS JOIN MU JOIN P p USING (j) JOIN Q q USING (j)""")
def q_class_point(spark, d):
    """A point beside the centre of class 1 in the space of the two scores, back in all dimensions."""
    v = fx.vectors(spark, d)
    mu, comps, _, _ = dc.pca_fit(v, 2)
    s = dc.pca_transform(v, mu, comps)
    z = s.where("label = 1").agg((F.avg("pc1") + 0.5).alias("pc1"), (F.avg("pc2") - 0.5).alias("pc2"))
    r = dc.pca_inverse(z, mu, comps, ["pc1", "pc2"])
    return r.select(F.posexplode("reconstruction").alias("j", "x")).withColumn("x", F.round("x", 6) + F.lit(0.0))


@query("pca_fit_checks", f"""WITH {VLONG_CTE}
SELECT CAST(pc AS INTEGER) AS pc, 1.0 AS norm, 0.0 AS residual, round(total, 6) AS total_variance
FROM (SELECT sum(s) AS total FROM (SELECT var_samp(v) AS s FROM V GROUP BY j) x) t, unnest(range(1, 6)) r(pc)""")
def q_pca_checks(spark, d):
    """All 64 dimensions: unit axes, |C v - lambda v| = 0 against the covariance table, and the total variance."""
    v = fx.vectors(spark, d)
    _, comps, ev, ratio = dc.pca_fit(v, 5)
    axes = spark.createDataFrame([(p + 1, j, float(x), float(ev[p]), float(ratio[p])) for p in range(5)
                                  for j, x in enumerate(comps[p])], "pc int, j int, x double, ev double, ratio double")
    moved = dc.covariance(v).join(F.broadcast(axes), "j").groupBy("pc", "i").agg(F.sum(F.col("cov") * F.col("x")).alias("cx"))
    own = axes.select("pc", F.col("j").alias("i"), "x", "ev", "ratio")
    both = moved.join(F.broadcast(own), ["pc", "i"]).groupBy("pc").agg(
        F.sqrt(F.sum(F.col("x") ** 2)).alias("norm"),
        F.sqrt(F.sum((F.col("cx") - F.col("ev") * F.col("x")) ** 2)).alias("residual"),
        F.first(F.col("ev") / F.col("ratio")).alias("total_variance"))
    return both.select("pc", *[F.round(c, 6).alias(c) for c in ("norm", "residual", "total_variance")])


@query("pca_fit")
def q_pca_fit(spark, d):
    _, comps, ev, ratio = dc.pca_fit(fx.vectors(spark, d), 5)
    return dc.components_df(spark, comps, ev, ratio)


# ====================================================================== prediction
from locuspark.operators import prediction as pr  # noqa: E402

LAB_CTE = f"LB AS ({fx.LABELLED_SQL})"
NUM_FEATURES = ["n_chars", "n_spaces", "n_digits"]


def _anova_sql(col: str) -> str:
    return f"""SELECT '{col}' AS feature,
  ((sum(sb) - sum(s) * sum(s) / sum(n)) / (count(*) - 1)) /
  (((sum(q) - sum(s) * sum(s) / sum(n)) - (sum(sb) - sum(s) * sum(s) / sum(n))) / (sum(n) - count(*))) AS f_value
FROM (SELECT y, count(*) AS n, sum({col}) AS s, sum({col} * {col}) AS q, sum({col}) * sum({col}) / count(*) AS sb
      FROM LB GROUP BY y) g"""


@query("anova_f", f"WITH {LAB_CTE} SELECT feature, round(f_value, 6) AS f_value FROM ("
                  + " UNION ALL ".join(_anova_sql(c) for c in NUM_FEATURES) + ") x")
def q_anova(spark, d):
    return pr.anova_f(fx.labelled(spark, d), NUM_FEATURES, "y").withColumn("f_value", F.round("f_value", 6))


@query("roc_auc", f"""WITH {LAB_CTE},
R AS (SELECT y, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS rk FROM LB)
SELECT round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
             / (sum(y) * (count(*) - sum(y))), 6) AS auc FROM R""")
def q_auc(spark, d):
    return pr.roc_auc(fx.labelled(spark, d), "n_chars", "y").select(F.round("auc", 6).alias("auc"))


_HS = hash60_sql("42", "doc_id")


@query("stratified_split", f"""WITH {LAB_CTE},
H AS (SELECT doc_id, y, {_HS} AS h FROM LB),
M AS (SELECT y, CAST(round(count(*) * 0.2) AS BIGINT) AS m FROM LB GROUP BY y)
SELECT h.doc_id, h.y, row_number() OVER (PARTITION BY h.y ORDER BY h.h) <= m.m AS is_val
FROM H h JOIN M m USING (y)""")
def q_split(spark, d):
    return pr.stratified_split(fx.labelled(spark, d).select("doc_id", "y"), "y", "doc_id", 0.2, 42) \
        .select("doc_id", "y", "is_val")


@query("one_hot_index", f"""WITH {LAB_CTE},
LG AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE) AS i FROM (SELECT DISTINCT lang FROM LB)),
SR AS (SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS DOUBLE) AS i FROM (SELECT DISTINCT source FROM LB))
SELECT doc_id, lg.i AS lang_index, sr.i AS source_index,
       CAST((SELECT count(*) FROM LG) AS INTEGER) AS lang_width, CAST((SELECT count(*) FROM SR) AS INTEGER) AS source_width
FROM LB JOIN LG lg USING (lang) JOIN SR sr USING (source)""")
def q_onehot(spark, d):
    from pyspark.ml import Pipeline
    lb = fx.labelled(spark, d)
    m = Pipeline(stages=pr.one_hot_stages(["lang", "source"])).fit(lb)
    out = m.transform(lb)
    from pyspark.ml.functions import vector_to_array
    return out.select("doc_id", F.col("lang__idx").alias("lang_index"), F.col("source__idx").alias("source_index"),
                      F.size(vector_to_array("lang__ohe")).alias("lang_width"),
                      F.size(vector_to_array("source__ohe")).alias("source_width"))


@query("scaled_features", f"""WITH {LAB_CTE},
SD AS (SELECT {", ".join(f"CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}" for c in NUM_FEATURES)} FROM LB)
SELECT doc_id, {", ".join(f"round(LB.{c} / SD.{c}, 6) AS {c}" for c in NUM_FEATURES)} FROM LB CROSS JOIN SD""")
def q_scaled(spark, d):
    lb = fx.labelled(spark, d)
    s = pr.scale_columns(lb, NUM_FEATURES)
    return s.select("doc_id", *[F.round(c, 6).alias(c) for c in NUM_FEATURES])


@query("select_k_best", f"""WITH {LAB_CTE}, AF AS ({" UNION ALL ".join(_anova_sql(c) for c in NUM_FEATURES)})
SELECT CAST(row_number() OVER (ORDER BY f_value DESC) AS INTEGER) AS rank, feature FROM AF
QUALIFY row_number() OVER (ORDER BY f_value DESC) <= 2""")
def q_kbest(spark, d):
    names = pr.select_k_best(fx.labelled(spark, d), NUM_FEATURES, "y", 2)
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "rank int, feature string")


def _split_frames(spark, d):
    from locuspark.session import cut_lineage
    lb = cut_lineage(fx.labelled(spark, d))
    sp = cut_lineage(pr.stratified_split(lb, "y", "doc_id", 0.2, 42))
    return lb, sp.where(~F.col("is_val")).drop("is_val"), sp.where(F.col("is_val")).drop("is_val")


@query("model_sweep")
def q_sweep(spark, d):
    _, tr, va = _split_frames(spark, d)
    rows, _ = pr.sweep(tr.drop("doc_id"), va, NUM_FEATURES, ["lang", "source"], "y", [1, 3], [1e-4, 1e-3])
    return spark.createDataFrame(rows, "k int, alpha double, auc double")


@query("risk_scores", """
SELECT CAST(doc_id AS BIGINT) AS id, true AS in_range FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY id""")
def q_scores(spark, d):
    """Fit on the labelled documents, score those without a label, write through the TSV sink, read back."""
    from locuspark.session import checkpoint_dir
    from locuspark.sources.files import write_tsv
    lb, tr, va = _split_frames(spark, d)
    _, best = pr.sweep(tr.drop("doc_id"), va, NUM_FEATURES, ["lang", "source"], "y", [1, 3], [1e-4, 1e-3])
    model, fac, _ = pr.fit_logistic(lb.drop("doc_id"), NUM_FEATURES, ["lang", "source"], "y", best[0], best[1])
    new, id_col = pr.ensure_id(fx.unlabelled(spark, d).withColumnRenamed("doc_id", "id"))
    scored = pr.predict_proba(model, fac, new).select(id_col, F.col("score").alias("quality"))
    path = f"{checkpoint_dir(spark)}/risk_scores_{uuid.uuid4().hex}"
    write_tsv(scored, path, order_by=[id_col])
    back = spark.read.csv(path, sep="\t", header=True, schema="id long, quality double")
    return back.select("id", F.col("quality").between(0.0, 1.0).alias("in_range"))


def _checks_sql(*names: str) -> str:
    """What a query of checks must give: every one of them holds."""
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in names) + ") t(\"check\", ok)"


def _checks(spark, **found: bool):
    return spark.createDataFrame([(n, bool(ok)) for n, ok in found.items()], "check string, ok boolean")


@query("model_sgd_checks", _checks_sql("loss_falls", "stops_early", "auc_near_lbfgs", "every_row_scored"))
def q_sgd(spark, d):
    """Whether a document has 200 spaces or more, from its other features: stochastic gradient descent against L-BFGS
    on the same split of all documents."""
    from locuspark.session import cut_lineage
    rows = fx.features(spark, d).withColumn("y", (F.col("n_spaces") >= 200).cast("int"))
    split = cut_lineage(pr.stratified_split(rows, "y", "doc_id", 0.2, 42))
    tr, va = split.where("NOT is_val").drop("is_val"), split.where("is_val").drop("is_val")
    num, cats = ["n_chars", "n_digits"], ["lang", "source"]
    sgd = pr.fit_sgd(tr, num, cats, "y", 2, 1e-3, "doc_id")
    model, factors, _ = pr.fit_logistic(tr.drop("doc_id"), num, cats, "y", 2, 1e-3)
    scored = pr.predict_sgd(sgd, va)
    auc = [pr.roc_auc(x, "score", "y").first()["auc"] for x in (scored, pr.predict_proba(model, factors, va))]
    return _checks(spark, loss_falls=min(h[0] for h in sgd.history[1:]) < sgd.history[0][0], stops_early=sgd.rounds < 2000,
                   auc_near_lbfgs=abs(auc[0] - auc[1]) <= 0.01, every_row_scored=scored.where("score BETWEEN 0 AND 1").count() == va.count())


@query("label_codes", """
SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS code FROM documents""")
def q_label_codes(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    return pr.encode_labels(docs, "lang", "code").select("doc_id", "lang", "code")


@query("agreement", """
SELECT round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS cosine, round(corr(x, y), 6) AS corr,
       round(sqrt(sum((x - y) * (x - y))) / sqrt(sum(x * x)), 6) AS rel_l2
FROM (SELECT CAST(l_extendedprice AS DOUBLE) AS x, CAST(l_quantity AS DOUBLE) * 1500 AS y FROM lineitem) t""")
def q_agreement(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.col("l_extendedprice").cast("double").alias("x"), (F.col("l_quantity").cast("double") * 1500).alias("y"))
    return pr.agreement(li, "x", "y").select(*[F.round(c, 6).alias(c) for c in ("cosine", "corr", "rel_l2")])


# ====================================================================== NMF / ancestry
ABS_CTE = """AV AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS j,
                      abs(CAST(unnest(embedding) AS DOUBLE)) AS v FROM embeddings),
RS AS (SELECT vec_id, sum(v) AS s FROM AV GROUP BY vec_id),
PR AS (SELECT a.vec_id, a.label, a.j, a.v / CASE WHEN r.s = 0 THEN 1.0 ELSE r.s END AS p
       FROM AV a JOIN RS r USING (vec_id))"""


def _abs_props(spark, d):
    v = fx.vectors(spark, d).withColumn("features", F.transform("features", lambda x: F.abs(x)))
    return dc.row_normalize(v, "features", "props")


@query("row_proportions", f"WITH {ABS_CTE} SELECT vec_id, list(round(p, 6) ORDER BY j) AS props FROM PR GROUP BY vec_id")
def q_rowprops(spark, d):
    p = _abs_props(spark, d)
    return p.select("vec_id", F.transform("props", lambda x: F.round(x, 6)).alias("props"))


def _group_means(spark, d):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    p = _abs_props(spark, d)
    g = p.groupBy("label").agg(Summarizer.mean(array_to_vector("props")).alias("m"))
    return g.select("label", vector_to_array("m").alias("mean"))


@query("group_means", f"""WITH {ABS_CTE}, GM AS (SELECT label, j, avg(p) AS m FROM PR GROUP BY label, j)
SELECT label, list(round(m, 6) ORDER BY j) AS mean FROM GM GROUP BY label""")
def q_group_means(spark, d):
    g = _group_means(spark, d)
    return g.select("label", F.transform("mean", lambda x: F.round(x, 6)).alias("mean"))


@query("mean_of_group_means", f"""WITH {ABS_CTE}, GM AS (SELECT label, j, avg(p) AS m FROM PR GROUP BY label, j),
MG AS (SELECT j, avg(m) AS mm FROM GM GROUP BY j)
SELECT CAST(j AS INTEGER) AS component, round(mm, 6) AS prevalence,
       CAST(row_number() OVER (ORDER BY mm DESC, j) AS INTEGER) AS rank FROM MG""")
def q_mgm(spark, d):
    g = _group_means(spark, d)
    dim = g.select(F.size("mean").alias("n")).first()["n"]
    cols = [F.col("mean")[j].alias(f"c{j}") for j in range(dim)]
    wide = g.select(*cols)
    order = dc.rank_columns(wide, [f"c{j}" for j in range(dim)])
    means = wide.agg(*[F.avg(f"c{j}").alias(f"c{j}") for j in range(dim)]).first()
    rows = [(j, round(float(means[f"c{j}"]), 6), order.index(f"c{j}") + 1) for j in range(dim)]
    return spark.createDataFrame(rows, "component int, prevalence double, rank int")


def _nmf(spark, d):
    v = fx.vectors(spark, d).withColumn("features", F.transform("features", lambda x: F.abs(x)))
    return v, dc.nmf(v, 5)


@query("nmf_factors")
def q_nmf(spark, d):
    _, (w, h, it, rel) = _nmf(spark, d)
    return w


@query("ancestry_summary")
def q_ancestry(spark, d):
    v, (w, h, it, rel) = _nmf(spark, d)
    return dc.ancestry_summary(w, v, "vec_id", "label", 5)


# ====================================================================== sources / sinks (round trips)
from locuspark.sources import files as fs  # noqa: E402


def _scratch(spark, name: str) -> str:
    import uuid
    from locuspark.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex}"


@query("bed_roundtrip", f'WITH {A_CTE} SELECT chrom, start, "end" FROM A')
def q_bed_rt(spark, d):
    path = _scratch(spark, "bed")
    a = fx.intervals_a(spark, d)
    a.select(F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"),
                         F.concat(F.lit("r"), F.col("region_id").cast("string")))) \
        .write.mode("overwrite").text(path)
    return fs.read_bed(spark, path).select("chrom", "start", "end")


@query("fai_roundtrip", f"WITH {SZ_CTE} SELECT chrom, length FROM SZ")
def q_fai_rt(spark, d):
    path = _scratch(spark, "fai")
    fx.chrom_sizes(spark, d).select(F.concat_ws("\t", "chrom", F.col("length").cast("string"),
                                                F.lit("0"), F.lit("60"), F.lit("61"))).write.text(path)
    return fs.read_fai(spark, path)


@query("fasta_roundtrip", f"""WITH S AS ({fx.SEQUENCES_SQL})
SELECT seqid, CAST(length(seq) AS BIGINT) AS seq_len, md5(seq) AS seq_md5 FROM S""")
def q_fasta_rt(spark, d):
    path = _scratch(spark, "fasta")
    fs.write_fasta(fx.sequences(spark, d), path, header_col="seqid", seq_col="seq")
    r = fs.read_fasta(spark, path)
    return r.select("seqid", F.length("seq").cast("bigint").alias("seq_len"), F.md5("seq").alias("seq_md5"))


@query("vcf_roundtrip", f"""WITH {GENO_CTE}
SELECT sample, CAST(count_if(call = 'hom') AS BIGINT) AS n_hom, CAST(count_if(call = 'het') AS BIGINT) AS n_het,
       CAST(count(*) AS BIGINT) AS n_sites FROM C2 GROUP BY sample""")
def q_vcf_rt(spark, d):
    path = _scratch(spark, "vcf")
    g = saved(fx.genotypes(spark, d))
    # sample names form the VCF header: one name per sample, bounded by the cohort
    samples = sorted(r["sample"] for r in g.select("sample").distinct().collect())
    fs.vcf_lines(g, samples).write.option("compression", "gzip").text(f"{path}/body")
    hdr = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])
    spark.createDataFrame([("##fileformat=VCFv4.2",), (hdr,)], "value string").coalesce(1).write.text(f"{path}/head")
    v = fs.read_vcf_genotypes(spark, f"{path}/*")
    c = gt.genotype_calls(v).where(F.col("gt") != ".")
    return c.groupBy("sample").agg(F.count_if(F.col("call") == "hom").alias("n_hom"),
                                   F.count_if(F.col("call") == "het").alias("n_het"),
                                   F.count(F.lit(1)).alias("n_sites"))


@query("csv_roundtrip", f"WITH {LAB_CTE} SELECT doc_id, n_chars, lang, y FROM LB")
def q_csv_rt(spark, d):
    path = _scratch(spark, "csv")
    fs.write_tsv(fx.labelled(spark, d).select("doc_id", "n_chars", "lang", "y"), path, sep=",")
    t = fs.read_table(spark, path, target="y")
    return t.select(F.col("doc_id").cast("bigint"), F.col("n_chars").cast("double"), "lang", F.col("y").cast("int"))


@query("tsv_roundtrip", f"""WITH {A_CTE}, {B_CTE}
SELECT b.region_id, CAST(coalesce(sum(CASE WHEN a.region_id IS NOT NULL
                       THEN least(a."end", b."end") - greatest(a.start, b.start) END), 0) AS BIGINT) AS overlap
FROM B b LEFT JOIN A a ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" GROUP BY b.region_id""")
def q_tsv_rt(spark, d):
    path = _scratch(spark, "tsv")
    fs.write_tsv(iv.coverage_per_region(fx.intervals_a(spark, d), fx.intervals_b(spark, d)), path,
                 order_by=["region_id"])
    t = fs.read_table(spark, path, sep="\t")
    return t.select(F.col("region_id").cast("bigint"), F.col("overlap").cast("bigint"))


@query("vectors_loaded", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, label FROM embeddings")
def q_vectors(spark, d):
    v = fs.load_vectors(fx.table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    return v.select("vec_id", F.size("features").alias("dims"), "label")


# ====================================================================== merge trees
from locuspark.operators import merge_tree as mt  # noqa: E402

TREE_K = 25
MERGE_CTE = f"M AS ({fx.MERGES_SQL}), N AS (SELECT count(*) AS n FROM part)"
CUT_CTE = f"""{MERGE_CTE}, H AS (SELECT height AS t FROM M, N WHERE step = n - {TREE_K} - 1),
UP AS (SELECT "left" AS node, n + step AS up FROM M, N, H WHERE height <= t
       UNION ALL SELECT "right", n + step FROM M, N, H WHERE height <= t),
R AS (WITH RECURSIVE W(leaf, node) AS (SELECT i, i FROM N, unnest(range(n)) t(i)
        UNION ALL SELECT W.leaf, UP.up FROM W JOIN UP USING (node)) SELECT leaf, max(node) AS top FROM W GROUP BY leaf)"""


@query("tree_cut", f"""WITH {CUT_CTE}
SELECT leaf, CAST(dense_rank() OVER (ORDER BY first) AS INTEGER) AS cluster
FROM (SELECT leaf, min(leaf) OVER (PARTITION BY top) AS first FROM R) x""")
def q_tree_cut(spark, d):
    merges, n = fx.merges(spark, d)
    return mt.cut_tree(merges, n, TREE_K)


@query("tree_truncated", f"""WITH {MERGE_CTE},
UP AS (SELECT "left" AS node, n + step AS up, step FROM M, N UNION ALL SELECT "right", n + step, step FROM M, N),
S AS (WITH RECURSIVE W(leaf, node) AS (SELECT i, i FROM N, unnest(range(n)) t(i)
        UNION ALL SELECT W.leaf, UP.up FROM W JOIN UP USING (node)) SELECT node, count(*) AS size FROM W GROUP BY node)
SELECT UP.node, S.size FROM UP JOIN S USING (node), N
WHERE UP.step >= n - {TREE_K} AND UP.node < n + (n - {TREE_K})""")
def q_tree_truncated(spark, d):
    merges, n = fx.merges(spark, d)
    return mt.truncate_tree(merges, n, TREE_K)


@query("nmf_checks", _checks_sql("converged", "w_not_negative", "h_not_negative", "rows_optimal", "error_as_reported"))
def q_nmf_checks(spark, d):
    """Invariants of the factors on all rows: each row of W is optimal for H, and the error is that of the product."""
    import numpy as np
    v, (w, h, rounds, rel) = _nmf(spark, d)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    lit = lambda m: F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in m])
    j = v.join(w, "vec_id").withColumn("fit", F.transform(lit(h.T), lambda c: dot(c, F.col("w")))).withColumn(
        "gap", F.zip_with("fit", "features", lambda a, b: a - b))
    j = j.withColumn("slope", F.transform(lit(h), lambda r: dot(r, F.col("gap"))))
    worst = F.array_max(F.zip_with("w", "slope", lambda x, g: F.when(x > 1e-9, F.abs(g)).otherwise(F.greatest(-g, F.lit(0.0)))))
    r = j.agg(F.max(worst).alias("slope"), F.min(F.array_min("w")).alias("least"), F.sum(dot(F.col("gap"), F.col("gap"))).alias("e"),
              F.sum(dot(F.col("features"), F.col("features"))).alias("x")).first()
    return _checks(spark, converged=rounds < 1000, w_not_negative=r["least"] >= 0, h_not_negative=bool(np.all(h >= 0)),
                   rows_optimal=r["slope"] < 1e-3, error_as_reported=abs(math.sqrt(r["e"] / r["x"]) - rel) < 1e-6)


@query("ancestry_checks", """
SELECT label, true AS sums_to_one, true AS largest_first FROM embeddings GROUP BY label""")
def q_ancestry_checks(spark, d):
    """Per label the shares add up to 1 (each is rounded to 2 places); over labels the first share is the largest on average."""
    v, (w, *_) = _nmf(spark, d)
    shares = dc.ancestry_summary(w, v, "vec_id", "label", 5, digits=2)
    cols = [f"ancestry{i}" for i in range(1, 6)]
    means = shares.agg(*[F.avg(c).alias(c) for c in cols]).first()
    falls = all(means[a] >= means[b] - 0.01 for a, b in zip(cols, cols[1:]))
    return shares.select("label", (F.abs(sum(F.col(c) for c in cols) - 1) < 0.026).alias("sums_to_one"),
                         F.lit(falls).alias("largest_first"))


@query("pca_space_checks", _checks_sql("scores_centred", "scores_uncorrelated", "variances_are_eigenvalues",
                                       "left_out_variance"))
def q_pca_space(spark, d):
    """Scores on 8 components and the reconstruction from them, in all 64 dimensions and on all rows."""
    v = fx.vectors(spark, d)
    n, dim, k = v.count(), len(v.first()["features"]), 8
    mu, comps, evals, _ = dc.pca_fit(v, dim)
    cols = [f"pc{i + 1}" for i in range(k)]
    both = dc.pca_inverse(dc.pca_transform(v, mu, comps[:k]), mu, comps[:k], cols, "part")
    gap = F.aggregate(F.zip_with("features", "part", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    r = both.agg(F.sum(gap).alias("e"), *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.var_samp(c).alias(f"v_{c}") for c in cols],
                 *[F.corr(cols[i], cols[j]).alias(f"r_{i}_{j}") for i in range(k) for j in range(i)]).first()
    return _checks(
        spark, scores_centred=max(abs(r[f"m_{c}"]) for c in cols) < 1e-9,
        scores_uncorrelated=max(abs(r[f"r_{i}_{j}"]) for i in range(k) for j in range(i)) < 1e-6,
        variances_are_eigenvalues=max(abs(r[f"v_{c}"] - e) / e for c, e in zip(cols, evals)) < 1e-9,
        left_out_variance=abs(r["e"] / (n - 1) - evals[k:].sum()) < 1e-6 * evals.sum())
