from locuspark.operators import sequences as sq
from locuspark.plans import fixtures as fx

ROWS = [(1, "plus_orf", "AAAATGAAAGGGCCCTAGTTT"), (2, "minus_orf", "GGGTCAGGGCATCCC"),
        (3, "overlap_plus", "CCCATGAAACCCATGAAATGATTTTGA"), (4, "alt_start", "TTGAAACCCAAATAG"),
        (5, "noise", "GACGACGACGACGACGAC")]
EXPECTED = [
    ("plus_orf", "+", 0, 4, 18, 15, 5, "ATGAAAGGGCCCTAG", "MKGP"),
    ("minus_orf", "-", 0, 4, 12, 9, 3, "ATGCCCTGA", "MP"),
    ("overlap_plus", "+", 0, 4, 21, 18, 6, "ATGAAACCCATGAAATGA", "MKPMK"),
    ("alt_start", "+", 0, 1, 15, 15, 5, "TTGAAACCCAAATAG", "LKPK"),
]


def _rows(df):
    return sorted((r.seqid, r.strand, r.frame, r.start_1b, r.end_1b, r.nt_len, r.aa_len, r.dna_seq, r.protein)
                  for r in df.collect())


def test_orf_self_test_records(spark):
    s = spark.createDataFrame(ROWS, "record_no long, seqid string, seq string")
    for tile in (4, 7, 1 << 13):
        assert _rows(sq.find_orfs(s, tile=tile)) == sorted(EXPECTED)
    assert "alt_start" not in {r[0] for r in _rows(sq.find_orfs(s, allow_alt=False))}
    assert "minus_orf" not in {r[0] for r in _rows(sq.find_orfs(s, min_aa=5))}
    o = sq.find_orfs(s).where("seqid = 'plus_orf'").first()
    assert o.rna_seq == "AUGAAAGGGCCCUAG" and o.start_codon == "ATG" and o.stop_codon == "TAG"
    counts = {r.seqid: r.n_orfs for r in sq.orf_counts(s, sq.find_orfs(s)).collect()}
    assert counts["noise"] == 0 and sum(counts.values()) == 4


def test_orfs_tile_invariance_on_documents(spark):
    s = fx.sequences(spark, "/root/testdata/sf0.001")
    a = sorted(map(tuple, sq.orf_spans(s, tile=1 << 13).collect()))
    b = sorted(map(tuple, sq.orf_spans(s.repartition(3), tile=97).collect()))
    assert a == b and len(a) > 0


def test_fasta_wrap(spark):
    from pyspark.sql import functions as F
    from locuspark.functions.dna import wrap60
    r = spark.createDataFrame([("A" * 130,)], "s string").select(wrap60(F.col("s")).alias("w")).first().w
    assert r.split("\n") == ["A" * 60, "A" * 60, "A" * 10]


def test_letters_beyond_ascii(spark):
    """Such letters are no codon letters, but they stay in the ORF's bases on both strands."""
    seq = "AAAATGÉAAGGGTAACC"
    df = spark.createDataFrame([(1, "s", seq)], "record_no long, seqid string, seq string")
    rows = sq.find_orfs(df).collect()
    plus = [r for r in rows if r.strand == "+" and r.dna_seq.startswith("ATG")]
    assert [r.dna_seq for r in plus] == ["ATGÉAAGGGTAA"] and plus[0].protein == "MXG"
    assert all(len(r.dna_seq) == r.nt_len for r in rows)



def _plain(seq, allow_alt=True):
    """Codon by codon: {(strand, frame, start, stop)} in strand coordinates, and the ORF's letters."""
    pairs = dict(zip("ACGTRYKMSWBDHVNacgtrykmswbdhvn", "TGCAYRMKSWVHDBNtgcayrmkswvhdbn"))
    out = {}
    for strand, text in (("+", seq), ("-", "".join(pairs.get(c, c) for c in reversed(seq)))):
        for frame in range(3):
            begin = None
            for i in range(frame, len(text) - 2, 3):
                codon = text[i:i + 3].upper()
                if begin is None and codon in (("ATG", "CTG", "TTG") if allow_alt else ("ATG",)):
                    begin = i
                elif codon in ("TAA", "TAG", "TGA"):
                    if begin is not None:
                        out[strand, frame, begin, i] = text[begin:i + 3]
                    begin = None
    return out


def test_orfs_across_tiles_against_plain(spark):
    """Tiles from 3 letters up, records of one tile and of many, and long stretches without a stop."""
    import random
    rng = random.Random(4)
    seqs = ["".join(rng.choice("ACGTacgtNé") for _ in range(n)) for n in (0, 1, 2, 3, 5, 50, 200, 400)]
    seqs += ["ATG" + "ACC" * 60 + "TAG" + "C" * 50, "C" * 40 + "TTA" + "GGT" * 50 + "CAT" + "N" * 30, "ATG" * 70, "TAA" * 50]
    df = spark.createDataFrame(list(enumerate(seqs)), "record_no long, seq string").selectExpr(
        "record_no", "concat('s', record_no) AS seqid", "seq")
    want = {(i, *k): v for i, s in enumerate(seqs) for k, v in _plain(s).items()}
    for tile in (3, 10, 64, 1 << 18):
        rows = sq.orf_spans(df, tile=tile).collect()
        assert len(rows) == len(want) and {(r.record_no, r.strand, r.frame, r.start, r.stop) for r in rows} == set(want)
        full = sq.find_orfs(df, tile=tile).collect()
        assert sorted((r.record_no, r.strand, r.frame, r.dna_seq) for r in full) == sorted(
            (k[0], k[1], k[2], v) for k, v in want.items())
        for r in full:
            n = len(seqs[r.record_no])
            start = r.start_1b - 1 if r.strand == "+" else n - r.end_1b
            assert want[r.record_no, r.strand, r.frame, start, start + r.nt_len - 3] == r.dna_seq
            assert r.rna_seq == r.dna_seq.replace("T", "U").replace("t", "u") and len(r.protein) == r.aa_len - 1
            assert abs(r.gc - sum(c in "GCgc" for c in r.dna_seq) / r.nt_len) < 1e-12
            assert r.start_codon == r.dna_seq[:3].upper() and r.stop_codon == r.dna_seq[-3:].upper()
        counts = {r.record_no: (r.seq_len, r.n_orfs) for r in sq.count_orfs(df, tile=tile).collect()}
        assert counts == {i: (len(s), sum(k[0] == i for k in want)) for i, s in enumerate(seqs)}

