"""Open-reading-frame search on both strands of a sequence table.

Semantics per strand and frame: scanning codons left to right, an ORF opens
at the first start codon after the previous in-frame stop (or the strand
start) and closes at the next in-frame stop; nested starts are ignored and
an open ORF without a stop is dropped.

Plan: sequences are cut into tiles with two letters of margin, and one pass over a tile finds,
on both strands, every ORF that the tile alone decides, with its bases and protein as slices.
What depends on the tiles before is one row for each tile, strand and frame: whether it has a stop, the piece
that its first stop closes, and the start that its last piece leaves open.  These rows compose: a
running scan over a record's tiles tells what is open at each tile, and closes the ORFs that cross tiles.
Codons never become rows; only crossing ORFs fetch their bases from the tiles, and records of one tile need neither step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.functions import dna
from locuspark.session import cut_lineage, spread

DEFAULT_TILE = 1 << 18   # letters a tile owns
MARGIN = 2               # letters beyond, so that codons at its ends are whole
FLUSH = 20_000           # ORFs in an output batch

_LETTERS = "ACGT"
_BASE = np.full(256, 4, np.uint8)  # A, C, G, T in either case, and 4 for all else
for _i, _c in enumerate(_LETTERS):
    _BASE[ord(_c)] = _BASE[ord(_c.lower())] = _i
_CODONS = {a * 25 + b * 5 + c: x + y + z for a, x in enumerate(_LETTERS) for b, y in enumerate(_LETTERS)
           for c, z in enumerate(_LETTERS)}
_AMINO = np.full(125, ord("X"), np.uint8)
for _k, _codon in _CODONS.items():
    _AMINO[_k] = ord(dna.CODON_TABLE[_codon])
_COMPLEMENT = str.maketrans(dna.COMPLEMENT_FROM, dna.COMPLEMENT_TO)
_RNA = str.maketrans("Tt", "Uu")
START, STOP = 1, 2


def _classes(allow_alt: bool) -> np.ndarray:
    """Start or stop, by number of the codon."""
    starts = dna.START_CODONS + (dna.ALT_START_CODONS if allow_alt else ())
    kind = np.zeros(125, np.uint8)
    for number, codon in _CODONS.items():
        kind[number] = START if codon in starts else STOP if codon in dna.STOP_CODONS else 0
    return kind


# ---------------------------------------------------------------- tiles
def strand_tiles(seqs: DataFrame, tile: int = DEFAULT_TILE) -> DataFrame:
    """``record_no, seqid, seq_len, tile, txt``: the letters a tile owns, with margins; an empty sequence has one tile."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record, seqid, seq in zip(*(batch.column(c).to_pylist() for c in ("record_no", "seqid", "seq"))):
                seq = seq or ""
                for first in range(0, max(len(seq), 1), tile):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([record], pa.int64()), pa.array([seqid], pa.string()), pa.array([len(seq)], pa.int64()),
                         pa.array([first // tile], pa.int64()), pa.array([seq[max(0, first - MARGIN):first + tile + MARGIN]])],
                        ["record_no", "seqid", "seq_len", "tile", "txt"])
    out = seqs.select("record_no", "seqid", "seq").mapInArrow(
        cut, "record_no long, seqid string, seq_len long, tile long, txt string")
    return spread(out, "record_no", "tile")


class _Strand:
    """One strand of a tile: classes of codons, and text to slice."""

    def __init__(self, txt: str, at: int, own: tuple[int, int], length: int, kinds: np.ndarray):
        """``at``: strand position of the text's first letter; ``own``: strand positions that the tile owns."""
        self.txt, self.at = txt, at
        base = _BASE[np.frombuffer(txt.encode("ascii", "replace"), np.uint8)].astype(np.int64)
        self.codon = base[:-2] * 25 + base[1:-1] * 5 + base[2:]
        self.kind = kinds[self.codon]
        self.gc = np.concatenate([[0], np.cumsum((base == 1) | (base == 2))])
        self.first, self.last = own[0] - at, min(own[1], length - 2) - at

    def frames(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(frame, places of starts, places of stops), places in the text."""
        for frame in range(3):
            i = self.first + (frame - self.at - self.first) % 3
            kind = self.kind[i:max(i, self.last):3]
            yield frame, np.flatnonzero(kind == START) * 3 + i, np.flatnonzero(kind == STOP) * 3 + i

    def name(self, place: int) -> str:
        return _CODONS[int(self.codon[place])]


def _both(txt: str, tile_no: int, tile: int, length: int, kinds: np.ndarray):
    """(strand, whether the tile is the strand's first, scan) of both strands."""
    t0, end = tile_no * tile, min((tile_no + 1) * tile, length)
    begin = max(0, t0 - MARGIN)
    close = begin + len(txt)
    yield "+", t0 == 0, _Strand(txt, begin, (t0, end), length, kinds)
    yield "-", end == length, _Strand(txt.translate(_COMPLEMENT)[::-1], length - close, (length - end, length - t0), length, kinds)


SPAN = "record_no long, strand string, frame int, start long, stop long, start_codon string, stop_codon string"
BASES = "seqid string, start_1b long, end_1b long, nt_len long, aa_len long, gc double, dna_seq string, rna_seq string, protein string"
EDGE = ("record_no long, seqid string, strand string, frame int, tile long, seq_len long, has_stop boolean, first boolean, "
        "head_start long, head_codon string, head_stop long, stop_codon string, tail_start long, tail_codon string")


def _scan(tile: int, allow_alt: bool, min_aa: int, bases: bool):
    """Tiles -> ORFs that one tile decides."""
    kinds, least = _classes(allow_alt), max(1, int(min_aa)) * 3
    names = [x.split()[0] for x in (SPAN + (", " + BASES if bases else "")).split(", ")]

    def batch_of(parts: list[dict]) -> pa.RecordBatch:
        merged = {n: [x for p in parts for x in p[n]] for n in names}
        types = {"frame": pa.int32(), "gc": pa.float64()}
        text = {"strand", "start_codon", "stop_codon", "seqid", "dna_seq", "rna_seq", "protein"}
        return pa.RecordBatch.from_arrays(
            [pa.array(merged[n], pa.string() if n in text else types.get(n, pa.int64())) for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for record, seqid, length, number, txt in zip(*(c.to_pylist() for c in batch.columns)):
                if length < 3:
                    continue
                for strand, whole, scan in _both(txt, number, tile, length, kinds):
                    rna = amino = None
                    for frame, starts, stops in scan.frames():
                        before = np.concatenate([[-1], stops[:-1]])[:len(stops)]
                        k = np.searchsorted(starts, before, "right")
                        found = np.flatnonzero((k < len(starts)) & (np.append(starts, 1 << 62)[k] < stops)
                                               & (whole | (before >= 0)))
                        a, z = starts[k[found]], stops[found]
                        enough = (z + 3 - a) >= least
                        a, z = a[enough], z[enough]
                        if not len(a):
                            continue
                        n, first, last = z + 3 - a, a + scan.at, z + scan.at
                        part = {"record_no": [record] * len(a), "strand": [strand] * len(a), "frame": [frame] * len(a),
                                "start": first.tolist(), "stop": last.tolist(),
                                "start_codon": [_CODONS[c] for c in scan.codon[a].tolist()],
                                "stop_codon": [_CODONS[c] for c in scan.codon[z].tolist()]}
                        if bases:
                            rna = rna or scan.txt.translate(_RNA)
                            amino = amino or _AMINO[scan.codon].tobytes().decode("ascii")
                            spans = list(zip(a.tolist(), (z + 3).tolist()))
                            part |= {"seqid": [seqid] * len(a),
                                     "start_1b": (first + 1 if strand == "+" else length - last - 2).tolist(),
                                     "end_1b": (last + 3 if strand == "+" else length - first).tolist(),
                                     "nt_len": n.tolist(), "aa_len": (n // 3).tolist(),
                                     "gc": ((scan.gc[z + 3] - scan.gc[a]) / n).tolist(),
                                     "dna_seq": [scan.txt[i:j] for i, j in spans], "rna_seq": [rna[i:j] for i, j in spans],
                                     "protein": [amino[i:j - 3:3] for i, j in spans]}
                        parts.append(part)
                        size += len(a)
                if size >= FLUSH:
                    yield batch_of(parts)
                    parts, size = [], 0
        if size:
            yield batch_of(parts)
    return run


def _edges(tile: int, allow_alt: bool):
    """Tiles -> what each strand and frame takes from the tiles before and leaves to those after."""
    kinds = _classes(allow_alt)
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[t])
                        for n, t in (x.split() for x in EDGE.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for record, seqid, length, number, txt in zip(*(c.to_pylist() for c in batch.columns)):
                for strand, whole, scan in _both(txt, number, tile, length, kinds):
                    for frame, starts, stops in scan.frames():
                        stop = int(stops[0]) if len(stops) else None
                        head = int(starts[0]) if len(starts) and stop is not None and starts[0] < stop else None
                        k = int(np.searchsorted(starts, stops[-1])) if len(stops) else 0
                        left = int(starts[k]) if k < len(starts) else None
                        at = lambda x: None if x is None else x + scan.at  # noqa: E731, B023
                        name = lambda x: None if x is None else scan.name(x)  # noqa: E731, B023
                        rows.append(dict(zip(schema.names, (
                            record, seqid, strand, frame, number if strand == "+" else -number, length, stop is not None, whole,
                            at(head), name(head), at(stop), name(stop), at(left), name(left)))))
            yield from pa.Table.from_pylist(rows, schema).to_batches()
    return run


def _crossing(tiles: DataFrame, allow_alt: bool, tile: int) -> DataFrame:
    """ORFs of records with several tiles that start in one tile and stop in another (or whose start the tiles before decide)."""
    edges = tiles.where(F.col("seq_len") > tile).mapInArrow(_edges(tile, allow_alt), EDGE)
    key = ["record_no", "strand", "frame"]
    order = Window.partitionBy(*key).orderBy("tile")  # one row for each tile of a record
    group = Window.partitionBy(*key, "grp").orderBy("tile").rowsBetween(Window.unboundedPreceding, 0)
    left = F.when(F.col("tail_start").isNotNull(), F.struct(F.col("tail_start").alias("pos"), F.col("tail_codon").alias("codon")))
    head = F.when(F.col("head_start").isNotNull(), F.struct(F.col("head_start").alias("pos"), F.col("head_codon").alias("codon")))
    open_after = edges.withColumn("grp", F.sum(F.col("has_stop").cast("int")).over(order)).withColumn(
        "open", F.first(left, ignorenulls=True).over(group))
    known = open_after.withColumn("begin", F.coalesce(F.lag("open").over(order), head))
    return known.where("has_stop AND NOT first AND begin IS NOT NULL").select(
        *key, F.col("begin.pos").alias("start"), F.col("head_stop").alias("stop"), F.col("begin.codon").alias("start_codon"),
        "stop_codon", "seqid", "seq_len")


def orf_spans(seqs: DataFrame, allow_alt: bool = True, tile: int = DEFAULT_TILE) -> DataFrame:
    """ORFs as strand coordinates: record_no, strand, frame, start, stop, start_codon, stop_codon.

    ``start``/``stop`` are 0-based positions on the scanned strand of the
    first base of the start and of the stop codon.
    """
    tiles = cut_lineage(strand_tiles(seqs, tile))
    return tiles.mapInArrow(_scan(tile, allow_alt, 0, False), SPAN).unionByName(
        _crossing(tiles, allow_alt, tile).drop("seqid", "seq_len"))


ORF = ["record_no", "seqid", "strand", "frame", "start_1b", "end_1b", "nt_len", "aa_len", "start_codon", "stop_codon", "gc",
       "dna_seq", "rna_seq", "protein"]


def find_orfs(seqs: DataFrame, allow_alt: bool = True, min_aa: int = 0,
              tile: int = DEFAULT_TILE) -> DataFrame:
    """W1 + F1-F6 + P12: the 13 ORF attributes per ORF.

    Input: record_no, seqid, seq (already cleaned).  Coordinates are 1-based
    inclusive on the + strand; ``frame`` is the offset on the scanned strand.
    Output: record_no, seqid, strand, frame, start_1b, end_1b, nt_len, aa_len,
    start_codon, stop_codon, gc, dna_seq, rna_seq, protein.  Letters that are no
    base stay in the ORF's bases.
    """
    tiles = cut_lineage(strand_tiles(seqs, tile))
    inside = tiles.mapInArrow(_scan(tile, allow_alt, min_aa, True), SPAN + ", " + BASES).select(*ORF)
    nt = (F.col("stop") + 3 - F.col("start")).alias("nt_len")
    plus = F.col("strand") == "+"
    spans = _crossing(tiles, allow_alt, tile).select("*", nt).where(F.floor(F.col("nt_len") / 3) >= max(1, int(min_aa)))
    spans = spans.withColumn("lo", F.when(plus, F.col("start")).otherwise(F.col("seq_len") - F.col("stop") - 3))
    spans = spans.withColumn("hi", F.col("lo") + F.col("nt_len"))
    # the bases of crossing ORFs, from the tiles they span
    parts = spans.withColumn("tile", F.explode(F.sequence(F.floor(F.col("lo") / tile), F.floor((F.col("hi") - 1) / tile))))
    own = tiles.where(F.col("seq_len") > tile).select("record_no", "tile", "txt")
    t0 = F.col("tile") * tile
    start = F.greatest(F.col("lo"), t0) - F.greatest(t0 - MARGIN, F.lit(0))
    parts = parts.join(own, ["record_no", "tile"]).withColumn("piece", F.substring(
        "txt", (start + 1).cast("int"), (F.least(F.col("hi"), t0 + tile) - F.greatest(F.col("lo"), t0)).cast("int")))
    key = ["record_no", "seqid", "strand", "frame", "lo", "hi", "nt_len", "start_codon", "stop_codon"]
    whole = parts.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tile", "piece"))),
                                                             lambda x: x["piece"]), "").alias("txt"))
    whole = whole.withColumn("dna_seq", F.when(plus, F.col("txt")).otherwise(dna.reverse_complement(F.col("txt"))))
    return inside.unionByName(whole.select(
        "record_no", "seqid", "strand", "frame", (F.col("lo") + 1).alias("start_1b"), F.col("hi").alias("end_1b"), "nt_len",
        F.floor(F.col("nt_len") / 3).cast("bigint").alias("aa_len"), "start_codon", "stop_codon",
        dna.gc_fraction(F.col("dna_seq")).alias("gc"), "dna_seq", dna.to_rna(F.col("dna_seq")).alias("rna_seq"),
        dna.translate_expr("dna_seq").alias("protein")))


def count_orfs(seqs: DataFrame, allow_alt: bool = True, tile: int = DEFAULT_TILE) -> DataFrame:
    """ORFs per sequence, those without any kept with 0, from one pass over the tiles: record_no, seqid, seq_len, n_orfs."""
    tiles = cut_lineage(strand_tiles(seqs, tile))
    found = tiles.mapInArrow(_scan(tile, allow_alt, 0, False), SPAN).select("record_no", F.lit(1).alias("n")).union(
        _crossing(tiles, allow_alt, tile).select("record_no", F.lit(1))).groupBy("record_no").agg(F.sum("n").alias("n_orfs"))
    return tiles.where("tile = 0").select("record_no", "seqid", "seq_len").join(found, "record_no", "left").select(
        "record_no", "seqid", "seq_len", F.coalesce("n_orfs", F.lit(0)).cast("bigint").alias("n_orfs"))


def orf_summary(orfs: DataFrame) -> DataFrame:
    """printable summary fields per ORF."""
    prot = F.col("protein")
    preview = F.when(F.length(prot) == 0, F.lit("-")).otherwise(
        F.concat(F.substring(prot, 1, 15), F.when(F.length(prot) > 15, F.lit("…")).otherwise(F.lit(""))))
    return orfs.select(
        "record_no", "seqid", "strand", "frame",
        F.concat_ws("..", F.col("start_1b").cast("string"), F.col("end_1b").cast("string")).alias("coords"),
        "nt_len", "aa_len", "start_codon", "stop_codon",
        F.bround(F.col("gc") * 100, 1).alias("gc_pct"),
        F.when(F.length(prot) == 0, F.lit("-")).otherwise(F.substring(prot, 1, 1)).alias("protein_start"),
        preview.alias("protein_preview"),
    )


def orf_counts(seqs: DataFrame, orfs: DataFrame) -> DataFrame:
    """ORFs reported per sequence; sequences without ORFs kept with 0."""
    per = orfs.groupBy("record_no").agg(F.count(F.lit(1)).alias("n_orfs"))
    return (seqs.select("record_no", "seqid", F.length("seq").cast("bigint").alias("seq_len"))
            .join(per, "record_no", "left")
            .select("record_no", "seqid", "seq_len", F.coalesce("n_orfs", F.lit(0)).cast("bigint").alias("n_orfs")))


def orf_fasta_records(orfs: DataFrame) -> DataFrame:
    """S8 body: pipe-joined header and the RNA wrapped at 60 columns."""
    header = F.concat(
        F.lit(">"), F.col("seqid"), F.lit("|strand:"), F.col("strand"),
        F.lit("|frame:"), F.col("frame").cast("string"),
        F.lit("|coords:"), F.col("start_1b").cast("string"), F.lit(".."), F.col("end_1b").cast("string"),
        F.lit("|len_nt:"), F.col("nt_len").cast("string"), F.lit("|len_aa:"), F.col("aa_len").cast("string"),
        F.lit("|start:"), F.col("start_codon"), F.lit("|stop:"), F.col("stop_codon"))
    return orfs.select("record_no", "start_1b", "end_1b", "strand", "frame",
                       header.alias("header"), dna.wrap60(F.col("rna_seq")).alias("body"))
