"""SimHash near-dedup by a segment-popcount embedding.

Each 64-bit fingerprint maps to the vector of bit counts of its segments.  One
differing bit changes one count by one, so the Manhattan distance of two
vectors is a lower bound of the Hamming distance of the fingerprints.  The grid
range-join: vectors at Manhattan distance 2 or less share a lattice point at
distance 1 or less from both, so every fingerprint enters the cells at distance
0 and 1 and meets its candidates there.  Candidates are verified on the
fingerprints themselves.  Exact copies are folded before, so work depends on
distinct fingerprints only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.common import attach, cut_lineage, numbered, row_key
from locuspark.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEGMENT_BITS = 2
HOT_CELL = 256
SEED = 42


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit SimHash as a signed integer; 0 for a text without words.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space
    (0x20, 0x09-0x0D, which is what ``bytes.split`` cuts at).
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:1 - width or None].tolist(),
                                                            ends[width - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[i:i + (1 << 14)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def _fingerprints(width: int):
    """Replace the last column, the text, by its fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", width) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.int64())],
                                             [*batch.schema.names[:-1], "fp"])
    return run


def _cells(prints: DataFrame, bits: int) -> DataFrame:
    """(cell, fp): the lattice point of each popcount vector and all points one step away.

    A cell is the vector in mixed radix, so two vectors share it only if equal.
    """
    n, radix = 64 // bits, bits + 1
    count = f"bit_count(shiftrightunsigned(fp, {{i}}) & {(1 << bits) - 1}L)"
    home = " + ".join(f"{count.format(i=i * bits)} * {radix ** i}L" for i in range(n))
    powers = "array(" + ", ".join(f"{radix ** i}L" for i in range(n)) + ")"
    homes = prints.select("fp", F.expr(home).alias("home"))  # below the explode, so computed once per print
    steps = homes.select("fp", "home", F.explode(F.expr(f"sequence(-1, {2 * n - 1})")).alias("s"))
    here = count.format(i=f"CAST({bits} * (s div 2) AS INT)")
    step = f"element_at({powers}, CAST(s div 2 AS INT) + 1)"
    cell = F.expr(f"CASE WHEN s = -1 THEN home WHEN s % 2 = 0 AND {here} < {bits} THEN home + {step} "
                  f"WHEN s % 2 = 1 AND {here} > 0 THEN home - {step} END")
    return steps.select(cell.alias("cell"), "fp").where("cell IS NOT NULL")


def _links(prints: DataFrame, max_bits: int, bits: int, hot: int) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints that differ in at most ``max_bits`` bits."""
    full = Window.partitionBy("cell")
    shared = cut_lineage(_cells(prints, bits).withColumn("n", F.count(F.lit(1)).over(full)).where("n > 1"))
    usual = shared.where(F.col("n") <= hot)
    a = usual.select("cell", F.col("fp").alias("u"))
    b = usual.select("cell", F.col("fp").alias("v"))
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = a.join(b, "cell").where((F.col("u") < F.col("v")) & (differ <= max_bits)).select("u", "v").distinct()
    # Full cells: prints at 2 bits or less share a word at 1 bit or less, and such a word proves the link.
    crowded = shared.where(F.col("n") > hot).select("fp").distinct()
    if max_bits == 2:
        near = F.expr("sequence(-1, 63)")
        word = F.expr("CASE WHEN s = -1 THEN fp ELSE fp ^ shiftleft(1L, s) END")
    elif max_bits == 1:  # of two words at one bit, one has even parity
        near = F.expr("sequence(-1, 63)")
        word = F.expr("CASE WHEN s = -1 AND bit_count(fp) % 2 = 0 THEN fp "
                      "WHEN s >= 0 AND bit_count(fp) % 2 = 1 THEN fp ^ shiftleft(1L, s) END")
    else:
        return pairs
    meet = crowded.withColumn("s", F.explode(near)).select("fp", word.alias("word")).where("word IS NOT NULL")
    if max_bits == 1:  # joined through the odd print and its even word, where that word is itself a print
        evens = crowded.where("bit_count(fp) % 2 = 0").select(F.col("fp").alias("word"))
        odd = meet.where("fp != word").join(evens, "word").select(F.col("fp").alias("u"), F.col("word").alias("v"))
        return pairs.union(odd)
    low = meet.groupBy("word").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = meet.join(low, "word").where("fp != v").select(F.col("fp").alias("u"), "v").distinct()
    return pairs.union(star)


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                       max_bits: int = MAX_BITS, segment_bits: int = SEGMENT_BITS, hot: int = HOT_CELL,
                       with_key: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, keep`` (and ``row_key``, if asked for).

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` (0, 1 or 2) differing bits; null ids are passed over, and a
    component without any id has a null component_id.  ``keep`` marks one row
    of each component: the smallest id, and of rows with the same id the first
    in table order.  Null and empty texts have fingerprint zero and link like
    any other.  Extra columns are ignored; an empty table gives an empty
    result.  Cells with more than ``hot`` fingerprints do not form pairs: their
    members link through shared one-bit neighbours, which finds the same links.
    """
    if max_bits not in (0, 1, 2) or segment_bits not in (2, 4, 8):
        raise ValueError("max_bits must be 0, 1 or 2 and segment_bits 2, 4 or 8")
    key = [row_key(F.col(id_col), F.col(text_col)).alias("row_key")] if with_key else []
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), *key, F.col(text_col).cast("string").alias("text"))
    rows = numbered(slim.mapInArrow(_fingerprints(width), "doc_id long, row_key string, fp long" if with_key
                                    else "doc_id long, fp long"))
    first = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "rid")
    prints = cut_lineage(rows.groupBy("fp").agg(F.min(first).alias("first")))
    if max_bits:
        comps = connected_components(_links(prints.select("fp"), max_bits, segment_bits, hot))
        prints = prints.join(comps, prints.fp == comps.node, "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component"))
    else:
        prints = prints.withColumn("component", F.col("fp"))
    firsts = prints.groupBy("component").agg(F.min("first").alias("first"))
    values = prints.select("fp", "component").join(firsts, "component").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("keep_rid"))
    return attach(rows, values, ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("rid") == F.col("keep_rid")).alias("keep"), *["row_key"] * with_key)
