"""Substring dedup: Rabin-Karp hashes of every token window, counted in Spark.

Scan 1 (Arrow batches) rolls a polynomial hash over the word hashes of each
text and packs the hashes of a batch of documents by their top bits: one row per
(bucket, batch), 8 bytes of hash and 2 bytes of position step per window; of
windows that the batch holds several times, whose fate is settled, only the hash
once.  The bits of the bucket number are not stored, so 64 stored bits and the bucket
together are a hash of 74 to 84 bits.  Each bucket counts its hashes; windows
that other batches hold too return as positions to the documents of their batch,
where they merge into maximal intervals of words.  Scan 2 joins the intervals
to the texts and removes the words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import row_key

WINDOW = 35
BATCH_WORDS = 2_000_000  # words packed together; bounds the memory of a task
BUCKET_WINDOWS = 1_000_000  # windows aimed at in one bucket
MIN_BUCKET_BITS, MAX_BUCKET_BITS = 10, 20  # the latter reached at some 6 TB of text; beyond, buckets grow
ROW_WINDOWS = 16  # windows of a batch in a bucket, on average, at least: larger batches where buckets are many
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers, invertible modulo 2**64
PACK_SCHEMA = "bucket int, batch string, hashes binary, steps binary, seen binary"
KEY_CACHE = 1_000_000


class _WordHash(dict):
    """Cache of word -> 64-bit hash, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEY_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RollingHash:
    """Hashes of all windows of ``width`` words: prefix sums of a polynomial modulo 2**64, for two bases."""

    def __init__(self, width: int):
        self.width, self.tables = width, [_powers(b, 1 << 14) for b in BASE]

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, out = len(hashes), []
        if n < self.width:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        if n > len(self.tables[0][0]):
            self.tables = [_powers(b, 2 * n) for b in BASE]
        for up, down in self.tables:
            prefix = np.zeros(n + 1, np.uint64)
            np.cumsum(hashes * up[:n], out=prefix[1:])
            out.append(_mix((prefix[self.width:] - prefix[:-self.width]) * down[:n - self.width + 1]))
        return out[0], out[1]


def _member(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``some``."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _pack(batch: str, first: np.ndarray, second: np.ndarray, bits: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Sort one batch's windows into buckets, each distinct one once; and the positions that the batch itself decides.

    A window that the batch holds more than once is decided here: only its hash goes on (``seen``), for other batches to
    meet.  The others go with their positions as 2-byte steps (a wide gap takes several).
    """
    bucket = (second >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)  # 2 bytes sort by radix
    values = np.sort(first)
    twice = np.unique(values[1:][values[1:] == values[:-1]])  # the only ones that can be repeats: few, as a rule
    maybe = np.flatnonzero(_member(first, twice))
    ranked = maybe[np.lexsort((first[maybe], bucket[maybe]))]
    key, home = first[ranked], bucket[ranked]
    same = (key[1:] == key[:-1]) & (home[1:] == home[:-1])
    again = np.zeros(len(ranked), bool)
    again[1:] |= same
    again[:-1] |= same
    heads = np.flatnonzero(again & np.concatenate(([True], ~same))[:len(again)])
    single = np.ones(len(first), bool)
    single[ranked[again]] = False
    seen, seen_home = key[heads], home[heads]
    once = np.flatnonzero(single)
    once = once[np.argsort(bucket[once], kind="stable")]
    used = np.unique(bucket)
    cuts, seen_cuts = ([np.searchsorted(x, used, side) for side in ("left", "right")] for x in (bucket[once], seen_home))
    rows = ([], [], [], [], [])
    for b, lo, hi, seen_lo, seen_hi in zip(used.tolist(), *cuts, *seen_cuts):
        at = once[lo:hi]
        steps = np.diff(at, prepend=0)
        if steps.max(initial=0) < 0xFFFF:
            codes = steps.astype(np.uint16)
        else:  # a wide step is one 0xFFFF for each full 65,535, then the rest
            full, rest = np.divmod(steps, 0xFFFF)
            codes = np.full(int(full.sum()) + len(steps), 0xFFFF, np.uint16)
            codes[np.cumsum(full + 1) - 1] = rest
        for column, value in zip(rows, (b, batch, first[at].tobytes(), codes.tobytes(), seen[seen_lo:seen_hi].tobytes())):
            column.append(value)
    packed = pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.string()),
                                         *[pa.array(x, pa.binary()) for x in rows[2:]]],
                                        ["bucket", "batch", "hashes", "steps", "seen"])
    return packed, np.flatnonzero(~single).astype(np.uint32)


def _positions(codes: bytes) -> np.ndarray:
    """Undo the step coding of :func:`_pack`."""
    steps = np.frombuffer(codes, np.uint16).astype(np.int64)
    return np.cumsum(steps)[steps != 0xFFFF]


def _scan(width: int, bits: int, batch_words: int):
    """Pack windows; the directory of a batch (row keys, window counts, decided positions) goes out under a negative bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash, roll = _WordHash(), RollingHash(width)
        keys, counts, firsts, seconds, held = [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not keys:
                return
            joined, sizes = "".join(keys).encode(), np.array(counts, np.int64).tobytes()
            name = hashlib.md5(joined + sizes + str(part).encode()).hexdigest()
            packed, decided = _pack(name, np.concatenate(firsts), np.concatenate(seconds), bits)
            yield pa.RecordBatch.from_arrays([pa.array([-1 - int(name[:3], 16)], pa.int32()), pa.array([name]),
                                              *[pa.array([x], pa.binary()) for x in (joined, sizes, decided.tobytes())]],
                                             packed.schema.names)
            yield packed

        part = None
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for part_no, key, text in zip(batch.column(0), batch.column(1), texts):
                part = part_no.as_py() if part is None else part
                words = (text.as_py() or b"").split()
                if len(words) < width:
                    continue
                a, b = roll(np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words)))
                keys.append(key.as_py())
                counts.append(len(a))
                firsts.append(a)
                seconds.append(b)
                held += len(a)
                if held >= batch_words:
                    yield from flush()
                    part += 1 << 32
                    keys, counts, firsts, seconds, held = [], [], [], [], 0
        yield from flush()
    return run


FOUND_SCHEMA = "batch string, data binary, sizes binary"


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: for each batch, the positions sent along whose hash another batch has too.

    A batch sends a hash once at most, so a hash that is in every text costs 8 bytes a batch.
    Directories (negative buckets) pass through, with the positions that their batch decided; only they have ``sizes``.
    """
    if table.column("bucket")[0].as_py() < 0:
        heads = table.select(["batch", "hashes", "steps"]).rename_columns(["batch", "data", "sizes"])
        own = pa.table({"batch": table.column("batch"), "data": table.column("seen"), "sizes": pa.nulls(table.num_rows, pa.binary())})
        return pa.concat_tables([heads, own])
    names, packs = table.column("batch").to_pylist(), table.column("hashes").to_pylist()
    hashes = np.concatenate([np.frombuffer(p, np.uint64) for p in [*packs, *table.column("seen").to_pylist()]])
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    out, at = ([], []), 0
    for name, pack, codes in zip(names, packs, table.column("steps").to_pylist()):
        flags = again[at:at + len(pack) // 8]
        at += len(pack) // 8
        if flags.any():
            out[0].append(name)
            out[1].append(_positions(codes)[flags].astype(np.uint32).tobytes())
    return pa.table({"batch": pa.array(out[0], pa.string()), "data": pa.array(out[1], pa.binary()),
                     "sizes": pa.nulls(len(out[0]), pa.binary())})


def intervals_of(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal word intervals covered by windows at the sorted ``starts``."""
    cut = np.flatnonzero(np.diff(starts) > width)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(),
                    (starts[np.concatenate((cut, [len(starts) - 1]))] + width).tolist()))


def _to_documents(width: int):
    def run(table: pa.Table) -> pa.Table:
        data, sizes = table.column("data").to_pylist(), table.column("sizes").to_pylist()
        head = next(i for i, x in enumerate(sizes) if x is not None)
        keys, sizes = data.pop(head), np.frombuffer(sizes[head], np.int64)
        hits = [np.frombuffer(x, np.uint32) for x in data if x]
        out = ([], [])
        if hits:
            starts = np.sort(np.concatenate(hits)).astype(np.int64)
            ends = np.cumsum(sizes)
            doc = np.searchsorted(ends, starts, side="right")
            for d in np.unique(doc).tolist():
                own = starts[np.searchsorted(doc, d):np.searchsorted(doc, d, side="right")]
                out[0].append(keys[32 * d:32 * d + 32].decode())
                out[1].append(intervals_of(own - (ends[d] - sizes[d]), width))
        return pa.table({"row_key": pa.array(out[0], pa.string()),
                         "cut": pa.array([[{"s": s, "e": e} for s, e in x] for x in out[1]],
                                         pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))})
    return run


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW,
                       batch_words: int = BATCH_WORDS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``row_key, cut``: for each row with something to remove, its maximal word intervals [s, e)."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = min(max(math.ceil(math.log2(max(size / 6 / bucket_windows, 1))), MIN_BUCKET_BITS), MAX_BUCKET_BITS)
    batch_words = batch_words if bits <= 16 else max(batch_words, ROW_WINDOWS << bits)
    # in the order of the keys, so that a task that is run again after a shuffle makes the same batches
    slim = docs.select(F.spark_partition_id().alias("part"), row_key(F.col(id_col), F.col(text_col)).alias("k"),
                       F.col(text_col).cast("string").alias("text")).sortWithinPartitions("k")
    packed = slim.mapInArrow(_scan(width, bits, batch_words), PACK_SCHEMA)
    found = packed.groupBy("bucket").applyInArrow(_repeated, FOUND_SCHEMA)
    return found.groupBy("batch").applyInArrow(
        _to_documents(width), "row_key string, cut array<struct<s: bigint, e: bigint>>").dropDuplicates(["row_key"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, cut in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
            words = (text.as_py() or b"").split()
            n_words.append(len(words))
            at, parts = 0, []
            for c in cut.as_py() or ():
                parts += words[at:c["s"]]
                at = c["e"]
            parts += words[at:]
            n_removed.append(len(words) - len(parts))
            kept.append(b" ".join(parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW,
                    batch_words: int = BATCH_WORDS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text``.

    Words are runs of characters other than space and 0x09-0x0D.  A word goes
    if a window of ``width`` words covers it whose word sequence also starts
    anywhere else, in the same text or another; windows are judged on the
    input.  Kept words are joined by one space.  Null and empty texts and texts
    of fewer than ``width`` words lose nothing (null gives the empty text).
    Repeated rows are copies of each other.  Extra columns are ignored.
    """
    cuts = repeated_intervals(docs, id_col, text_col, width, batch_words, bucket_windows)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       row_key(F.col(id_col), F.col(text_col)).alias("row_key"))
    return slim.join(cuts, "row_key", "left").select("doc_id", "text", "cut").mapInArrow(
        _strip, "doc_id long, n_words long, n_removed long, kept_text string")
