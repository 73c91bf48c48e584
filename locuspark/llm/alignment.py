"""Alignment of two tokenizers over a corpus, with pair counts by external spill counting.

Each text is encoded by A (byte-level BPE, of a space and the text) and B (a piece
model, which adds that space itself).  A link is a pair of an A and a B token whose
bytes overlap; a pair of ids counts its links over all texts.

1. Each task aligns its texts and sorts their pair-document records (B id, A id, row,
   links) by side B, then A.  Records are radix-partitioned by B id and written to the shared
   folder as zstd runs; a run covers some 8 MB of text.  A run keeps its distinct pairs with
   their sums apart from its rows, so that only one entry for each pair and run travels.
2. Runs of one partition meet in groups of some 64, and a k-way heap merge sums the pairs of
   each group; its output is a run of the next level, until one run is left.  The last merge
   sees all pairs of a B id together, and so knows each id's largest count.
3. The totals stream through the runs once more: each run's rows receive the counts of their pairs.

A pair that is in every text is one entry of each run.  What a task holds is bounded by the size
of a run, and for the totals by the two vocabularies; totals are repeated once for each group of runs.

Both encoders treat what stands between a character that is no space and a space alike (checked
against the two files), so a text is cut there and a piece that has been seen is not encoded again.
Where the files do not allow it, texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm.common import cut_lineage, no_null, shared_path

TOKENIZERS = "/opt/tokenizers"
RADIX = 16  # partitions by B id
RUN_BYTES = 8 << 20  # characters of text in a run; one longer text is a run of its own
FAN = 64  # runs merged at once, on average
CACHE_CHARS = 72 << 20  # characters of pieces that a worker remembers, each with
ENTRY = 128  # characters' worth of what is kept beside them: some 500,000 words, 150 MB
AT_ONCE = 1 << 20  # characters of text that are cut and looked up together
TOGETHER = 1 << 16  # characters of new pieces that are encoded as one text
BLOCK = 8192  # entries read at once from a run
SPACE = "▁"  # stands for a space in pieces
NO_CUT = "᠎"  # a space in older tables only
SPACES = re.compile(rf"(?:^|[\s{NO_CUT}]) ")  # where a space follows another


# ---------------------------------------------------------------- encoders and pieces of text
def _byte_of() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Two encoders, and what is known of pieces: tokens, groups and linked pairs of each."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = _byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.b_space = self.b.piece_to_id(SPACE)
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        written = lambda side, mark: np.array([f"{i}{mark}" for i in range(len(side))], object)
        self.a_more, self.a_last = written(self.a_bytes, ","), written(self.a_bytes, "|")
        self.b_more, self.b_last, self.b_end = (written(self.b_bytes, mark) for mark in ",;\n")
        self.cuts = self._may_cut(json.loads(a_json), pieces)
        self._forget()

    def _may_cut(self, a: dict, pieces: list[str]) -> bool:
        """Whether no token of A or B can reach over a cut, and neither encoder changes the text."""
        split = a.get("pre_tokenizer") or {}
        by_words = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        inside = any(SPACE in p.lstrip(SPACE) for p in pieces)
        kept = self.b.encode(" x  y ", out_type=str)
        return bool(by_words and not a.get("normalizer") and not inside and not self.b.is_unknown(self.b_space)
                    and "".join(kept) == SPACE * 2 + "x" + SPACE * 2 + "y" + SPACE)

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.n_a, self.n_b, self.n_groups, self.good = (array("q") for _ in range(4))
        self.groups: list[str] = []
        self.first, self.pair = array("q", [0]), array("q")  # links of piece i: first[i] to first[i + 1]

    def make_room(self) -> None:
        """Between runs, since a run's numbers must stay."""
        if self.chars > CACHE_CHARS:
            self._forget()

    def pieces(self, text: str) -> list[str]:
        """A space and the text, cut before spaces that follow a character that is none."""
        if not self.cuts:
            return [" " + text]
        if not SPACES.search(text):
            return [" " + word for word in text.split(" ")]
        out, held = [], ""
        for word in text.split(" "):
            held += " " + word
            if word and not word[-1].isspace() and word[-1] != NO_CUT:
                out.append(held)
                held = ""
        return out + [held] if held else out

    def learn(self, texts: list[list[str]]) -> None:
        """Encode and align the pieces of several texts that are new; those that may stand together are encoded as one text."""
        known = self.number
        new = list(dict.fromkeys([p for pieces in texts for p in pieces if p not in known]))
        held, size = [], 0
        for piece in new:
            if not self.cuts or piece[-1].isspace() or piece[-1] == NO_CUT:
                self._learn([piece])
                continue
            held.append(piece)
            size += len(piece)
            if size >= TOGETHER:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)

    def _learn(self, pieces: list[str]) -> None:
        text = "".join(pieces)
        raw = text.encode()
        a_ids = self.a.encode(text, add_special_tokens=False).ids
        b_ids = [self.b_space] if text == " " else self.b.encode(text[1:], num_threads=1)
        ends = np.cumsum([len(p.encode()) for p in pieces])
        same = b"".join([self.a_bytes[i] for i in a_ids]) == raw == b"".join([self.b_bytes[i] for i in b_ids])
        if same:
            a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
            a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
            in_a, in_b = (np.zeros(len(raw) + 1, bool) for _ in range(2))
            in_a[a_end], in_b[b_end] = True, True
            both = in_a & in_b
            same = bool(both[ends].all())
        if not same:
            if len(pieces) > 1:
                for piece in pieces:
                    self._learn([piece])
            else:
                self._keep(pieces, np.zeros((4, 1), np.int64), [""], np.empty(0, np.int64), False)
            return
        cut, shared = np.flatnonzero(in_a | in_b), np.flatnonzero(both)
        code = b_ids[np.searchsorted(b_end, cut)] << 32 | a_ids[np.searchsorted(a_end, cut)]
        counts = np.diff(np.stack([np.searchsorted(x, ends, "right") for x in (a_end, b_end, shared, cut)]), prepend=0, axis=1)
        # the ids as text, group by group: A's, then B's
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        closes = np.zeros(len(raw) + 1, bool)
        closes[ends] = True
        words = np.empty(len(a_ids) + len(b_ids), object)
        words[np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left")] = np.where(
            both[a_end], self.a_last[a_ids], self.a_more[a_ids])
        words[np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")] = np.where(
            closes[b_end], self.b_end[b_ids], np.where(both[b_end], self.b_last[b_ids], self.b_more[b_ids]))
        self._keep(pieces, counts, "".join(words.tolist()).split("\n")[:-1], code, True)

    def _keep(self, pieces: list[str], counts: np.ndarray, groups: list[str], code: np.ndarray, good: bool) -> None:
        start = len(self.good)
        self.number.update(zip(pieces, range(start, start + len(pieces))))
        self.chars += sum(map(len, pieces)) + ENTRY * len(pieces)
        for column, values in ((self.n_a, counts[0]), (self.n_b, counts[1]), (self.n_groups, counts[2]),
                               (self.good, np.full(len(pieces), int(good))), (self.pair, code),
                               (self.first, self.first[-1] + np.cumsum(counts[3]))):
            column.frombytes(np.ascontiguousarray(values, np.int64).tobytes())
        self.groups += groups


_held: dict[str, Aligner] = {}


def _aligner(files) -> Aligner:
    """The worker's aligner for the two broadcast files; a reused worker keeps it, and its pieces, between tasks."""
    a_json, b_model = files.value
    key = hashlib.md5(a_json.encode() + b_model).hexdigest()
    if key not in _held:
        _held.clear()
        _held[key] = Aligner(a_json, b_model)
    return _held[key]


# ---------------------------------------------------------------- runs
def _packed(*columns: np.ndarray) -> bytes:
    """Columns one after the other, each with its length, as a zstd frame."""
    head = np.array([len(c) for c in columns], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(c.tobytes() for c in columns))


def _unpacked(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=0)
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


def _gaps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _entries_blob(codes, counts) -> bytes:
    """A run of (code, count), sorted by code, to be read as a stream."""
    both = np.empty((len(codes), 2), np.uint64)
    both[:, 0], both[:, 1] = codes, counts
    return zstandard.ZstdCompressor(level=3).compress(both.tobytes())


def _entries(blob: bytes) -> Iterator[tuple[int, int]]:
    """The entries of a run, decompressed block by block."""
    with zstandard.ZstdDecompressor().stream_reader(blob) as reader:
        while block := reader.read(16 * BLOCK):
            while len(block) % 16:
                block += reader.read(16 - len(block) % 16)
            yield from zip(*np.frombuffer(block, np.uint64).reshape(-1, 2).T.tolist())


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places starts[i] .. starts[i] + sizes[i] - 1, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


DOC = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string")]
SPILL = ("run long, radix int, row int, doc_id long, " + ", ".join(f"{n} {t}" for n, t in DOC) + ", pairs binary, rows binary")
_SPILL = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("row", pa.int32()), ("doc_id", pa.int64())] +
                   [(n, pa.int64() if t == "long" else pa.string()) for n, t in DOC] +
                   [("pairs", pa.binary()), ("rows", pa.binary())])


@dataclass
class _Run:
    """Documents of a run until it is written."""

    aligner: Aligner
    radix: int
    size: int = 0

    def __post_init__(self):
        self.docs: list[dict] = []
        self.flat, self.owner = array("q"), array("q")
        self.waiting: list[tuple[int, str]] = []
        self.unread = 0

    def add(self, doc_id, text: str) -> None:
        self.docs.append({"doc_id": doc_id, "row": len(self.docs), "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0,
                          "groups_sha256": ""})
        self.size += len(text)
        if text:
            self.waiting.append((len(self.docs) - 1, text))
            self.unread += len(text)
            if self.unread >= AT_ONCE:
                self.read()

    def read(self) -> None:
        """Align the waiting texts."""
        al = self.aligner
        texts = [al.pieces(text) for _, text in self.waiting]
        al.learn(texts)
        known, word = al.number.__getitem__, al.groups.__getitem__
        first, columns = np.array(al.first), {c: np.array(getattr(al, c)) for c in ("n_a", "n_b", "n_groups", "good")}
        for (row, _), pieces in zip(self.waiting, texts):
            numbers = list(map(known, pieces))
            own = np.array(numbers)
            if not columns["good"][own].all():
                continue
            groups = ";".join(map(word, numbers))
            self.docs[row] |= {c: int(columns[c][own].sum()) for c in ("n_a", "n_b", "n_groups")} | {
                "n_links": int((first[own + 1] - first[own]).sum()),
                "groups_sha256": hashlib.sha256(groups.encode()).hexdigest()}
            self.flat.frombytes(own.tobytes())
            self.owner.frombytes(np.full(len(own), row).tobytes())
        self.waiting, self.unread = [], 0

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes of distinct pairs, rows of each, row, links): sorted by code, then row."""
        rows = len(self.docs)
        key, seen = np.unique(np.array(self.flat) * rows + np.array(self.owner), return_counts=True)
        piece, row = key // rows, key % rows
        first = np.array(self.aligner.first)
        sizes = first[piece + 1] - first[piece]
        # pairs get dense numbers in order of their codes, once for each piece of the run
        used, own = np.unique(piece, return_inverse=True)
        spans = first[used + 1] - first[used]
        codes, dense = np.unique(np.array(self.aligner.pair)[_expanded(first[used], spans)], return_inverse=True)
        starts = np.cumsum(spans) - spans
        key = dense[_expanded(starts[own], sizes)] * rows + np.repeat(row, sizes)
        order = np.argsort(key)
        key, links = key[order], np.repeat(seen, sizes)[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        return codes, np.bincount(key[new] // rows, minlength=len(codes)), key[new] % rows, np.add.reduceat(links, new)

    def batches(self, run: int) -> Iterator[pa.RecordBatch]:
        self.read()
        base = {name: None for name in _SPILL.names}
        yield from pa.Table.from_pylist([base | d | {"run": run} for d in self.docs], _SPILL).to_batches()
        if not len(self.flat):
            return
        codes, sizes, row, links = self.records()
        starts, part = np.cumsum(sizes) - sizes, (codes >> 32) % self.radix
        sums = np.add.reduceat(links, starts)
        for r in range(self.radix):
            pick = np.flatnonzero(part == r)
            if not len(pick):
                continue
            at = _expanded(starts[pick], sizes[pick])
            yield from pa.Table.from_pylist([base | {
                "run": run, "radix": r, "pairs": _entries_blob(codes[pick], sums[pick]),
                "rows": _packed(_gaps(codes[pick]), sizes[pick].astype(np.uint32), _gaps(row[at].astype(np.uint32)),
                                links[at].astype(np.uint32))}], _SPILL).to_batches()


def _spill(files, radix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(files), TaskContext.get().partitionId() << 33
        held = _Run(aligner, radix)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                held.add(doc.as_py(), text.as_py())
                if held.size >= RUN_BYTES:
                    yield from held.batches(number)
                    aligner.make_room()
                    held, number = _Run(aligner, radix), number + 1
        if held.docs:
            yield from held.batches(number)
            aligner.make_room()
    return run


# ---------------------------------------------------------------- merge
def merged(runs: Iterable[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """Equal codes of sorted runs summed, by a k-way heap merge."""
    code, total = -1, 0
    for c, n in heapq.merge(*runs):
        if c == code:
            total += n
        else:
            if total:
                yield code, total
            code, total = c, n
    if total:
        yield code, total


def with_maxima(entries: Iterator[tuple[int, int]]) -> tuple[array, array, array]:
    """(codes, counts, whether the count is the largest of its B id): one id's entries follow each other."""
    codes, counts, best = array("Q"), array("Q"), array("B")
    side, start, most = -1, 0, 0

    def close():
        best.extend([int(n == most) for n in counts[start:]])
    for code, n in entries:
        if code >> 32 != side:
            close()
            side, start, most = code >> 32, len(codes), 0
        codes.append(code)
        counts.append(n)
        most = max(most, n)
    close()
    return codes, counts, best


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows of equal key: (key, their last columns)."""
    at, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            key = tuple(batch.column(k)[i].as_py() for k in range(keys))
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(batch.column(keys)[i].as_py())
    if held:
        yield at, held


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, group), blobs in _grouped(batches, 2):
        codes, counts = array("Q"), array("Q")
        for code, n in merged([_entries(b) for b in blobs]):
            codes.append(code)
            counts.append(n)
        blob = _entries_blob(np.frombuffer(codes, np.uint64), np.frombuffer(counts, np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([radix], pa.int32()),
                                          pa.array([blob], pa.binary())], ["run", "radix", "pairs"])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, _), blobs in _grouped(batches, 2):
        codes, counts, best = with_maxima(merged([_entries(b) for b in blobs]))
        blob = _packed(_gaps(np.frombuffer(codes, np.uint64)), np.frombuffer(counts, np.uint64), np.frombuffer(best, np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([blob], pa.binary())], ["radix", "totals"])


def pair_totals(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """``runs(run, radix, pairs)`` -> ``radix, totals``: level by level, ``fan`` runs at a time on average."""
    while True:
        n = runs.select("run").distinct().count()
        groups = math.ceil(n / fan)
        dealt = runs.select("radix", F.pmod(F.xxhash64("run"), F.lit(max(groups, 1))).alias("grp"), "pairs")
        dealt = dealt.repartition("radix", "grp").sortWithinPartitions("radix", "grp")
        if groups <= 1:
            return cut_lineage(dealt.mapInArrow(_total, "radix int, totals binary"))
        runs = cut_lineage(dealt.mapInArrow(_merge, "run long, radix int, pairs binary"))


def _stream_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals first, then the runs of the same partition and salt: what each row's links add up to."""
    codes = counts = best = None
    for batch in batches:
        for i in range(batch.num_rows):
            run, blob = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if run is None:
                gaps, counts, best = _unpacked(blob, [np.uint64, np.uint64, np.uint8])
                codes, counts = np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)
                continue
            gaps, sizes, row_gaps, links = _unpacked(blob, [np.int64, np.uint32, np.uint32, np.uint32])
            at = np.searchsorted(codes, np.cumsum(gaps).astype(np.uint64))
            row, links = np.cumsum(row_gaps, dtype=np.uint32), links.astype(np.int64)
            sums, tops = (np.zeros(int(row.max()) + 1, np.int64) for _ in range(2))
            np.add.at(sums, row, np.repeat(counts[at], sizes) * links)
            np.add.at(tops, row, np.repeat(best[at], sizes).astype(np.int64) * links)
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), run)), pa.array(some.astype(np.int32)), pa.array(tops[some]), pa.array(sums[some])],
                ["run", "row", "n_best", "count_sum"])


@dataclass
class Spilled:
    """The aligned texts in the shared folder: one row a document, and the runs."""

    table: DataFrame

    @property
    def docs(self) -> DataFrame:
        return self.table.where("radix IS NULL").select("run", "row", "doc_id", *[n for n, _ in DOC])

    @property
    def runs(self) -> DataFrame:
        return self.table.where("radix IS NOT NULL").select("run", "radix", "pairs")


def spill(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
          radix: int = RADIX) -> Spilled:
    """Align all texts and write their runs.  The driver reads the two files, some 2 MB, and broadcasts them."""
    spark: SparkSession = docs.sparkSession
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_null(F.col(text_col).cast("string")).alias("text"))
    path = shared_path(spark, "alignment")
    slim.mapInArrow(_spill(files, radix), SPILL).write.parquet(path)
    return Spilled(spark.read.schema(SPILL).parquet(path))


def align(docs: DataFrame, a_file: str = f"{TOKENIZERS}/byte_bpe_50k.json", b_file: str = f"{TOKENIZERS}/piece_bpe_32k.model",
          id_col: str = "doc_id", text_col: str = "text", radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts links whose pair has the largest count of its B id, ties included; ``count_sum`` adds up
    the counts of all links.  Null and empty texts, and texts that the tokens of A or B do not give back
    byte by byte, have no tokens: zeros and an empty ``groups_sha256``.  Repeated rows each give a row and
    each count; ids may be null; extra columns are ignored.  Texts are encoded whole.
    """
    done = spill(docs, a_file, b_file, id_col, text_col, radix)
    totals = pair_totals(done.runs, fan)
    salts = max(1, math.ceil(done.runs.select("run").distinct().count() / fan))
    runs = done.table.where("radix IS NOT NULL").select(
        "run", F.col("rows").alias("blob"), "radix", F.pmod(F.xxhash64("run"), F.lit(salts)).cast("int").alias("salt"))
    head = totals.select(F.lit(None).cast("long").alias("run"), F.col("totals").alias("blob"), "radix",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    streamed = head.unionByName(runs).repartition("radix", "salt").sortWithinPartitions(
        "radix", "salt", F.col("run").asc_nulls_first()).mapInArrow(
            _stream_back, "run long, row int, n_best long, count_sum long")
    sums = streamed.groupBy("run", "row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return done.docs.join(sums, ["run", "row"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def pair_counts(docs: DataFrame, a_file: str = f"{TOKENIZERS}/byte_bpe_50k.json",
                b_file: str = f"{TOKENIZERS}/piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table of linked pairs: ``a, b, links, best``, at most one row for each pair of ids."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(1):
                gaps, counts, best = _unpacked(blob.as_py(), [np.uint64, np.uint64, np.uint8])
                codes = np.cumsum(gaps, dtype=np.uint64).astype(np.int64)
                for i in range(0, len(codes), 1 << 16):
                    c = codes[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c & 0xFFFFFFFF), pa.array(c >> 32), pa.array(counts[i:i + (1 << 16)].astype(np.int64)),
                         pa.array(best[i:i + (1 << 16)] == 1)], ["a", "b", "links", "best"])
    return pair_totals(spill(docs, a_file, b_file, id_col, text_col).runs).mapInArrow(rows, "a long, b long, links long, best boolean")
