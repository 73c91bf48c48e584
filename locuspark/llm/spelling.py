"""Spelling variants: an edit-distance-one join of the vocabulary by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one the
other.  Of a pair, the word that is not longer gives its two disjoint chunks, its
halves; the other gives its positional grams of those lengths.  One edit touches one
chunk at most, so the other one is a gram of the longer word, shifted by one place at most
(grams that no chunk place is within one of join nothing and are not written).
Pairs that share a chunk are verified by their edit distance.

A chunk that very many words share would give all pairs of them.  Such a chunk is not
joined: within it, what is left of each word is cut into chunks and grams again, and the key
grows by one more of them, until keys are selective or one code point is left.
No pair is lost, since one edit leaves one of two chunks whole at every level.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import cut_lineage, no_null

RUN = re.compile("[a-zÀ-ÿ]+")
GAP = re.compile("[^a-zÀ-ÿ]")
PIECE = 1 << 20  # code points of a text that are cut into runs at once
HELD = 200_000  # distinct words that a task counts before it passes them on
TYPO = 97  # a run loses a code point if this divides its checksum
LEAST_LENGTH, LEAST_COUNT = 5, 3
HOT = 4096  # pairs above which a key is refined rather than joined


def _runs(text: str) -> Counter:
    """Runs of letters, A-Z lower-cased, and how often each occurs; read piece by piece, cut between runs."""
    low = text.encode().lower().decode()
    if len(low) <= PIECE:
        return Counter(RUN.findall(low))
    out, at = Counter(), 0
    while at < len(low):
        gap = GAP.search(low, min(at + PIECE, len(low)))
        end = gap.start() if gap else len(low)
        out.update(RUN.findall(low, at, end))
        at = end
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          ["word", "n"])
    held: dict[str, int] = {}
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            head = zlib.crc32(f"{doc.as_py()}:".encode())
            for run, n in _runs(text.as_py()).items():
                h = zlib.crc32(run.encode(), head)
                if h % TYPO == 0:
                    gone = h % len(run)
                    run = run[:gone] + run[gone + 1:]
                held[run] = held.get(run, 0) + n
            if len(held) > HELD:
                yield flush(held)
                held = {}
    if held:
        yield flush(held)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least 5 code points and 3 occurrences over all texts; counts are summed per task first."""
    slim = docs.select(no_null(F.col(id_col).cast("string")).alias("id"), no_null(F.col(text_col).cast("string")).alias("text"))
    return slim.mapInArrow(_count, "word string, n long").where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _cut(word: str, start: Column, length: Column) -> Column:
    """``length`` code points of a column from place ``start`` (from 0)."""
    return F.substring(F.col(word), start + 1, length)


def _key(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _first_rows(words: DataFrame) -> DataFrame:
    """Chunks and positional grams: ``key, is_chunk, pos, word, rest, d``.

    ``rest`` is what the edit may touch if the chunk is the one that stays; it is null for a gram
    that is not where a kept chunk would stand, which finds no pair that another gram does not.
    """
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    chunk = words.select("word", F.lit(True).alias("is_chunk"), size.alias("of"), F.lit(0).alias("d"), F.explode(F.array(
        F.struct(F.lit("l").alias("side"), F.lit(0).alias("pos"), _cut("word", F.lit(0), half).alias("part"),
                 _cut("word", half, size).alias("rest")),
        F.struct(F.lit("r").alias("side"), half.alias("pos"), _cut("word", half, size).alias("part"),
                 _cut("word", F.lit(0), half).alias("rest")))).alias("x"))
    of, d = F.col("of"), size - F.col("of")
    half = F.floor(of / 2).cast("int")
    left = F.transform(F.array(F.lit(0), F.lit(1)), lambda p: F.struct(
        F.lit("l").alias("side"), p.alias("pos"), _cut("word", p, half).alias("part"),
        F.when(p == 0, _cut("word", half, size)).alias("rest")))
    right = F.transform(F.array(half - 1, half, half + 1), lambda p: F.struct(
        F.lit("r").alias("side"), p.alias("pos"), _cut("word", p, of - half).alias("part"),
        F.when(p == half + d, _cut("word", F.lit(0), half + d)).alias("rest")))
    gram = words.withColumn("of", F.explode(F.array(size, size - 1))).where(f"of >= {LEAST_LENGTH}").select(
        "word", F.lit(False).alias("is_chunk"), "of", d.alias("d"), F.explode(F.concat(left, right)).alias("x"))
    whole = F.length("x.part") == F.when(F.col("x.side") == "l", F.floor(of / 2)).otherwise(of - F.floor(of / 2))
    return chunk.unionByName(gram.where(whole)).select(
        _key(F.col("of"), F.col("x.side"), F.col("x.part")).alias("key"), "is_chunk", "x.pos", "word", "x.rest", "d")


def _next_rows(rows: DataFrame) -> DataFrame:
    """The rows of refined keys: ``rest`` cut into chunks and grams again, the key one part longer."""
    size = F.length("rest") - F.col("d")  # of the chunk side's rest
    half = F.floor(size / 2).cast("int")
    parts = F.array(
        F.struct(F.lit("l").alias("side"), F.lit(0).alias("pos"), _cut("rest", F.lit(0), half).alias("part"),
                 _cut("rest", half, F.length("rest")).alias("rest")),
        F.struct(F.lit("r").alias("side"), half.alias("pos"), _cut("rest", half + F.col("d"), size - half).alias("part"),
                 _cut("rest", F.lit(0), half + F.col("d")).alias("rest")))
    return rows.select("key", "is_chunk", "word", "d", F.explode(parts).alias("x")).select(
        _key(F.col("key"), F.col("x.side"), F.col("x.part")).alias("key"), "is_chunk",
        F.col("x.pos") + F.when(F.col("x.side") == "r", F.col("d")).otherwise(0) * (~F.col("is_chunk")).cast("int"),
        "word", "x.rest", "d").toDF("key", "is_chunk", "pos", "word", "rest", "d")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``words(word)``, distinct -> ``a, b``: every pair at edit distance one, once, ``a`` the shorter or the smaller."""
    rows, found = cut_lineage(_first_rows(words.select("word"))), None
    while True:
        sizes = rows.groupBy("key").agg(F.count_if("is_chunk").alias("c"), F.count_if(~F.col("is_chunk")).alias("g"),
                                        F.min(F.length("rest") - F.col("d")).alias("left"))
        sizes = sizes.where("c > 0 AND g > 0").select("key", ((F.col("c") * F.col("g") > hot) & (F.col("left") > 1)).alias("hot"))
        rows = cut_lineage(rows.join(sizes, "key"))
        cold = rows.where("NOT hot")
        a = cold.where("is_chunk").select("key", F.col("word").alias("a"), F.col("pos").alias("at"))
        b = cold.where("NOT is_chunk").select("key", F.col("word").alias("b"), F.col("pos").alias("to"), "d")
        pairs = a.join(b, "key").where((F.abs(F.col("at") - F.col("to")) <= 1) & ((F.col("d") == 1) | (F.col("a") < F.col("b"))))
        pairs = pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")
        found = pairs if found is None else found.union(pairs)
        more = rows.where("hot AND rest IS NOT NULL")
        if more.isEmpty():
            return found.distinct()
        rows = cut_lineage(_next_rows(more))


def roots(forms: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: the last word that following forms reaches, by doubling."""
    state = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        up = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = cut_lineage(state.join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per word of the vocabulary: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that n is at least
    twice the word's own, else null, and so is ``form_n``; n_near counts the near words; ``root`` follows forms to
    the last, and is the word itself without one.  Null and empty texts have no words; a null id counts as the empty
    text; every row of a repeated row counts; extra columns are ignored.  Equal words are one word, so copies of
    texts and frequent words cost one row from the vocabulary on.
    """
    words = cut_lineage(vocabulary(docs, id_col, text_col))
    pairs = near_pairs(words, hot)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                       F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    strong = (-F.col("best.minus")) >= 2 * F.col("n")
    out = cut_lineage(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.minus")).alias("form_n")))
    return out.join(roots(out.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
