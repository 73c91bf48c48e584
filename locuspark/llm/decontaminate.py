"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows (13 consecutive words, or the whole of a shorter item) are
sets of word shingles that a document must contain in full.  For containment of
the whole set, the necessary prefix is one shingle, and the best one is the
rarest: shingles are ordered by how often the corpus has them, counted over all
documents, and only the rarest shingle of each window is joined.  A shingle at
document position p and window offset o fixes the window's place; the length
and positional bounds (0 <= p - o, p - o + length <= words) and the word-by-word
comparison of that item-sized window decide.

The benchmark side is broadcast in blocks of at most ``block_chars`` characters
of windows, so the broadcast does not grow with the benchmark; the documents are
never shuffled, only one row per document with its hits is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import ascii_lower, cut_lineage, no_null, row_key

WINDOW = 13
SHINGLE = 3
BLOCK_CHARS = 16_000_000
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(no_null(text)), F.lit(WORD), F.lit(1))


def _shingle(words: str, start: Column, size: int) -> Column:
    """Hash of ``size`` words from ``start`` (0-based); the size is part of it."""
    return F.xxhash64(F.lit(size), *[F.get(words, start + i) for i in range(size)])


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """``win`` (distinct word windows), ``len``, and the sorted ``items`` that have them."""
    items = benchmark.select(no_null(F.col(item_col).cast("string")).alias("item"),
                             words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    at = items.withColumn("len", size).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - size)))
    return (at.select(F.slice("w", F.col("at") + 1, F.col("len")).alias("win"), "len", "item")
            .groupBy("win", "len").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _positions(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Every word position of every document, with its shingle keys; position -1 stands for the document."""
    keys = F.array(*[F.when(F.col("p") + k <= F.col("n"), _shingle("w", F.col("p"), k)) for k in sizes])
    spread = docs.withColumn("n", F.size("w")).withColumn("p", F.explode(F.expr("sequence(-1, n - 1)")))
    if len(sizes) == 1:
        return spread.withColumn("key", F.when(F.col("p") >= 0, F.get(keys, F.lit(0))))
    return spread.withColumn("key", F.explode(F.when(F.col("p") >= 0, keys).otherwise(
        F.array(F.lit(None).cast("long")))))


def _blocks(windows: DataFrame, block_chars: int, by: str = "win") -> list[DataFrame]:
    """Split a small-row table into parts of about ``block_chars`` characters each.

    Each part is evaluated for itself, so ``by`` must be the same in every evaluation.
    """
    total = windows.agg(F.sum("chars")).first()[0] or 0
    n = -(-total // block_chars)
    return [windows.where(F.pmod(F.xxhash64(by), F.lit(n)) == i) for i in range(n)]


def window_probes(docs: DataFrame, windows: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, list[int]]:
    """One probe per window that can occur: its rarest shingle by corpus count, and that shingle's offset."""
    spread = windows.withColumn("k", F.least("len", F.lit(SHINGLE))).withColumn(
        "offset", F.explode(F.expr("sequence(0, len - k)")))
    key = reduce(lambda rest, k: F.when(F.col("k") == k, _shingle("win", F.col("offset"), k)).otherwise(rest),
                 range(1, SHINGLE + 1), F.lit(None).cast("long"))
    shingles = cut_lineage(spread.select("win", "len", "items", "k", "offset", key.alias("key"),
                                         (F.length(F.concat_ws(" ", "win")) + 40 * F.size("items") + 200)
                                         .alias("chars")))
    sizes = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most SHINGLE numbers
    if not sizes:
        return shingles.withColumn("freq", F.lit(0)), sizes
    keys = shingles.select("key").distinct().withColumn("chars", F.lit(100))
    at = _positions(docs, sizes).select("key")
    counts = reduce(DataFrame.union, [at.join(F.broadcast(part.select("key")), "key", "left_semi")
                                      for part in _blocks(keys, block_chars, "key")]).groupBy("key").agg(
        F.count(F.lit(1)).alias("freq"))
    rarest = F.struct("freq", "key", "offset")
    known = shingles.join(counts, "key", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    best = known.groupBy("win", "len").agg(F.min(rarest).alias("r"), F.first("items").alias("items"),
                                           F.first("chars").alias("chars"))
    return cut_lineage(best.where("r.freq > 0").select("win", "len", "items", "chars", "r.key", "r.offset")), sizes


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, row_key``.

    Words are maximal runs of digits, letters a-z (A-Z lower-cased) and
    characters beyond ASCII.  A word is hit if any occurrence of a benchmark
    window covers it; ``items`` lists the items with an occurring window,
    sorted as strings.  A document is contaminated if some word is hit and
    ``20 * n_hit >= n_words``.  Null and empty texts have no words; a null
    item id counts as the empty string; items with equal ids count once; items
    without words have no window.  Repeated rows each give a row.  Extra columns
    are ignored; with an empty benchmark nothing is hit.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
                       words_of(F.col(text_col)).alias("w"))
    probes, sizes = window_probes(slim.select("w"), benchmark_windows(benchmark, window=window), block_chars)
    at = _positions(slim, sizes or [1])
    found = []
    for i, part in enumerate(_blocks(probes, block_chars) or [probes]):
        start = F.col("p") - F.col("offset")
        fits = (start >= 0) & (start + F.col("len") <= F.col("n"))
        same = F.slice("w", F.when(fits, start + 1).otherwise(1), F.col("len")) == F.col("win")
        side = F.broadcast(part.select(F.col("key").alias("probe"), "offset", "len", "win", "items"))
        hits = at.join(side, (F.col("key") == F.col("probe")) & fits & same, "left")
        hits = hits.where(F.col("win").isNotNull() | F.col("p").eqNullSafe(-1) if i == 0 else F.col("win").isNotNull())
        found.append(hits.select("row_key", "doc_id", "n", (F.col("p") == -1).cast("long").alias("rows"), "items",
                                 F.when(F.col("win").isNotNull(), F.struct(start.alias("s"), (start + F.col("len"))
                                                                           .alias("e"))).alias("span")))
    per = reduce(DataFrame.union, found).groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"), F.max("n").cast("long").alias("n_words"), F.sum("rows").alias("rows"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("items").alias("lists"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda acc, x: F.struct((acc["hit"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["reach"])))
                                .alias("hit"), F.greatest(acc["reach"], x["e"]).alias("reach")),
        lambda acc: acc["hit"].cast("long"))
    out = per.select("doc_id", "n_words", covered.alias("n_hit"), "rows", "row_key",
                     F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"))
    return out.withColumn("copy", F.explode(F.expr("sequence(1L, rows)"))).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "items", "row_key")
