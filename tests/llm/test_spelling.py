import random
import re
import zlib
from collections import Counter

import brute
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from locuspark.llm.spelling import RUN, _runs, near_pairs, roots, spelling_variants, vocabulary


def words_plain(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs):
    n = words_plain(docs)
    near = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and is_near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        top = w
        while top in form:
            top = form[top]
        out.append((w, form.get(w), top, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def typos(seed, size=220):
    """Words with one or two edits of each other, accented letters among them."""
    rng = random.Random(seed)
    out = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 12))) for _ in range(size // 3)]
    while len(out) < size:
        w, i = rng.choice(out), rng.randrange(12)
        out.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abéÿ×") + w[i:], w[:i] + rng.choice("abé") + w[i + 1:]]))
    return out


@pytest.mark.parametrize("hot", [0, 9, 4096])
def test_pairs_against_plain(spark, hot):
    words = sorted({w for w in typos(1) if len(w) >= 5} | {"x" * 40, "x" * 41, "x" * 39 + "y", "aaaaa", "aaaaaa", "baaaaa"})
    got = near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), hot)
    want = {(a, b) for a in words for b in words if (len(a), a) < (len(b), b) and is_near(a, b)}
    rows = [(r["a"], r["b"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_one_chunk_in_most_words(spark):
    """A beginning that a hot group shares: refined, and the rows of its keys stay far below all pairs."""
    rng = random.Random(3)
    words = sorted({"prefix" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)})
    pairs = near_pairs(spark.createDataFrame([(w,) for w in words], "word string"))
    by_gap = {}
    for w in words:
        for i in range(len(w)):
            by_gap.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    want = {(a, b) for group in by_gap.values() for a in group for b in group if a < b}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want


def test_roots_follow_to_the_last(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("v", "w020"), ("u", "v"), ("solo", "other")]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "other" if w == "solo" else "w037" for w, _ in chain}


def test_operator_against_plain(spark, odd, none):
    rng = random.Random(8)
    pool = typos(9) + ["Übung", "ÜBUNG", "übung", "naïve", "naive", "don't", "x×÷y×z", "ſtone", "İstanb"]
    docs = [(i, " ".join(rng.choice(pool).title() if rng.random() < 0.1 else rng.choice(pool) for _ in range(60)))
            for i in range(120)] + [(None, "abcde abcde abcde abcdf"), (None, None), (5, "")]
    got = spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == want and sum(r[1] is not None for r in want) > 50
    assert sorted(map(tuple, spelling_variants(odd).collect()), key=repr) == plain([(r[0], r[1]) for r in odd_rows()])
    assert spelling_variants(none).count() == 0


def test_long_text_is_cut_between_runs(spark, monkeypatch):
    from locuspark.llm import spelling
    text = "Alpha beta-gamma " * 50 + "q" * 300 + " end"
    whole = Counter(RUN.findall(brute.low(text)))
    for piece in (1, 7, 100, 333):
        monkeypatch.setattr(spelling, "PIECE", piece)
        assert _runs(text) == whole


def test_counts_are_whole(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("common").alias("text"))
    assert sum(r["n"] for r in vocabulary(docs).collect()) == sum(words_plain((i, "common") for i in range(3000)).values())
