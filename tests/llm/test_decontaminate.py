import random
from collections import Counter

import brute
import pytest
from conftest import PASSAGE, odd_rows
from pyspark.sql import functions as F

from locuspark.llm.decontaminate import decontaminate

ITEMS = [(1, PASSAGE), (1, PASSAGE), (2, "HELLO world this"), (None, "one two three"), (3, None), (4, ""), (5, "one"),
         (6, "?!"), (7, "never in any document at all my friend"), (10, PASSAGE[100:300]), (8, "lorem ipsum " * 20),
         (9, "東京")]
COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block", [16_000_000, 700])
def test_odd(spark, odd, block):
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, w string")
    got = Counter(tuple(r) for r in decontaminate(odd, bench, block_chars=block).select(COLS).collect())
    assert got == Counter(brute.contamination([(r[0], r[1]) for r in odd_rows()], ITEMS))


def test_empty(spark, odd, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(none, empty).count() == 0
    assert decontaminate(none, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
    got = decontaminate(odd, empty)
    assert got.count() == len(odd_rows()) and got.where("contaminated or n_hit > 0").count() == 0


def test_threshold(spark):
    """n_hit * 20 >= n_words decides, to the word."""
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    docs = [(n, " ".join(["a b c d e"] + ["z"] * (n - 5))) for n in (5, 99, 100, 101)]
    got = {r.doc_id: r.contaminated for r in decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                                           bench).collect()}
    assert got == {5: True, 99: True, 100: True, 101: False}


def test_many_blocks_with_any_first_value(spark, monkeypatch):
    """Windows share shingles; whichever row first() meets in each evaluation, no key may miss its block."""
    draw = F.udf(lambda n: random.SystemRandom().randint(1, n), "int").asNondeterministic()
    monkeypatch.setattr(F, "first", lambda c: F.element_at(F.collect_list(c), draw(F.count(c))))
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").repartition(4)
    docs = spark.createDataFrame([(i, f"x{i} {PASSAGE} y") for i in range(3)], "doc_id long, text string")
    got = decontaminate(docs, bench, block_chars=600).select("doc_id", "n_hit").collect()
    assert sorted(tuple(r) for r in got) == [(i, 60) for i in range(3)]
