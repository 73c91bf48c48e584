import random
import re

import brute
from conftest import odd_rows
from pyspark.sql import functions as F

from locuspark.llm.license_rules import PRIORITY, RULES, rules
from locuspark.llm.license_scan import BASE, Scanner, default_scanner, license_scan
from locuspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

#: Texts and a label that each must give, or must not give (with a minus).
SAMPLES = [
    ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"), ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
    ("the GNU Lesser General Public License v2.1", "lgpl-2.1"), ("GPLv3 or later", "gpl-3.0-or-later"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"), ("the 2-clause BSD license", "bsd-2-clause"),
    ("(c) 2020 nobody. Copyright 2020 Some One. All rights reserved.", "all-rights-reserved"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\")", "mit"),
    ("to the extent possible under law A. Writer has waived all copyright and related or neighboring rights", "cc0-1.0"),
    ("the permit licenses of the general public", "-gpl"), ("summit license", "-mit"), ("a submitted mits licensee", "-mit"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "-gpl-3.0-only"), ("Mozilla Public License 2.0", "-mpl"),
    ("This is free and unencumbered software released into the public domain", "-public-domain"),
]


def words_of(text):
    return brute.WORD.findall(brute.low(text))


def plain(text, table):
    """Every rule on every text without the keyword filter, suppression by comparing all pairs."""
    w = words_of(text)
    flat = " " + " ".join(w) + " "
    base = [(i, label) for phrase, label in BASE.items() for i in range(len(w))
            if w[i:i + len(phrase.split())] == phrase.split()]
    place = {}  # character offset of a word's start -> word
    at = 1
    for i, x in enumerate(w):
        place[at] = i
        at += len(x) + 1
    found = []
    for i, (_, _, _, _, expression) in enumerate(table):
        for m in re.finditer(f"(?<= )(?:{expression})(?= )", flat):
            first = place[m.start()]
            found.append((first, first + len(m[0].split(" ")), i))
    rank = lambda x: (-table[x[2]][0], -(x[1] - x[0]), x[2])
    kept = [x for x in found if not any(y[0] <= x[0] and x[1] <= y[1] and rank(y) < rank(x) for y in found)]
    return len(w), base, sorted(found), sorted(kept)


def random_texts(seed=5, n=400):
    """Texts sewn from pieces of the samples, licence words and plain words."""
    rng = random.Random(seed)
    pool = [w for t, _ in SAMPLES for w in t.split()] + list(BASE) + "version 2 3.0 or later license GPL SPDX é the".split()
    return [" ".join(rng.choice(pool) if rng.random() < 0.4 else rng.choice(SAMPLES)[0] for _ in range(rng.randrange(12)))
            for _ in range(n)]


def test_rule_table():
    table = rules()
    assert len(table) > 250 and len({r[4] for r in table}) == len(table)
    assert {line.split("|")[0].strip() for line in RULES.strip().splitlines()} <= set(PRIORITY)
    for _, _, label, keyword, expression in table:
        re.compile(expression)
        assert keyword == keyword.lower() and re.fullmatch(r"[a-z0-9.\-]+", label)


def test_samples():
    scanner = default_scanner()
    for text, label in SAMPLES:
        _, base, found = scanner.detections(text)
        got = {x for _, x in base} | {scanner.table[i][2] for _, _, i in scanner.kept(found)}
        assert (label[1:] not in got) if label.startswith("-") else (label in got), (text, label, got)


def test_prefilter_and_suppression_match_plain():
    scanner = default_scanner()
    texts = random_texts() + [r[1] or "" for r in odd_rows() if len(r[1] or "") < 5000] + [t for t, _ in SAMPLES]
    for text in texts:
        n, base, found, kept = plain(text, scanner.table)
        got_n, got_base, got = scanner.detections(text)
        assert (got_n, sorted(got_base), sorted(got)) == (n, sorted(base), found), text
        assert sorted(scanner.kept(got)) == kept, text


def test_suppression_order():
    scanner = Scanner([(1, 0.5, "low", "a", "a b c d"), (2, 0.5, "high", "b", "b c"), (2, 0.5, "twin", "b", "b c"),
                       (1, 0.5, "inside", "b", "b"), (2, 0.5, "long", "b", "b c d")])
    _, _, found = scanner.detections("a b c d")
    assert [scanner.table[i][2] for _, _, i in scanner.kept(found)] == ["low", "long"]
    _, _, found = scanner.detections("b c b")
    assert [(s, scanner.table[i][2]) for s, _, i in scanner.kept(found)] == [(0, "high"), (2, "inside")]


def check(rows, texts):
    scanner = default_scanner()
    key = lambda r: tuple(repr(x) for x in r)
    want = []
    for doc_id, text in texts:
        n, base, _, kept = plain(text or "", scanner.table)
        own, starts = {x for _, x in base}, [s for s, _ in base]
        want.append((doc_id, n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
                     ",".join(sorted(own | {scanner.table[i][2] for _, _, i in kept})), scanner.score(base, kept)))
    assert sorted(map(key, map(tuple, rows))) == sorted(map(key, want))
    assert all(0 <= r[7] <= 1 for r in want)


def test_odd_rows(spark, odd, none):
    check(license_scan(odd).drop("detections").collect(), [(r[0], r[1]) for r in odd_rows()])
    assert license_scan(none).count() == 0
    texts = list(enumerate(random_texts(6, 60))) + [(90, ("MIT License. " * 5000)), (91, None), (91, None)]
    check(license_scan(spark.createDataFrame(texts, "doc_id long, text string")).drop("detections").collect(), texts)


def test_query_against_plain(spark):
    got = QUERIES["op13_license_scan"](spark, SF)
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    near = [t for t in texts if re.search("licen|cc.by|gnu|copyright|spdx|public", t[1] or "", re.I)]
    ids = {d for d, _ in near}
    check([r for r in got.collect() if r["doc_id"] in ids], near)
    assert got.where(~F.col("doc_id").isin(*ids) & (F.col("n_base") > 0)).count() == 0 and got.count() == len(texts)
