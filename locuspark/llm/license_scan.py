"""Licence scan: ordered signature rules behind a keyword prefilter.

A text becomes its lower-case words with one space between.  An Aho-Corasick
automaton reads it once and tells which keywords occur; only the rules of those
keywords run (:mod:`locuspark.llm.license_rules`, some 300 expressions).  A
detection is an interval of words with a rule.  One inside another goes if the
other's rule has the higher priority, or the same priority and a longer interval
or, of equal intervals, an earlier rule.  What stays gives the labels and the score.
The four base phrases are found the same way and are never suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import LOWER, UPPER, no_null
from locuspark.llm.license_rules import STRENGTH, rules

#: Fixed phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: ASCII: A-Z to a-z, digits as they are, all else to a space.  Bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
assert _FOLD[65:91].decode() == LOWER and len(UPPER) == 26

Detection = tuple[int, int, int]  # first word, word after the last, number of the rule


def normal(text: str) -> tuple[str, int]:
    """The words of ``text`` with a space before, between and after them, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass"), len(words)


class Scanner:
    """Compiled rules; ``rules`` as :func:`locuspark.llm.license_rules.rules` gives them."""

    def __init__(self, rule_table: list[tuple[int, float, str, str, str]]):
        self.table = rule_table
        self.compiled = [re.compile(f"(?<= )(?:{r[4]})(?= )") for r in rule_table]
        self.base = {phrase: re.compile(f"(?<= ){phrase}(?= )") for phrase in BASE}
        self.of_word: dict[str, list[int]] = {}
        for i, rule in enumerate(rule_table):
            self.of_word.setdefault(rule[3], []).append(i)
        self.automaton = ahocorasick.Automaton()
        for word in {*self.of_word, *BASE}:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def detections(self, text: str) -> tuple[int, list[tuple[int, str]], list[Detection]]:
        """(words, places of base phrases as (first word, label), detections of the rules), nothing suppressed."""
        flat, n = normal(text)
        words = {word for _, word in self.automaton.iter(flat)}
        if not words:
            return n, [], []
        gaps = np.flatnonzero(np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        at = lambda places: np.searchsorted(gaps, places).tolist()  # noqa: E731  gap k stands before word k
        base = []
        for phrase, label in BASE.items():
            if phrase in words:
                base += [(s, label) for s in at([m.start() - 1 for m in self.base[phrase].finditer(flat)])]
        found: list[Detection] = []
        for i in sorted(i for word in words for i in self.of_word.get(word, ())):
            if spans := [m.span() for m in self.compiled[i].finditer(flat)]:
                first, last = at([s - 1 for s, _ in spans]), at([e for _, e in spans])
                found += [(s, e, i) for s, e in zip(first, last)]
        return n, base, found

    def kept(self, found: list[Detection]) -> list[Detection]:
        """Without detections inside one of a better rank; one sweep in order of start."""
        reach: dict[int, int] = {}  # priority -> furthest end so far
        out = []
        for s, e, i in sorted(found, key=lambda x: (x[0], -x[1], -self.table[x[2]][0], x[2])):
            priority = self.table[i][0]
            if not any(end >= e for p, end in reach.items() if p >= priority):
                out.append((s, e, i))
            reach[priority] = max(reach.get(priority, -1), e)
        return out

    def score(self, base: list[tuple[int, str]], kept: list[Detection]) -> float:
        """1 - product over the labels of (1 - strength of the label's best detection)."""
        best = {label: STRENGTH["base"] for _, label in base}
        for _, _, i in kept:
            label = self.table[i][2]
            best[label] = max(best.get(label, 0.0), self.table[i][1])
        miss = 1.0
        for _, strength in sorted(best.items()):
            miss *= 1 - strength
        return 1 - miss


@lru_cache(maxsize=1)
def default_scanner() -> Scanner:
    return Scanner(rules())


_OUT = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                  ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                  ("score", pa.float64()),
                  ("detections", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                                     ("end_word", pa.int64()), ("priority", pa.int32())])))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = default_scanner()
    for batch in batches:
        rows = []
        for text in batch.column(1):
            n, base, found = scanner.detections(text.as_py())
            kept, starts = scanner.kept(found), [s for s, _ in base]
            own = {label for _, label in base}
            rows.append({
                "n_words": n, "n_base": len(base), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(sorted(own)),
                "labels": ",".join(sorted(own | {scanner.table[i][2] for _, _, i in kept})),
                "score": scanner.score(base, kept),
                "detections": [{"label": scanner.table[i][2], "first_word": s, "end_word": e,
                                "priority": scanner.table[i][0]} for s, e, i in kept]})
        out = pa.Table.from_pylist(rows, _OUT).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out.columns],
            ["doc_id", *_OUT.names])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    ``n_base`` counts all places of base phrases; ``first_word`` and ``last_word`` are the
    smallest and largest of their starts (words from 0), null without one.  Labels are
    distinct, sorted and joined by commas, empty without any.  ``detections`` are those of
    the rules that stay, by first word.  Null and empty texts have no words, no labels and
    score 0.  Repeated rows each give a row; ids may be null; extra columns are ignored.
    Texts are read whole, each in the task that has it; nothing is shuffled.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_null(F.col(text_col).cast("string")).alias("text"))
    return slim.mapInArrow(
        _scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
               "labels string, score double, "
               "detections array<struct<label: string, first_word: bigint, end_word: bigint, priority: int>>")
