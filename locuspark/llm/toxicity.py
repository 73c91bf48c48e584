"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Labelled documents (a bounded sample of each class) are the examples.  Terms
are words and beginnings of words; the vocabulary is chosen forward: the term
that tells most uncovered toxic examples from the clean ones joins, and the
examples that have it are covered, so words that merely accompany an insult do
not join.  IDF is counted over all documents.
A document's nearest examples are found exactly: the index keeps, for each term
and block of examples, the largest weight, and blocks are visited by falling
upper bound until none can beat the k-th best.  Votes are weighted by similarity
and class share, and a logistic curve fitted on leave-one-out votes turns them
into calibrated scores.  The neighbours are returned as evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from locuspark.functions.rng import hash60
from locuspark.llm.common import all_columns, cut_lineage, free_name, no_null, numbered

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
EXAMPLES = 3000  # bound of the labelled sample, half for each class
TERMS = 2000
NEIGHBOURS = 15
DOUBT = 0.3  # the fixed clean vote, as a similarity per neighbour
BLOCK = 64
PREFIXES = range(3, 8)
LEAST = 3
ALIKE = 0.8  # Jaccard similarity of the words from which on an example is a near copy
BANDS, ROWS = 16, 4  # MinHash bands: they propose 99.98 % of the pairs at a similarity of 0.8
WIDE, RATIO = 0.02, 30  # share of the toxic examples, and how much likelier than in clean ones, of a sure term
KNOWN = 500_000
TASKS = 16  # that share the examples
EVIDENCE = 3
SEED = 42


def words(text: bytes | None) -> list[bytes]:
    """Words of digits, letters (A-Z lower-cased) and characters beyond ASCII."""
    return WORD.findall((text or b"").lower())


def beginnings(word: bytes) -> list[str]:
    text = word.decode()
    return [text[:n] for n in PREFIXES if n <= len(text)]


def terms_of(found: Iterable[bytes] | Counter) -> Counter:
    """Terms of a text: its words ("=w"), beginnings of words ("^b"), and beginnings of two different words ("2b")."""
    out, different = Counter(), Counter()
    for word, n in Counter(found).items():
        out["=" + word.decode()] += n
        for b in beginnings(word):
            out["^" + b] += n
            different["2" + b] += 1
    out.update({b: n - 1 for b, n in different.items() if n > 1})
    return out


class _Relevant(dict):
    """Cache: may a word yield a term of the vocabulary?"""

    def __init__(self, vocabulary: Iterable[str]):
        super().__init__()
        self.vocabulary = frozenset(vocabulary)

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= KNOWN:
            self.clear()
        own = self.vocabulary
        self[word] = yes = "=" + word.decode() in own or any("^" + b in own or "2" + b in own for b in beginnings(word))
        return yes

    def bag(self, text: bytes | None) -> Counter:
        """Terms of the vocabulary in a text, with their counts."""
        found = [w for w in words(text) if self[w]]
        return Counter({t: n for t, n in terms_of(found).items() if t in self.vocabulary}) if found else Counter()


def one_of_each(marks: Sequence[np.ndarray], toxic: np.ndarray) -> list[int]:
    """Places of examples that differ: near copies (``ALIKE`` of the words shared) of an earlier one of their class go.

    ``marks`` has the distinct hashes of each example's words.  MinHash bands
    propose copies, and the words themselves decide.  Otherwise a group of
    copies would count as independent evidence for all of its words.
    """
    salt = np.random.default_rng(SEED).integers(1, 2 ** 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    kept: list[int] = []
    sets: dict[int, np.ndarray] = {}
    cells: dict[tuple, list[int]] = {}
    for i, (own, y) in enumerate(zip(marks, toxic)):
        own = np.sort(own)
        mixed = own.view(np.uint64)
        prints = np.array([((mixed * a) ^ ((mixed * a) >> np.uint64(31))).min(initial=2 ** 64 - 1) for a in salt], np.uint64)
        keys = [(int(y), b, prints[b * ROWS:(b + 1) * ROWS].tobytes()) for b in range(BANDS)]
        for j in sorted({j for key in keys for j in cells.get(key, ())}):
            both = len(np.intersect1d(own, sets[j], assume_unique=True))
            if both >= ALIKE * (len(own) + len(sets[j]) - both):
                break
        else:
            kept.append(i)
            sets[i] = own
            for key in keys:
                cells.setdefault(key, []).append(i)
    return kept


def choose_terms(names: list[str], rate: np.ndarray, rows: list[np.ndarray], least: float, most: int = TERMS) -> list[str]:
    """Forward choice of terms by their log-likelihood gain on the toxic examples that no chosen term covers.

    ``rows`` has the numbers of the terms of each toxic example, ``rate`` the share of the clean ones that have a term.
    A term must gain ``least``, more than chance gives the best of so many terms, on at
    least ``LEAST`` examples.  Terms that a good part of the toxic examples have
    and hardly any clean one join too, covered or not.
    """
    flat = np.concatenate([np.zeros(0, np.int32), *rows])
    count = np.bincount(flat, minlength=len(names))
    sure = np.flatnonzero((count >= max(WIDE * len(rows), LEAST)) & (count > RATIO * rate * len(rows)))
    sure = sorted(sure.tolist(), key=lambda t: (rate[t] / count[t], names[t]))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[np.argsort(flat, kind="stable")]
    ends = np.cumsum(count)  # the examples of term t are owner[ends[t - 1]:ends[t]]
    by_name = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)[::-1]  # ties: the last name
    open_, chosen = np.ones(len(rows), bool), []
    while open_.any() and len(names) and len(chosen) < most:
        n, total = count[by_name], int(open_.sum())
        gain = np.where(n >= LEAST, n * np.log(np.maximum(n, 1) / total / rate[by_name]), -np.inf)
        at = int(gain.argmax())
        if gain[at] < least:
            break
        term = int(by_name[at])
        chosen.append(term)
        for i in owner[ends[term - 1] if term else 0:ends[term]].tolist():
            if open_[i]:
                open_[i] = False
                count[rows[i]] -= 1
    return [names[t] for t in dict.fromkeys(chosen + sure)][:most]


@dataclass
class Index:
    """Examples as unit vectors over few terms, in blocks, with the largest weight of each term in each block."""

    idf: dict[str, float]
    ids: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray
    blocks: dict[int, np.ndarray]  # block -> dense (examples, terms)
    peaks: np.ndarray  # (terms, blocks)
    slot: dict[str, int]
    curve: tuple[float, float] = (1.0, 0.0)
    bare: float = 0.0  # score of a document without any term

    def vector(self, counts: Counter) -> np.ndarray:
        v = np.zeros(len(self.slot))
        for w, n in counts.items():
            v[self.slot[w]] = (1 + np.log(n)) * self.idf[w]
        norm = np.sqrt(v @ v)
        return v / norm if norm else v

    def nearest(self, v: np.ndarray, k: int, leave: int = -1) -> list[tuple[int, float]]:
        """The ``k`` examples of largest positive cosine (ties: smaller example first), exactly."""
        terms = np.flatnonzero(v)
        bound = v[terms] @ self.peaks[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-12:
                break
            sims = self.blocks[b][:, terms] @ v[terms]
            best += [(-float(sims[i]), b * BLOCK + i) for i in np.flatnonzero(sims > 0).tolist()
                     if b * BLOCK + i != leave]
            best = sorted(best)[:k]
        return [(i, -s) for s, i in best]

    def vote(self, near: list[tuple[int, float]]) -> float:
        """Share of toxic among neighbours, weighted by similarity and by how many rows an example stands for.

        A fixed clean vote stands against them, so that distant neighbours alone decide little.
        """
        w = np.array([s * self.weight[i] for i, s in near])
        return float(w @ self.toxic[[i for i, _ in near]] / (w.sum() + DOUBT * NEIGHBOURS))

    def score(self, near: list[tuple[int, float]]) -> float:
        if not near:
            return self.bare
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * self.vote(near) + b))))


def build_index(ids: list[int], examples: list[Counter], toxic: np.ndarray, weight: np.ndarray,
                idf: dict[str, float], k: int) -> Index:
    slot = {w: i for i, w in enumerate(sorted(idf))}
    index = Index(idf, np.array(ids, np.int64), toxic, weight, {}, np.zeros((len(slot), 0)), slot)
    vectors = np.array([index.vector(c) for c in examples]).reshape(len(examples), len(slot))
    for b in range(-(-len(examples) // BLOCK)):
        index.blocks[b] = vectors[b * BLOCK:(b + 1) * BLOCK]
    index.peaks = np.stack([m.max(0) for m in index.blocks.values()], 1)
    votes, truth, share, bare = [], [], [], [0.5 * weight.min(), weight.min()]
    for i, v in enumerate(vectors):
        near = index.nearest(v, k, leave=i) if v.any() else []
        if near:
            votes.append(index.vote(near)), truth.append(toxic[i]), share.append(weight[i])
        else:
            bare[0] += weight[i] * toxic[i] * (not v.any())
            bare[1] += weight[i] * (not v.any())
    index.curve = _logistic(np.array(votes), np.array(truth, float), np.array(share))
    index.bare = min(float(bare[0] / bare[1]), 1.0)
    return index


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Weighted logistic curve of one variable by Newton steps, drawn to slope 4 and even odds at 0.5."""
    theta = start = np.array([4.0, -2.0])
    for _ in range(50 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(theta[0] * x + theta[1], -30, 30)))
        d = np.stack([x, np.ones_like(x)], 1)
        grad = d.T @ (w * (p - y)) + ridge * (theta - start)
        step = np.linalg.solve(d.T @ (d * (w * p * (1 - p))[:, None]) + ridge * np.eye(2), grad)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def _count_terms(vocabulary: list[str]):
    """Documents that have each term, and (under the empty term) all documents, of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, total, relevant = Counter(), 0, _Relevant(vocabulary)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                have.update(relevant.bag(text.as_py()).keys())
                total += 1
        yield pa.RecordBatch.from_arrays([pa.array([*have, ""], pa.string()),
                                          pa.array([*have.values(), total], pa.int64())], ["term", "n"])
    return run


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts as word counts, and the hashes of their words."""
    for batch in batches:
        bags = [Counter(words(t.as_py())) for t in batch.column(3).cast(pa.binary())]
        marks = [np.array([xxhash.xxh64_intdigest(w) for w in b], np.uint64).view(np.int64) for b in bags]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([list(b) for b in bags], pa.list_(pa.binary())),
             pa.array([list(b.values()) for b in bags], pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64()))],
            ["doc_id", "toxic", "digest", "words", "n", "marks"])


def _held_terms(kept: frozenset[int], numbers: dict[str, int] | None = None):
    """How many of the kept examples have each term (each numbered one), counted by task; memory is bounded by KNOWN."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, pack = Counter(), lambda c: pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["term", "n"])
        for batch in batches:
            for rid, found in zip(batch.column("rid").to_pylist(), batch.column("words")):
                if rid in kept:
                    terms = terms_of(found.as_py()).keys()
                    have.update(terms if numbers is None else terms & numbers.keys())
                    if len(have) > KNOWN:
                        yield pack(have)
                        have.clear()
        yield pack(have)
    return run


def _numbers_of(kept: frozenset[int], numbers: dict[str, int]):
    """The numbered terms of each kept example."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [[numbers[t] for t in terms_of(found.as_py()) if t in numbers]
                   for rid, found in zip(batch.column("rid").to_pylist(), batch.column("words")) if rid in kept]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.int32()))], ["has"])
    return run


def _found(vocabulary: list[str]):
    """The terms of the vocabulary that each example has, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = frozenset(vocabulary)
        for batch in batches:
            bags = [{t: c for t, c in terms_of(Counter(dict(zip(w.as_py(), n.as_py())))).items() if t in own}
                    for w, n in zip(batch.column("words"), batch.column("n"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array([list(b) for b in bags], pa.list_(pa.string())),
                 pa.array([list(b.values()) for b in bags], pa.list_(pa.int64()))], ["rid", "terms", "n"])
    return run


def find_terms(examples: DataFrame, toxic: frozenset[int], clean: frozenset[int], most: int = TERMS) -> list[str]:
    """Vocabulary from the examples with these row numbers.

    Spark counts the terms of each class; the driver gets only those that enough toxic examples have, and each toxic
    example's numbers of those that can still gain enough.
    """
    held = lambda kept, numbers=None: examples.mapInArrow(_held_terms(kept, numbers), "term string, n long").groupBy(
        "term").agg(F.sum("n").alias("n"))
    count = cut_lineage(held(toxic))
    least = float(np.log(1 + count.count()))
    fewest = max(LEAST, least / -np.log(0.5 / (len(clean) + 1)))  # of a term that no clean example has
    enough = count.where(F.col("n") >= float(fewest)).toArrow()
    names, n = enough.column("term").to_pylist(), enough.column("n").to_numpy()
    numbers = {t: i for i, t in enumerate(names)}
    rate, got = np.full(len(names), 0.5), held(clean, numbers).toArrow()
    rate[[numbers[t] for t in got.column("term").to_pylist()]] += got.column("n").to_numpy()
    rate /= len(clean) + 1
    can = np.flatnonzero(-n * np.log(rate) >= least)
    names, rate = [names[i] for i in can.tolist()], rate[can]
    rows = examples.mapInArrow(_numbers_of(toxic, {t: i for i, t in enumerate(names)}), "has array<int>").toArrow()
    return choose_terms(names, rate, [r.values.to_numpy() for r in rows.column("has")], least, most)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", most: int = EXAMPLES, k: int = NEIGHBOURS, seed: int = SEED) -> Index | None:
    """Fit on at most ``most`` labelled rows, half of each class; None without labels of both classes.

    ``labels`` may hold repeated ids: an id is toxic if any of its rows says
    so; null ids and null labels are left out.  Of several texts under one id one counts, that of the smallest digest.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    held = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(held) < 2:
        return None
    order = hash60(seed, F.col("_id"))
    sample = marks.where("toxic = 1").orderBy(order, "_id").limit(most // 2).union(
        marks.where("toxic = 0").orderBy(order, "_id").limit(most // 2))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(
        F.broadcast(sample), "_id").groupBy("_id", "toxic").agg(
            F.min(F.struct(F.md5(no_null(F.col("_text"))).alias("digest"), "_text")).alias("one")).select(
                "_id", "toxic", "one.digest", "one._text")
    examples = numbered(texts.repartition(TASKS, "digest").mapInArrow(
        _examples, "doc_id long, toxic int, digest string, words array<binary>, n array<long>, marks array<long>"))
    got = examples.select("doc_id", "toxic", "digest", "rid", "marks").toArrow()
    got = got.take(pc.sort_indices(got, [(c, "ascending") for c in ("doc_id", "toxic", "digest")]))
    toxic, rid = got.column("toxic").to_numpy(), got.column("rid").to_numpy()
    if len(toxic) < 2 or toxic.min() == toxic.max():
        return None
    apart = one_of_each([m.values.to_numpy() for m in got.column("marks")], toxic)
    terms = find_terms(examples, *[frozenset(int(rid[i]) for i in apart if toxic[i] == y) for y in (1, 0)])
    have = docs.select(F.col(text_col).cast("string")).mapInArrow(
        _count_terms(terms), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in have.collect()}  # one row per term and one for all documents
    idf = {t: float(np.log((counts[""] + 1) / (counts.get(t, 0) + 1)) + 1) for t in terms}
    weight = np.array([held[y] / (toxic == y).sum() for y in toxic])
    bags = examples.mapInArrow(_found(terms), "rid long, terms array<string>, n array<long>").toArrow().to_pylist()
    bags = {r["rid"]: Counter(dict(zip(r["terms"], r["n"]))) for r in bags}
    return build_index(got.column("doc_id").to_pylist(), [bags[i] for i in rid.tolist()], toxic, weight / weight.min(), idf, k)


def _scorer(index: Index | None, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        relevant, known = _Relevant(index.idf if index else ()), {}
        for batch in batches:
            scores, evidence = [], []
            for text in batch.column("text").cast(pa.binary()):
                bag = relevant.bag(text.as_py())
                mark = frozenset(bag.items())
                if mark not in known:
                    if len(known) > 100_000:
                        known.clear()
                    near = index.nearest(index.vector(bag), k) if bag else []
                    known[mark] = (index.score(near) if index else 0.0,
                                   [{"doc_id": int(index.ids[i]), "similarity": s, "toxic": int(index.toxic[i])}
                                    for i, s in near[:EVIDENCE]])
                scores.append(known[mark][0])
                evidence.append(known[mark][1])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                                             ["row", "score", "evidence"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             most: int = EXAMPLES, k: int = NEIGHBOURS) -> DataFrame:
    """All columns of ``docs`` plus ``_tox_score`` (0 to 1) and ``_tox_evidence``, one row per input row.

    Only the text decides a score.  Texts without any term of the index (also
    null and empty ones) get the share of toxic among such examples.  Without
    labels of both classes every score is 0.  Names of added columns get more
    underscores where they are taken.
    """
    index = train(docs, labels, id_col, text_col, most=most, k=k)
    score, evidence = free_name(docs, "_tox_score"), free_name(docs, "_tox_evidence")
    packed = docs.select(F.struct(*all_columns(docs)).alias("row"), F.col(text_col).cast("string").alias("text"))
    added = StructType.fromDDL("score double, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>")
    scored = packed.mapInArrow(_scorer(index, k), StructType([packed.schema["row"], *added.fields]))
    return scored.select("row.*", F.col("score").alias(score), F.col("evidence").alias(evidence))
