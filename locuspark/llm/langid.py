"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become sequences of letters (lower-cased, everything else one space);
their 1- to 3-grams hash into a fixed number of features.  Document frequencies
are counted over all training documents; the classifier is fitted on a bounded
sample of them, balanced by language, with follow-the-regularised-leader steps
and elastic-net penalties, so most weights are exactly zero.  A part of the
sample that the fit does not see sets one temperature for calibrated scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions.rng import hash60
from locuspark.llm.common import no_null, row_key

FEATURES = 1 << 14
EXAMPLES = 4000  # bound of the training sample, shared evenly by the languages
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01
SEED = 42
UNKNOWN = "und"
MULTIPLY = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 where it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def ngrams(text: str) -> np.ndarray:
    """Feature numbers of all 1- to 3-grams of a text, repeats included; empty without a letter."""
    seq = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not seq.any():
        return np.empty(0, np.int64)
    seq = np.concatenate((np.zeros(1, np.uint32), seq, np.zeros(1, np.uint32)))
    seq = seq[np.concatenate(([True], (seq[1:] != 0) | (seq[:-1] != 0)))]
    one = seq * MULTIPLY[0]
    two = (one[:-1] ^ (seq[1:] + np.uint32(1))) * MULTIPLY[1]
    three = (two[:-1] ^ (seq[2:] + np.uint32(2))) * MULTIPLY[2]
    shift = np.uint32(33 - FEATURES.bit_length())
    return np.concatenate([(x ^ (x >> np.uint32(15))) * MULTIPLY[0] >> shift for x in (one, two, three)])


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    found = np.bincount(ngrams(text or ""), minlength=FEATURES)
    index = np.flatnonzero(found)
    return index, found[index]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (languages, features), mostly zero
    temperature: float = 1.0

    def vector(self, index: np.ndarray, n: np.ndarray) -> np.ndarray:
        v = (1 + np.log(n)) * self.idf[index]
        return v / np.sqrt(v @ v)

    def proba(self, index: np.ndarray, n: np.ndarray) -> np.ndarray:
        return softmax(self.weights[:, index] @ self.vector(index, n) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int, n_features: int,
         epochs: int = EPOCHS, seed: int = SEED) -> np.ndarray:
    """Weights of a multinomial model by FTRL-proximal steps with elastic-net penalties."""
    z, n = np.zeros((n_classes, n_features)), np.zeros((n_classes, n_features))

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(vectors)):
            index, x = vectors[i]
            zi, ni = z[:, index], n[:, index]
            w = weights(zi, ni)
            error = softmax(w @ x)
            error[labels[i]] -= 1
            g = error[:, None] * x
            grown = ni + g * g
            z[:, index] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[:, index] = grown
    return weights(z, n)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of smallest negative log-likelihood, by golden-section search on its logarithm."""
    def loss(t):
        s = logits / np.exp(t)
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), labels])
                     .mean())
    a, b, g = np.log(0.02), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each feature, of one task; feature -1 counts the documents."""
    have, total = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            have[counts_of(text.as_py())[0]] += 1
        total += len(batch)
    index = np.flatnonzero(have)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(index, -1), pa.int64()),
                                      pa.array(np.append(have[index], total), pa.int64())], ["feature", "n"])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [counts_of(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([i.astype(np.uint16).tobytes() for i, _ in pairs], pa.binary()),
             pa.array([np.minimum(n, 0xFFFFFFFF).astype(np.uint32).tobytes() for _, n in pairs], pa.binary())],
            ["k", "lang", "features", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          most: int = EXAMPLES, seed: int = SEED) -> Model | None:
    """Fit on documents with a non-null language; None if there is none.

    The sample takes, of each language, the documents whose hash lies below
    ``most / languages / documents of the language``, so about ``most`` in all.
    The hash is of id and text, and rows that are equal in both count once.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.col(id_col).alias("id"))
    held = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not held:
        return None
    langs = sorted(held)
    df = rows.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).toArrow()  # one row per feature at most
    counts = dict(zip(df.column("feature").to_pylist(), df.column("n").to_pylist()))
    idf = np.array([np.log((counts[-1] + 1) / (counts.get(i, 0) + 1)) + 1 for i in range(FEATURES)])
    limits = docs.sparkSession.createDataFrame(
        [(x, min(1 << 60, int((1 << 60) * most / len(langs) / held[x]))) for x in langs], "lang string, upto long")
    picked = rows.withColumn("k", row_key(F.col("id"), F.col("text"))).join(F.broadcast(limits), "lang").where(
        hash60(seed, F.col("k")) < F.col("upto")).select("k", "lang", "text").dropDuplicates(["k", "lang"])
    got = picked.mapInArrow(_featurise, "k string, lang string, features binary, n binary").toArrow()
    model = Model(langs, idf, np.zeros((len(langs), FEATURES)))
    vectors, labels = [], []
    for _, lang, f, n in sorted(zip(*(got.column(c).to_pylist() for c in got.column_names))):
        index = np.frombuffer(f, np.uint16).astype(np.int64)
        if len(index):
            vectors.append((index, model.vector(index, np.frombuffer(n, np.uint32))))
            labels.append(langs.index(lang))
    y, check = np.array(labels, int), np.arange(len(labels)) % 5 == 0
    if not len(y):
        return model
    model.weights = ftrl([v for v, c in zip(vectors, check) if not c] or vectors, y[~check] if (~check).any() else y,
                         len(langs), FEATURES)
    logits = np.array([model.weights[:, i] @ x for (i, x), c in zip(vectors, check) if c])
    model.temperature = best_temperature(logits, y[check])
    return model


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2):
                index, n = counts_of(text.as_py())
                p = model.proba(index, n) if len(index) and model else None
                langs.append(UNKNOWN if p is None else model.langs[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", most: int = EXAMPLES) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    Learns from rows where ``held_out`` is false and the language is not null;
    the prediction sees the text only.  A null text, or one without a letter,
    is "und" with score 0, and so is every text where there is nothing to learn
    from.  Score is the calibrated probability of the predicted language.
    Extra columns are ignored; an empty table gives an empty result.
    """
    model = train(docs.where(~held_out), id_col, text_col, lang_col, most)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       no_null(F.col(text_col).cast("string")).alias("text"))
    return slim.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
