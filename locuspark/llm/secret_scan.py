"""Secret scan: three exact rules, and a character convolutional network over every other candidate.

The rules find assignments, access keys and long hexadecimal strings.  Every other run of 8 or
more characters that occur in keys is a candidate, whole, whatever its length.  A small network in NumPy reads each
candidate and its surroundings: character embeddings, one convolution, the maximum of each filter before,
inside and after the candidate, and a logistic output.  It is trained on labelled findings: values that a
rule confirms against candidates that none does.  The label of a confirmed value is left out and the words that
labels use are masked in all surroundings, so the network has to learn what values look like.  Keys without
a label are among the others, so its score for a key is the share of keys that have one; findings that the fit does not see calibrate the score and set the threshold: the highest that keeps the recall asked for.

All documents are read for it.  The findings of some of them give the weights to begin with.  Then every task goes
over all findings of its documents, each once, in steps of a few thousand, and the tasks' weights are averaged by their
findings.  A fifth of the documents, by a hash of the text, is kept out of both; all their findings calibrate and set the threshold.

The filters do not depend on the candidate, so texts are convolved once and their candidates take maxima.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.rng import hash60
from locuspark.llm.common import cut_lineage, no_null

KINDS = ("assign", "access", "hex", "model")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
LABEL = re.compile("password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}")

SAMPLE_DOCS = 20_000  # documents whose findings give the first weights, by hash
ENOUGH = 500  # confirmed findings; with fewer in the sample, those of all documents are read
FINDINGS = 10_000  # findings of each class for the first weights, by hash
LONGEST = 512  # characters of a finding for the first weights; the pass over all documents reads longer ones too
FEW = 25  # confirmed findings, below which no document is kept out
FOLDS = 5  # one part of the documents in so many is kept out
STEP, AGAIN, SLOW = 2048, 64, 0.001  # the pass over all: findings a step, confirmed ones seen again in each, rate
CHARS = 1 << 20  # characters joined, from which a step ends
BINS, FAR = 1024, 32  # logits are counted in so many bins each, up to this far from 0
RECALL = 0.98
AROUND = 16  # characters before and after
EMBED, FILTERS, WIDTH = 8, 16, 5
SLICE = 1 << 14  # characters convolved at once
EPOCHS, RATE, BATCH = 6, 0.01, 64
SEED = 42

Span = tuple[int, int, int]  # start, number of the kind, end


def may_have_label(text: str) -> bool:
    low = text.encode("utf-8", "surrogatepass").lower()
    return any(word.encode() in low for word in KEYWORDS)


def rule_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the rules, and the candidate runs that no rule touches; offsets in code points.

    Access keys and hexadecimal strings consist of candidate characters, so they are searched in the runs only.
    """
    runs = [m.span() for m in RUN.finditer(text)]
    spans = [(m.start(), k, m.end()) for a, b in runs for k, rule in ((1, ACCESS), (2, HEX))
             for m in rule.finditer(text, a, b)]
    if may_have_label(text):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    others = [(a, b) for a, b in runs if not any(s < b and a < e for s, _, e in spans)] if spans else runs
    return sorted(spans), others


def codes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of a text, and the same with the rule's words masked: ASCII as it is, 127 beyond it, 0 for none.

    Both have ``AROUND`` zeros before and after the text.
    """
    codes = np.zeros(len(text) + 2 * AROUND, np.uint8)
    codes[AROUND:AROUND + len(text)] = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 127)
    masked = codes
    for m in LABEL.finditer(text) if may_have_label(text) else ():
        masked = codes.copy() if masked is codes else masked
        masked[m.start() + AROUND:m.end() + AROUND] = 0
    return codes, masked


def finding(codes: np.ndarray, masked: np.ndarray, start: int, end: int, head: int | None = None) -> bytes:
    """A candidate between its surroundings, as the fit reads it.

    ``head`` is where the label of a confirmed value begins: the label is left out, so that what stands before
    a value does not tell whether a rule confirmed it.
    """
    head = start if head is None else head
    return (masked[head:head + AROUND].tobytes() + codes[start + AROUND:end + AROUND].tobytes()
            + masked[end + AROUND:end + 2 * AROUND].tobytes())


@dataclass
class Network:
    embed: np.ndarray  # (128, EMBED)
    conv: np.ndarray  # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray
    out: np.ndarray  # (3 * FILTERS,)
    shift: np.ndarray  # (1,)
    scale: float = 1.0  # calibration: sigmoid(scale * logit + offset)
    offset: float = 0.0
    threshold: float = 1.0
    precision: float = 0.0  # among the findings that set the threshold, and recall there
    recall: float = 0.0
    seen: int = 0  # findings of the pass over all documents

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.bias, self.out, self.shift]

    def forward(self, found: list[bytes]):
        """Logits of findings, and what the gradients need.  A window lies in one of the three parts."""
        longest, n = max(map(len, found)), len(found)
        codes = np.zeros((n, longest), np.uint8)
        for row, f in zip(codes, found):
            row[:len(f)] = np.frombuffer(f, np.uint8)
        size = np.array([len(f) for f in found])[:, None]
        x = self.embed[codes]
        cols = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(
            n, longest - WIDTH + 1, WIDTH * EMBED)
        act = np.maximum(cols @ self.conv + self.bias, 0)
        at, window = [], np.arange(longest - WIDTH + 1)[None, :]
        for first, last in ((0, AROUND), (AROUND, size - AROUND), (size - AROUND, size)):
            own = (window >= first) & (window <= last - WIDTH)
            at.append(np.where(own[:, :, None], act, -1.0).argmax(1))
        at = np.stack(at, 1)  # (n, 3, FILTERS)
        pooled = np.take_along_axis(act, at.reshape(n, -1, FILTERS), 1)
        return pooled.reshape(n, -1) @ self.out + self.shift[0], (codes, cols, at, pooled)

    def gradients(self, found: list[bytes], y: np.ndarray) -> list[np.ndarray]:
        logit, (codes, cols, at, pooled) = self.forward(found)
        n = len(y)
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n
        d_pool = (d[:, None] * self.out).reshape(n, 3, FILTERS) * (pooled > 0)
        picked = cols[np.arange(n)[:, None, None], at]  # (n, 3, FILTERS, WIDTH * EMBED)
        d_conv = np.einsum("npf,npfk->kf", d_pool, picked)
        d_cols = np.einsum("npf,kf->npfk", d_pool, self.conv).reshape(n, 3, FILTERS, WIDTH, EMBED)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, codes[np.arange(n)[:, None, None, None], at[..., None] + np.arange(WIDTH)], d_cols)
        return [d_embed, d_conv, d_pool.sum((0, 1)), pooled.reshape(n, -1).T @ d, np.array([d.sum()])]

    def chance(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.offset, -30, 30)))

    def tables(self) -> np.ndarray:
        """What a character at each place of a window adds to the filters: (WIDTH, 128, FILTERS)."""
        return np.einsum("ce,wef->wcf", self.embed, self.conv.reshape(WIDTH, EMBED, FILTERS)).astype(np.float32)

    def pooled(self, codes: np.ndarray, masked: np.ndarray, spans: list[tuple[int, int]], tables: np.ndarray,
               windows: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The maxima of candidates, in order: (n, 3, FILTERS); and the characters of those windows: (n, 3, FILTERS, WIDTH).

        At most ``SLICE`` characters and the next candidate are convolved at once, a longer candidate slice by slice.
        """
        first_table = tables[0] + self.bias.astype(np.float32)

        def filters(part: np.ndarray) -> np.ndarray:
            at = part.astype(np.int64)
            total = first_table.take(at[:len(at) - WIDTH + 1], axis=0)
            for w in range(1, WIDTH):
                total += tables[w].take(at[w:len(at) - WIDTH + 1 + w], axis=0)
            return np.maximum(total, 0, out=total)

        def peaks(act: np.ndarray, own: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Maxima over the windows ``first`` to ``last`` of each row, in groups of about equal length."""
            best, at = np.empty((len(first), FILTERS), np.float32), np.empty((len(first), FILTERS), np.int64)
            width = 1 << np.ceil(np.log2(last - first + 1)).astype(int)
            width = np.where(last - first == AROUND - WIDTH, AROUND - WIDTH + 1, width)
            for size in np.unique(width).tolist():
                rows = np.flatnonzero(width == size)
                for some in np.array_split(rows, -(-len(rows) * size // SLICE)):
                    if windows or size > AROUND:
                        got = act.take(np.minimum(first[some, None] + np.arange(size), last[some, None]), axis=0)
                        k = got.argmax(1)
                        best[some] = np.take_along_axis(got, k[:, None], 1)[:, 0]
                        at[some] = np.minimum(first[some, None] + k, last[some, None])
                    else:
                        got = act.take(first[some], axis=0)
                        for k in range(1, size):
                            np.maximum(got, act.take(np.minimum(first[some] + k, last[some]), axis=0), out=got)
                        best[some] = got
            return best, own[at[..., None] + np.arange(WIDTH)] if windows else at

        values, chars = [], []
        i, ends = 0, np.array([e for _, e in spans])
        while i < len(spans):
            begin = spans[i][0]
            j = max(i + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
            own = np.array(spans[i:j]) - begin
            end = begin + own[-1, 1] + 2 * AROUND
            if j == i + 1 and own[0, 1] > SLICE:
                stops = [(a, min(a + SLICE + WIDTH - 1, end - AROUND)) for a in range(begin + AROUND, end - AROUND - WIDTH + 1, SLICE)]
                parts = [peaks(filters(codes[a:b]), codes[a:b], np.array([0]), np.array([b - a - WIDTH])) for a, b in stops]
                which = np.stack([v[0] for v, _ in parts]).argmax(0)
                inside = tuple(np.stack([p[x][0] for p in parts])[which, np.arange(FILTERS)][None] for x in (0, 1))
                edge = np.array([0]), np.array([AROUND - WIDTH])
                before, after = (peaks(filters(part), part, *edge) for part in
                                 (masked[begin:begin + AROUND], masked[end - AROUND:end]))
            else:
                chunk, other = codes[begin:end], masked[begin:end]
                act = filters(chunk)
                context, changed = act, np.flatnonzero(chunk != other)
                if len(changed):  # only windows with a masked character differ
                    at = np.unique(np.clip(changed[:, None] - np.arange(WIDTH), 0, len(act) - 1))
                    context = act.copy()
                    context[at] = np.maximum(sum(tables[w][other[at + w]] for w in range(1, WIDTH)) + first_table[other[at]], 0)
                first, last = own[:, 0], own[:, 1]
                before = peaks(context, other, first, first + AROUND - WIDTH)
                inside = peaks(act, chunk, first + AROUND, last + AROUND - WIDTH)
                after = peaks(context, other, last + AROUND, last + 2 * AROUND - WIDTH)
            values.append(np.stack([before[0], inside[0], after[0]], 1))
            chars.append(np.stack([before[1], inside[1], after[1]], 1))
            i = j
        return np.concatenate(values), np.concatenate(chars)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled.reshape(len(pooled), -1) @ self.out + self.shift[0]

    def scores(self, codes: np.ndarray, masked: np.ndarray, spans: list[tuple[int, int]], tables: np.ndarray) -> np.ndarray:
        """Scores of candidates, in order."""
        return self.chance(self.logits(self.pooled(codes, masked, spans, tables)[0]))

    def slopes(self, pooled: np.ndarray, chars: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted loss, from what ``pooled`` returns."""
        d = (1 / (1 + np.exp(-np.clip(self.logits(pooled), -30, 30))) - y) * weight
        d_pool = (d[:, None] * self.out).reshape(pooled.shape) * (pooled > 0)
        d_table = np.zeros(WIDTH * 128 * FILTERS)
        for k in range(0, len(d), 2 * STEP):
            place = (np.arange(WIDTH) * 128 + chars[k:k + 2 * STEP]) * FILTERS + np.arange(FILTERS)[:, None]
            d_table += np.bincount(place.ravel(), np.repeat(d_pool[k:k + 2 * STEP].ravel(), WIDTH), len(d_table))
        d_table = d_table.reshape(WIDTH, 128, FILTERS)
        conv = self.conv.reshape(WIDTH, EMBED, FILTERS)
        return [np.einsum("wef,wcf->ce", conv, d_table), np.einsum("ce,wcf->wef", self.embed, d_table).reshape(self.conv.shape),
                d_pool.sum((0, 1)), pooled.reshape(len(pooled), -1).T @ d, np.array([d.sum()])]


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.first, self.second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def move(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, m, v in zip(self.params, slopes, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)


def calibrate(net: Network, logit: np.ndarray, truth: np.ndarray, weight: np.ndarray, recall: float) -> Network:
    """Set the curve and the threshold by findings that the weights were not fitted on; ``weight`` says how many each stands for."""
    mean = lambda x: np.average(x, weights=weight)
    theta = np.array([1.0, 0.0])
    for _ in range(200):  # calibration curve, drawn a little to the identity so that it stays finite
        p = 1 / (1 + np.exp(-np.clip(theta[0] * logit + theta[1], -30, 30)))
        theta = theta - 0.05 * (np.array([mean((p - truth) * logit), mean(p - truth)]) + 0.05 * (theta - np.array([1.0, 0.0])))
    net.scale, net.offset = float(max(theta[0], 0.05)), float(theta[1])
    p, yes = net.chance(logit), truth == 1
    order = np.argsort(p[yes], kind="stable")
    up_to = np.cumsum(weight[yes][order])
    net.threshold = float(p[yes][order][np.searchsorted(up_to, int((1 - recall) * up_to[-1]), "right")])
    over = p >= net.threshold
    net.recall = float(weight[yes & over].sum() / weight[yes].sum())
    net.precision = float(weight[yes & over].sum() / weight[over].sum())
    return net


def fit(found: list[bytes], y: np.ndarray, recall: float = RECALL, seed: int = SEED) -> Network:
    """Train by Adam on four fifths of each class; calibrate and set the threshold on the rest (on all, of a class of under 5)."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.5, (128, EMBED)), rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
                  np.zeros(FILTERS), rng.normal(0, 0.2, 3 * FILTERS), np.zeros(1))
    rank = np.zeros(len(y), int)
    for t in (0, 1):
        rank[y == t] = np.arange((y == t).sum())
    check = np.array([(y == t).sum() < 5 for t in (0, 1)])[y.astype(int)] | (rank % 5 == 0)
    seen = np.flatnonzero(~check | np.array([(y == t).sum() < 5 for t in (0, 1)])[y.astype(int)])
    seen = seen[np.argsort([len(found[i]) for i in seen], kind="stable")]  # batches of about equal length
    adam = Adam(net.params(), RATE)
    batches = [seen[i::max(1, len(seen) // BATCH)] for i in range(max(1, len(seen) // BATCH))]
    for _ in range(EPOCHS):
        for b in rng.permutation(len(batches)):
            adam.move(net.gradients([found[i] for i in batches[b]], y[batches[b]]))
    held = np.flatnonzero(check)
    logit = np.concatenate([net.forward([found[i] for i in held[k:k + 256]])[0] for k in range(0, len(held), 256)])
    return calibrate(net, logit, y[held], np.ones(len(held)), recall)


def values_of(text: str, spans: list[Span]) -> list[tuple[int, int, int]]:
    """Confirmed values and where their span begins: (start, end, head)."""
    return [(m.start(2), m.end(2), s) if kind == 0 and (m := ASSIGN.match(text, s, e)) else (s, e, s) for s, kind, e in spans]


class Joined:
    """Texts and confirmed values one after another, to be convolved together."""

    def __init__(self):
        self.codes, self.masked, self.spans, self.marks, self.size = [], [], [], [], 0

    def add(self, codes: np.ndarray, masked: np.ndarray, spans: list[tuple[int, int]], mark: int) -> None:
        self.spans += [(a + self.size, b + self.size) for a, b in spans]
        self.marks += [mark] * len(spans)
        self.codes.append(codes)
        self.masked.append(masked)
        self.size += len(codes)

    def value(self, found: bytes) -> None:
        codes = np.frombuffer(found, np.uint8)
        self.add(codes, codes, [(0, len(codes) - 2 * AROUND)], 1)

    def text(self, text: str) -> list[bytes]:
        """Adds the other candidates of a text and its confirmed values; returns the latter."""
        spans, others = rule_spans(text)
        if not spans and not others:
            return []
        codes, masked = codes_of(text)
        if others:
            self.add(codes, masked, others, 0)
        values = [finding(codes, masked, s, e, head) for s, e, head in values_of(text, spans)]
        for found in values:
            self.value(found)
        return values

    def full(self) -> bool:
        return len(self.spans) >= STEP or self.size >= CHARS

    def pooled(self, net: Network, tables: np.ndarray, windows: bool = False):
        return net.pooled(np.concatenate(self.codes), np.concatenate(self.masked), self.spans, tables, windows)


def _steps(net: Network, known: list[bytes]):
    """The weights after one pass over all findings of a task's documents, times the number of findings, in exact decimals.

    Both classes weigh the same in a step.  As confirmed findings are rare, each step sees some again: of those
    that the task met so far and of the ``known`` ones it begins with, up to ``LONGEST`` characters long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = replace(net, **{k: getattr(net, k).copy() for k in ("embed", "conv", "bias", "out", "shift")})
        adam, rng, met, seen, now = Adam(own.params(), SLOW), np.random.default_rng(SEED), list(known), 0, Joined()

        def step() -> None:
            for k in rng.integers(len(met), size=AGAIN).tolist():
                now.value(met[k])
            y = np.array(now.marks, float)
            adam.move(own.slopes(*now.pooled(own, own.tables(), True), y, np.where(y == 1, 0.5 / y.sum(), 0.5 / max((y == 0).sum(), 1))))
        for batch in batches:
            for text in batch.column(0):
                met += [x for x in now.text(text.as_py()) if len(x) <= LONGEST + 2 * AROUND]
                if now.full():
                    seen += len(now.spans)
                    step()
                    now = Joined()
        if now.spans:
            seen += len(now.spans)
            step()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([p.ravel() for p in own.params()])], pa.list_(pa.float64())),
                                          pa.array([seen], pa.int64())], ["weights", "n"])
    return run


def _counted(net: Network):
    """Findings by class and bin of their logit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, n, now = net.tables(), Counter(), Joined()

        def count() -> None:
            at = np.clip(np.floor(net.logits(now.pooled(net, tables)[0]) * BINS), -FAR * BINS, FAR * BINS).astype(int)
            n.update(zip(now.marks, at.tolist()))
        for batch in batches:
            for text in batch.column(0):
                now.text(text.as_py())
                if now.full():
                    count()
                    now = Joined()
        if now.spans:
            count()
        yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in n], pa.int32()), pa.array([k for _, k in n], pa.int32()),
                                          pa.array(list(n.values()), pa.int64())], ["y", "at", "n"])
    return run


def fit_all(net: Network, known: list[bytes], fitted: DataFrame, kept_out: DataFrame, recall: float = RECALL) -> Network | None:
    """From the first weights, fit on all findings of ``fitted`` texts; curve and threshold by all of ``kept_out`` ones.

    None if the latter have no confirmed finding.
    """
    got = fitted.mapInArrow(_steps(net, known), "weights array<double>, n long").where("n > 0").select(
        "n", F.posexplode("weights")).groupBy("pos").agg(
        F.sum(F.col("col").cast("decimal(18,12)") * F.col("n")).alias("total"), F.sum("n").alias("n")).orderBy("pos").collect()
    net.seen = int(got[0]["n"]) if got else 0
    flat, at = np.array([float(r["total"] / r["n"]) for r in got]), 0
    for p in net.params() if got else ():
        p[...] = flat[at:at + p.size].reshape(p.shape)
        at += p.size
    held = kept_out.mapInArrow(_counted(net), "y int, at int, n long").groupBy("y", "at").agg(
        F.sum("n").alias("n")).orderBy("y", "at").toPandas()  # at most 2 * (2 * FAR * BINS + 1) rows
    if not (held["y"] == 1).any():
        return None
    return calibrate(net, held["at"].to_numpy() / BINS, held["y"].to_numpy(float), held["n"].to_numpy(float), recall)


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled findings: codes with surroundings, and whether a rule confirms them.  Documents not sampled give confirmed ones only."""
    for batch in batches:
        found, marks, out = [], [], []
        for text, sampled, held in zip(batch.column(0), batch.column(1), batch.column(2)):
            text = text.as_py()
            spans, others = rule_spans(text)
            if not spans and not sampled.as_py():
                continue
            pairs = [(*v, 1) for v in values_of(text, spans)] + [(a, b, a, 0) for a, b in others if sampled.as_py()]
            codes, masked = codes_of(text)
            for s, e, head, y in pairs:
                if e - s <= LONGEST:
                    found.append(finding(codes, masked, s, e, head))
                    marks.append(y)
                    out.append(held.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(marks, pa.int32()), pa.array(out, pa.bool_())],
                                         ["codes", "y", "held"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          findings: int = FINDINGS, recall: float = RECALL) -> Network | None:
    """Fit on the findings of all documents but the fifth that is kept out; all of that fifth set curve and threshold.

    The findings of about ``sample_docs`` documents, at most ``findings`` of each class by hash, only give the weights
    from which the pass over all documents starts; with few confirmed ones among them, those of all documents are read.
    With fewer than ``FEW``, or none in the fifth, no document is kept out.  None if there are no confirmed ones of up to
    ``LONGEST`` characters, or no other candidate: then there is nothing to learn from.
    """
    share = min(1.0, sample_docs / max(docs.count(), 1))
    text = no_null(F.col(text_col).cast("string"))
    slim = docs.select(text.alias("text"), (hash60(SEED, F.col(id_col)) <= int(share * (1 << 60))).alias("sampled"),
                       (F.crc32(text) % FOLDS == 0).alias("held"))
    schema = "codes binary, y int, held boolean"

    def of(rows: DataFrame, mark: int) -> list[bytes]:
        got = rows.where(F.col("y") == mark).select("codes").distinct().orderBy(F.md5("codes")).limit(findings)
        return [x.as_py() for x in got.toArrow().column(0)]
    near = cut_lineage(slim.where("sampled").mapInArrow(_findings, schema).distinct())
    sure = near.where("y = 1")
    if share < 1 and len(of(sure, 1)) < ENOUGH:
        sure = cut_lineage(slim.withColumn("sampled", F.lit(False)).mapInArrow(_findings, schema))
    part = sure.where("not held").select("codes").distinct().limit(FEW).count() >= FEW
    yes, no = (of(rows.where("not held") if part else rows, y) for rows, y in ((sure, 1), (near, 0)))
    if not yes or not no:
        return None
    net = fit(yes + no, np.array([1.0] * len(yes) + [0.0] * len(no)), recall)
    texts = slim.select("text", "held")
    fitted, kept_out = (texts.where("not held"), texts.where("held")) if part else (texts, texts)
    return fit_all(net, yes[:AGAIN], fitted, kept_out, recall) or fit_all(net, yes[:AGAIN], texts, texts, recall)


def _scan(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net is not None else None
        for batch in batches:
            found, now, rows = [], Joined(), []

            def score() -> None:
                p = np.split(net.scores(np.concatenate(now.codes), np.concatenate(now.masked), now.spans, tables),
                             np.cumsum([len(others) for _, others in rows])[:-1])
                for (spans, others), own in zip(rows, p):
                    spans += [(others[i][0], 3, others[i][1]) for i in np.flatnonzero(own >= net.threshold).tolist()]
            for text in batch.column(1):
                text = text.as_py()
                spans, others = rule_spans(text)
                found.append(spans)
                if net is not None and others:
                    now.add(*codes_of(text), others, 0)
                    rows.append((spans, others))
                    if now.full():
                        score()
                        now, rows = Joined(), []
            if rows:
                score()
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                                                      ("end", pa.int64())])))], ["doc_id", "spans"])
    return run


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
                 recall: float = RECALL) -> DataFrame:
    """One row per input row: ``doc_id, spans`` (kind, start, end; by start, then kind), offsets in code points.

    The span of a rule is its whole match.  Kinds: assign, access, hex, and
    model for candidates that touch no rule span and that the network accepts.
    Null and empty texts have no spans.  Where no rule finds anything in the
    whole table, or no other candidate exists, only the rules apply.  Repeated rows each give a row; extra columns are
    ignored.
    """
    net = train(docs, id_col, text_col, sample_docs, recall=recall)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_null(F.col(text_col).cast("string")).alias("text"))
    return slim.mapInArrow(_scan(net), "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>")
