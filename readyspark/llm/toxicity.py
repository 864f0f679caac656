"""Toxicity by multiple-instance learning (operator 1).

A document is a bag of sentences, and only the bag is labelled. A sentence's
probability is a logistic function of its distinct words, each by itself and by
its beginnings (so inflected forms share weight); a document's is their
noisy-or, 1 - product(1 - p): toxic if any sentence is. Training pushes the
document's likelihood back through the noisy-or, so the weight settles on the
sentences that explain the label, and the same sentence probabilities then
locate the offending sentences.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents of
each label, those of least id hash, whole texts, in one task. Its features are those
in at least ``MIN_DOCS`` sampled documents that toxic documents have clearly more
often (``MIN_CHI2``); the few that keep a weight go to every task. Training uses the plain
noisy-or, whose gradient reaches every sentence; scores use p' = max(0, p - FLOOR) /
(1 - FLOOR) for p, or the many harmless sentences of a very long document would add
up. So a score is at most the plain noisy-or, and less by at most the floor's share
of each sentence (``floored``).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import crc32_of, prepare_python, strings, tidy, written

SAMPLE = 3000      # documents of each label that the fit reads at most
MIN_DOCS = 3
MIN_CHI2 = 6.0
PREFIXES = (4, 5, 6, 7, 8)  # beginnings of a word that are features, in characters
WORDS = 300_000    # word weights that a worker remembers
TURNS = 300
RATE = 0.5
L1 = 2e-4
FLOOR = 0.1
OFFENDING = 0.5    # sentence probability from which it is located
RUN_WORDS = 40     # a longer sentence is several instances
THRESHOLD = 0.7

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
BIAS = ""


def instances(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Spans (code points) and lower-cased words of a text's sentences."""
    low = text.lower()
    # a letter whose lower case is longer would move the spans: then words are lower-cased one by one
    by_word = len(low) != len(text)
    for m in SENTENCE.finditer(text if by_word else low):
        words = [w.lower() for w in WORD.findall(m[0])] if by_word else WORD.findall(m[0])
        if len(words) <= RUN_WORDS:
            if words:
                yield m.start(), m.end(), words
            continue
        spans = [w.span() for w in WORD.finditer(m[0])]
        for at in range(0, len(words), RUN_WORDS):
            upto = min(at + RUN_WORDS, len(words)) - 1
            yield m.start() + spans[at][0], m.start() + spans[upto][1], words[at:at + RUN_WORDS]


def features(word: str) -> list[str]:
    """The word and its proper beginnings, marked by a trailing hyphen."""
    return [word] + [word[:k] + "-" for k in PREFIXES if k < len(word)]


def telling(bags: list[tuple[int, str]]) -> list[str]:
    """Features that toxic bags hold clearly more often, by the chi-square test."""
    seen = (Counter(), Counter())
    n = Counter(label for label, _ in bags)
    for label, text in bags:
        seen[label].update({f for w in {w for _, _, ws in instances(text) for w in ws} for f in features(w)})
    out = []
    for f, a in seen[1].items():
        c = seen[0][f]
        if a + c < MIN_DOCS or a * n[0] <= c * n[1]:
            continue
        b, d = n[1] - a, n[0] - c
        chi2 = len(bags) * (a * d - b * c) ** 2 / max(1, (a + b) * (c + d) * (a + c) * (b + d))
        if chi2 >= MIN_CHI2:
            out.append(f)
    return sorted(out)


def fit(bags: list[tuple[int, str]]) -> dict[str, float]:
    """Feature weights and the bias of labelled bags (label 0 or 1, text)."""
    place = {f: k for k, f in enumerate(telling(bags))}
    word, inst, bag, n = [], [], [], 0
    known: dict[str, list[int]] = {}
    for k, (_, text) in enumerate(bags):
        for _, _, ws in instances(text):
            for w in set(ws):
                if w not in known:
                    known[w] = [place[f] for f in features(w) if f in place]
                word.extend(known[w])
                inst.extend([n] * len(known[w]))
            bag.append(k)
            n += 1
    word, inst, bag = np.array(word, np.int64), np.array(inst, np.int64), np.array(bag, np.int64)
    y = np.array([label for label, _ in bags], float)
    if not n or y.min() == y.max():  # nothing to tell apart: the share of toxic labels, as a plain bias
        return {BIAS: 50.0 if len(y) and y.min() == 1 else -50.0}
    w, b = np.zeros(len(place)), -4.0
    gw, gb = np.full(len(place), 1e-8), 1e-8
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(TURNS):
        z = np.clip(b + np.bincount(inst, w[word], n), -50, 50)
        p = 1 / (1 + np.exp(-z))
        none = np.minimum(np.bincount(bag, -np.logaddexp(0, z), len(bags)), -1e-9)  # log of no toxic sentence
        pull = np.where(y == 1, -np.exp(none) / -np.expm1(none), 1.0) * share
        g = pull[bag] * p
        dw, db = np.bincount(word, g[inst], len(place)), g.sum()
        gw += dw * dw
        gb += db * db
        step = RATE / np.sqrt(gw)
        w -= step * dw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b -= RATE * db / np.sqrt(gb)
    return {BIAS: float(b), **{x: float(w[k]) for x, k in place.items() if abs(w[k]) > 1e-3}}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> dict[str, float]:
    """Fit on the labelled documents whose crc32(id) mod 3 is not 1. Labels that
    are null or without a document are left out; of several labels of an id the
    largest counts; a repeated document is taken once per row. Without any label
    the model scores every text 0."""
    prepare_python(docs.sparkSession)
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                   .where(crc32_of(F.col(id_col)) % 3 != 1)
                   .groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col).cast("int") > 0).cast("int")).alias("label")))
    # of each label the ids of least hash that have a document: ids only, no texts
    at_hand = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    chosen = [at_hand.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    chosen = written(chosen[0].union(chosen[1]), "sample")  # at most two samples of rows: safe to broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = []
        for b in batches:
            bags += zip(b.column(0).to_pylist(), strings(b.column(1)))
        model = fit(bags)
        yield pa.RecordBatch.from_arrays([pa.array(list(model), pa.string()), pa.array(list(model.values()), pa.float64())],
                                         names=["word", "weight"])

    one = texts.select("label", "text", "id").repartition(1).sortWithinPartitions("id", "text").select("label", "text")
    model = written(one.mapInArrow(tidy(run), "word string, weight double"), "toxicity-model")
    return {BIAS: -50.0} | {r["word"]: r["weight"] for r in model.collect()}


def floored(p: float) -> float:
    """A sentence's part in a score: nothing up to ``FLOOR``, then in proportion up to 1."""
    return max(0.0, p - FLOOR) / (1 - FLOOR)


class Scorer:
    """Noisy-or scores of whole texts and their offending sentences."""

    def __init__(self, model: dict[str, float]):
        self.model, self.bias = model, model[BIAS]
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        if word not in self.known:
            if len(self.known) >= WORDS:
                self.known = {}
            self.known[word] = sum(self.model.get(f, 0.0) for f in features(word))
        return self.known[word]

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        clean, found, weight = 1.0, [], self.weight
        for start, stop, words in instances(text):
            z = self.bias + sum(map(weight, set(words)))
            p = 1 / (1 + math.exp(-max(-50.0, min(z, 50.0))))
            if p > FLOOR:
                clean *= 1 - floored(p)
            if p >= OFFENDING:
                found.append((start, stop, p))
        return 1.0 - clean, found


def score(docs: DataFrame, model: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, ``score``, ``predicted`` and ``offending``, the located
    sentences (``start``, ``stop`` in code points, ``p``).

    Null, empty and wordless texts score 0. Repeated rows and null ids are
    returned as they come. A map over the scan, no shuffle.
    """
    prepare_python(docs.sparkSession)
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            got = [scorer(t) for t in strings(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s for s, _ in got], pa.float64()),
                 pa.array([[{"start": a, "stop": z, "p": p} for a, z, p in f] for _, f in got], pa.list_(span))],
                names=["id", "score", "offending"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    out = read.mapInArrow(tidy(run), f"id {kind}, score double, offending array<struct<start:int,stop:int,p:double>>")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                      "offending")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model trained on them does not reject."""
    prepare_python(docs.sparkSession)
    model = train(docs, labels, id_col, text_col)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            keep = [scorer(t)[0] < THRESHOLD for t in strings(b.column(at))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
