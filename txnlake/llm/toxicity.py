"""Operator 3, toxicity: multiple-instance learning over sentences.

A document is a bag of sentences.  Each sentence has a logistic score over
its words and word beginnings, and the document's probability is their
noisy-or, 1 - prod(1 - p).  Only document labels are needed for training:
the gradient of the noisy-or passes through to the sentences.  Scoring
applies the model to every sentence of every whole text and can name the
offending sentences.

Every clean sentence has some small score, so a plain noisy-or rises with
length alone.  The bag score is calibrated for the number of sentences n: a
floor c(n) is taken off each sentence's -log(1 - p), the least one at which n
sentences like those of the sample's clean texts add up to ``NOISE`` at most.
For short texts it is 0.  Clean sentences that alone would be an alarm are
errors and not background, so the floor stays below ``ALARM``, whatever n.

The model is fitted on the driver from whole texts of a bounded sample of
labelled rows: by hash order, ``train_docs`` of them at most, and no more once
``train_chars`` characters are reached in total; its vocabulary is bounded by
that sample.  Scoring is one Arrow pass without a shuffle.

Defined cases: null and empty texts have no sentence; they get the model's
``empty`` score, the share of label 1 among the sample's empty texts (0
without any).  No usable labels give score 0 everywhere; labels of one class
only give that class.  Repeated rows are scored one by one.  Extra columns
pass through unless they carry an output name, which is then replaced.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGE = ".,;:!?\"'()[]"
#: Lengths of the word beginnings that are features besides the word.
HEADS = (4, 5, 6)
#: Sum of -log(1 - p) that a clean text of any length may be expected to gather.
NOISE = 0.05
#: A sentence's -log(1 - p) that makes a text toxic at the default threshold of 0.3.
ALARM = -math.log1p(-0.3)


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def _hazard(p: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.minimum(p, 1 - 1e-12))


def features(word: str) -> list[str]:
    word = word.strip(_EDGE)
    return [word, *(f"{word[:n]}*" for n in HEADS if len(word) > n)] if word else []


@dataclass
class Background:
    """-log(1 - p) of clean sentences: the distinct ``levels``, falling, and the mean excess over each."""

    levels: np.ndarray = field(default_factory=lambda: np.zeros(1))
    excess: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @classmethod
    def of(cls, hazards: np.ndarray) -> Background:
        if not len(hazards):
            return cls()
        levels, times = np.unique(hazards, return_counts=True)
        levels, times = np.append(levels[::-1], 0.0), np.append(times[::-1], 0)
        above, total = np.cumsum(times), np.cumsum(times * levels)
        return cls(levels, np.maximum(0, total - above * levels) / len(hazards))

    def floor(self, n: int) -> float:
        """The least level over which ``n`` clean sentences are expected to gather ``NOISE`` at most."""
        return float(np.interp(NOISE / n, self.excess, self.levels))


@dataclass
class BagModel:
    """Word weights, sentence bias, the score of a text without sentences, and clean background."""

    weights: dict[str, float]
    bias: float
    empty: float
    background: Background = field(default_factory=Background)
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        w = self._known.get(word)
        if w is None:
            if len(self._known) > 400_000:
                self._known.clear()
            w = sum(self.weights.get(f, 0.0) for f in features(word))
            self._known[word] = w
        return w

    def sentence_scores(self, parts: list[str]) -> np.ndarray:
        of = self.word
        z = self.bias + np.array([sum(map(of, s.lower().split())) for s in parts])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def score(self, text: str) -> tuple[float, int]:
        """Calibrated noisy-or of the sentences, and the place of the worst sentence (-1: none)."""
        parts = sentences(text)
        if not parts:
            return self.empty, -1
        p = self.sentence_scores(parts)
        over = np.maximum(0, _hazard(p) - self.background.floor(len(p)))
        return float(-np.expm1(-over.sum())), int(p.argmax())


def fit(texts: list[str], labels: list[int], min_docs: int = 4, min_g: float = 16.0,
        steps: int = 600, rate: float = 0.5, l2: float = 1e-6) -> BagModel:
    """Full-batch AdaGrad on the noisy-or log loss.

    Features are those in ``min_docs`` sample documents whose likelihood-ratio
    statistic between the classes reaches ``min_g``.
    """
    void = [y for t, y in zip(texts, labels) if not sentences(t)]
    empty = sum(void) / len(void) if void else 0.0
    full = [(t, y) for t, y in zip(texts, labels) if sentences(t)]
    y = np.array([y for _, y in full], float)
    if not len(y) or y.min() == y.max():
        return BagModel({}, 40.0 if len(y) and y[0] else -40.0, empty)

    cut = functools.lru_cache(100_000)(features)
    seen = (Counter(), Counter())
    for text, label in full:
        seen[int(label)].update({f for w in set(text.lower().split()) for f in cut(w)})
    n1, n0 = y.sum(), len(y) - y.sum()
    every = sorted(seen[0].keys() | seen[1].keys())
    counts = np.array([[seen[1][f], seen[0][f]] for f in every], float).reshape(-1, 2)
    expected = counts.sum(1, keepdims=True) * np.array([n1, n0]) / len(y)
    g = 2 * (counts * np.log(np.maximum(counts, 1e-9) / expected)).sum(1)
    names = [f for f, x, c in zip(every, g, counts.sum(1)) if x >= min_g and c >= min_docs]
    index = {f: k for k, f in enumerate(names)}
    del seen, every, counts, expected, g
    doc_of, row, col, count = [], [], [], []
    for d, (text, _) in enumerate(full):
        for sentence in sentences(text):
            bag = Counter(index[f] for w in sentence.lower().split() for f in cut(w) if f in index)
            row += [len(doc_of)] * len(bag)
            col += bag.keys()
            count += bag.values()
            doc_of.append(d)
    doc_of, row, col = np.array(doc_of), np.array(row, int), np.array(col, int)
    count = np.array(count, float)
    w, b = np.zeros(len(names)), -4.0
    gw, gb = np.full(len(names), 1e-8), 1e-8
    for _ in range(steps):
        z = np.clip(b + np.bincount(row, w[col] * count, minlength=len(doc_of)), -40, 40)
        s = np.bincount(doc_of, np.logaddexp(0, z), minlength=len(y))  # -log prod(1 - p)
        pull = np.where(y > 0, -1 / np.expm1(np.maximum(s, 1e-6)), 1.0) / len(y)
        g = pull[doc_of] / (1 + np.exp(-z))
        grad = np.bincount(col, g[row] * count, minlength=len(names)) + l2 * w
        gw += grad ** 2
        gb += g.sum() ** 2
        w -= rate * grad / np.sqrt(gw)
        b -= rate * g.sum() / np.sqrt(gb)
    model = BagModel({f: float(v) for f, v in zip(names, w) if abs(v) > 1e-4}, float(b), empty)
    clean = [_hazard(model.sentence_scores(sentences(t))) for t, label in full if not label]
    clean = np.concatenate(clean)
    model.background = Background.of(clean[clean < ALARM])
    return model


def train(docs: DataFrame, labels: DataFrame, train_docs: int = 8000,
          train_chars: int = 48_000_000) -> BagModel:
    """Fit on whole texts of ``labels(doc_id, toxic)`` rows: ``train_docs`` at most, in hash order.

    The row that reaches ``train_chars`` characters in total is the last one.
    """
    order = [F.xxhash64("doc_id"), "doc_id", "toxic"]
    few = labels.where("toxic is not null").select("doc_id", "toxic").orderBy(*order).limit(train_docs)
    # at most train_docs ids: a bounded broadcast
    chars = (docs.select("doc_id", F.length("text").alias("n")).join(F.broadcast(few), "doc_id")
             .groupBy("doc_id", "toxic").agg(F.sum("n").alias("n")).orderBy(*order).collect())
    total = np.cumsum([r.n or 0 for r in chars])
    used = [(r.doc_id, r.toxic) for r in chars[:int(np.searchsorted(total, train_chars)) + 1]]
    if not used:
        return fit([], [])
    kept = few.join(F.broadcast(docs.sparkSession.createDataFrame(used, few.schema)),
                    ["doc_id", "toxic"], "left_semi")
    rows = (docs.select("doc_id", "text").join(F.broadcast(kept), "doc_id")
            .orderBy("doc_id", "toxic", "text").collect())
    return fit([r.text or "" for r in rows], [int(r.toxic) for r in rows])


def score_toxicity(docs: DataFrame, model: BagModel, threshold: float = 0.3,
                   spans: bool = False) -> DataFrame:
    """``docs`` + score, predicted (and ``offending``: the sentences at or above threshold)."""
    made = ["score", "predicted", *["offending"] * spans]
    keep = [c for c in docs.columns if c not in made]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary of the bounded sample

    def offending(text: str) -> list[str]:
        parts = sentences(text)
        p = shared.value.sentence_scores(parts) if parts else []
        return [s for s, x in zip(parts, p) if x >= threshold]

    @F.pandas_udf("score double, offending array<string>" if spans else "score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            texts_ = batch.fillna("").tolist()
            out = {"score": [shared.value.score(t)[0] for t in texts_]}
            yield pd.DataFrame(out | ({"offending": [offending(t) for t in texts_]} if spans else {}))

    scored = docs.select(*keep, judge(F.col("text")).alias("__op3"))
    return scored.select(*keep, F.col("__op3.score").alias("score"),
                         (F.col("__op3.score") >= threshold).cast("int").alias("predicted"),
                         *[F.col("__op3.offending").alias("offending")] * spans)


def held_out(doc_id: str = "doc_id"):
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of the labels outside the held-out fold."""
    ready(spark)
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    model = train(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted toxic go."""
    ready(spark)
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    text_only = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    scored = score_toxicity(text_only, train(docs, labels))
    return scored.where("predicted = 0").select("__row.*")
