"""A quality classifier from positives and unlabelled text (PU learning).

Trusted positives are labelled documents of good quality; the unlabelled set
is a sample of all documents, good and bad mixed. A small network is trained
on the non-negative unbiased risk

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))

with the logistic loss, whose minimiser is the probability of being good. If
the bracket falls below zero the step goes against it, so the network cannot
win by memorising the positives. The class prior ``pi`` is estimated from the
same two sets: a first classifier tells positives from unlabelled ones, and
``pi`` is the smallest ratio of the upper tails of its scores (unlabelled over
positive), with a confidence bound so that thin tails do not decide.

Inputs are shares measured on whole texts (symbols, case, repeats, word
shapes); labels, language, source and id are never among them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import held_out, keyed_texts, labels_of, stage
from weekloom.llm.quality_rules import n_upper, repeated_words

# Largest samples the model is fitted on.
MAX_POSITIVE, MAX_UNLABELLED = 20_000, 40_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 1024, 3e-3, 1e-4
THRESHOLD = 0.7
NAMES = ("words", "word_length", "symbols", "bars", "marks", "digits", "upper", "stops", "line_length", "dup_lines",
         "repeats", "runs", "variety", "top_word", "entropy", "long_words")


def describe(text: str) -> list[float]:
    """The inputs of one text; all zero where it has no words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    counts = Counter(words)
    top = max(counts.values())
    count = text.count
    spread = -sum(c * math.log(c / n) for c in counts.values()) / n / math.log(n + 1)
    return [math.log1p(n), math.log1p(chars / n), sum(map(count, "#*$%&<>=\\^~@")) / chars, count("|") / chars,
            (count("!") + count("?")) / chars, sum(map(count, "0123456789")) / chars, n_upper(text) / chars,
            (count(".") + count(",")) / chars, math.log1p(chars / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
            repeated_words(words) / n, sum(map(str.__eq__, words[1:], words)) / n, math.log(len(counts)) / math.log(n + 1),
            top / n, spread, sum(len(w) > 24 for w in counts) / len(counts)]


def inputs(texts: DataFrame) -> DataFrame:
    """doc_id and the inputs of every text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [describe(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])
    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Standardised inputs, one hidden layer, a probability."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float = 0.5

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(self.standard(x) @ w1 + b1) @ w2 + b2[0]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 7) -> Model:
    """Minimise the PU risk, or with ``prior`` None the plain risk of positives against unlabelled rows.

    Only the slope of the risk at the outputs differs; the network and its
    updates (Adam on minibatches) are the same.
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-6, [])
    d = both.shape[1]
    w = [rng.normal(0, 1 / math.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    p_all, u_all = model.standard(positive), model.standard(unlabelled)
    steps = max(1, min(200, max(len(p_all), len(u_all)) // BATCH))
    for epoch in range(EPOCHS):
        for _ in range(steps):
            p, u = p_all[rng.integers(len(p_all), size=BATCH)], u_all[rng.integers(len(u_all), size=BATCH)]
            x = np.concatenate([p, u])
            h = np.tanh(x @ w[0] + w[1])
            z = h @ w[2] + w[3][0]
            s = sigmoid(z)
            sp, su = s[:BATCH], s[BATCH:]
            if prior is None:
                slope = np.concatenate([sp - 1, su]) / BATCH
            else:
                # Losses: log(1 + e^-z) as positive, log(1 + e^z) as negative.
                rest = np.logaddexp(0, z[BATCH:]).mean() - prior * np.logaddexp(0, z[:BATCH]).mean()
                if rest >= 0:
                    slope = np.concatenate([prior * (sp - 1) - prior * sp, su]) / BATCH
                else:
                    slope = np.concatenate([prior * sp, -su]) / BATCH
            back = np.outer(slope, w[2]) * (1 - h * h)
            grads = [x.T @ back + DECAY * w[0], back.sum(0), h.T @ slope + DECAY * w[2], np.array([slope.sum()])]
            t += 1
            rate = RATE * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS))
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    model.weights = w
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.05) -> float:
    """Share of good rows among the unlabelled: the smallest bounded ratio of upper tails of a separating score."""
    rng = np.random.default_rng(11)
    p, u = rng.permutation(positive), rng.permutation(unlabelled)
    half_p, half_u = len(p) // 2, len(u) // 2
    score = fit(p[:half_p], u[:half_u], None, seed=3)
    sp, su = np.sort(score.logits(p[half_p:])), np.sort(score.logits(u[half_u:]))
    slack = math.sqrt(math.log(4 / delta) / 2)
    best, ratio = math.inf, 1.0
    for c in np.quantile(sp, np.linspace(0, 0.98, 99)):
        tail_p = 1 - np.searchsorted(sp, c) / len(sp)
        tail_u = 1 - np.searchsorted(su, c) / len(su)
        bound = (tail_u + slack / math.sqrt(len(su)) + slack / math.sqrt(len(sp))) / max(tail_p, 1e-9)
        if bound < best:
            best, ratio = bound, tail_u / tail_p
    return float(np.clip(ratio, 0.01, 0.99))


def train(x: DataFrame, labels: DataFrame, seed: int = 0) -> Model | None:
    """Fit on bounded samples: positives outside the held-out part, and unlabelled rows drawn from all documents.

    None where there are fewer than 20 of either.
    """
    trusted = labels_of(labels, "quality").filter((F.col("quality") == 1) & ~held_out()).select("doc_id")

    def drawn(rows: DataFrame, most: int) -> np.ndarray:
        total = rows.count()
        share = max(1, -(-total // most))
        found = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(share)) == 0).select("x").limit(2 * most)
        return np.array([r["x"] for r in found.collect()]).reshape(-1, len(NAMES))

    positive, unlabelled = drawn(x.join(trusted, "doc_id", "left_semi"), MAX_POSITIVE), drawn(x, MAX_UNLABELLED)
    if min(len(positive), len(unlabelled)) < 20:
        return None
    prior = class_prior(positive, unlabelled)
    model = fit(positive, unlabelled, prior)
    model.prior = prior
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (probability of good quality), predicted, and the class prior used.

    A null or empty text has all inputs zero and is scored like any other; null
    and repeated ids stay, each row for itself, and never carry labels twice.
    Without enough positives every score is 0.5. Other columns are not read.
    """
    x = stage(inputs(keyed_texts(docs, id_col, text_col)), "pu-inputs")
    model = train(x, labels)
    if model is None:
        done = x.withColumn("score", F.lit(0.5)).withColumn("prior", F.lit(0.5))
    else:
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                if part.num_rows:
                    flat = part.column(1).flatten().to_numpy().reshape(part.num_rows, len(NAMES))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.probability(flat))], ["doc_id", "score"])
        done = x.mapInArrow(run, "doc_id long, score double").withColumn("prior", F.lit(model.prior))
    return done.select("doc_id", held_out().alias("held_out"), "score",
                       F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"), "prior")
