"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each model sees the text
features and the probabilities of the categories before it. For training those
probabilities are out of fold: a document's value comes from models fitted on
the other folds, so later models learn from probabilities as uncertain as the
ones they will meet.

Features say which words, and which beginnings of words, a text holds, hashed
to a fixed number of slots. Slots are chosen on the training rows by how far
they lean towards a category.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import keyed_texts, labels_of, stage

WORD = re.compile(r"\w+")
SLOTS = 1 << 20
# Beginnings of words that are features besides the words themselves.
PREFIXES = (4, 5, 6)
# Labelled rows the chain is fitted on at most, per class of the last category.
MAX_LABELLED = 8_000
# Slots kept, and rows that must hold a slot.
MAX_KEPT, MIN_ROWS = 6_000, 4
FOLDS, STEPS, L2 = 4, 150, 2e-4
THRESHOLD = 0.5
# Telling slots from which a toxic row counts as abusive (a word brings up to four).
MANY = 12
GRADES = ("offensive", "abusive")
# Distinct words whose slots a worker remembers.
CACHE_WORDS = 500_000
_SLOTS: dict[str, tuple] = {}


def slots_of(word: str) -> tuple[int, ...]:
    forms = [word, *[word[:k] + "~" for k in PREFIXES if len(word) >= k]]
    return tuple(xxhash.xxh64_intdigest(f.encode("utf-8", "surrogatepass")) % SLOTS for f in forms)


def text_slots(text: str) -> np.ndarray:
    """The distinct slots a whole text holds."""
    if len(_SLOTS) > CACHE_WORDS:
        _SLOTS.clear()
    found: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        known = _SLOTS.get(w)
        if known is None:
            known = _SLOTS[w] = slots_of(w)
        found.update(known)
    return np.fromiter(found, np.int32, len(found))


class Rows:
    """Sparse presence features of training rows."""

    def __init__(self, slots: list[np.ndarray], kept: np.ndarray | None = None):
        sizes = np.array([len(s) for s in slots], np.int64)
        flat = np.concatenate(slots) if len(slots) else np.zeros(0, np.int32)
        row = np.repeat(np.arange(len(slots)), sizes)
        if kept is not None:
            place = np.searchsorted(kept, flat)
            hit = (place < len(kept)) & (kept[np.minimum(place, len(kept) - 1)] == flat) if len(kept) else np.zeros(len(flat), bool)
            flat, row = place[hit], row[hit]
        self.column, self.row, self.n = flat, row, len(slots)

    def of(self, rows: np.ndarray) -> "Rows":
        out = Rows([])
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        hit = place[self.row] >= 0
        out.column, out.row, out.n = self.column[hit], place[self.row[hit]], len(rows)
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n) if self.n else np.zeros(0)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, g[self.row], size)


def choose(slots: list[np.ndarray], targets: np.ndarray) -> np.ndarray:
    """Slots that lean most towards one of the categories, by the standardised difference of their shares."""
    rows = Rows(slots)
    n = np.bincount(rows.column, minlength=SLOTS).astype(float)
    best = np.zeros(SLOTS)
    for k in range(targets.shape[1]):
        y = targets[:, k]
        if 0 < y.sum() < len(y):
            pos = np.bincount(rows.column, y[rows.row].astype(float), SLOTS)
            expect = n * y.mean()
            best = np.maximum(best, np.abs(pos - expect) / np.sqrt(expect * (1 - y.mean()) + 1))
    kept = np.flatnonzero((n >= MIN_ROWS) & (best >= 3))
    return np.sort(kept[np.argsort(-best[kept], kind="stable")[:MAX_KEPT]])


def linear(x: Rows, extra: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Weights of the slots, of the earlier probabilities and the bias: logistic loss, small L2, Adam on all rows."""
    w = np.zeros(size + extra.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    if not len(y):
        return w
    for t in range(1, STEPS + 1):
        z = x.dot(w[:size]) + extra @ w[size:-1] + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.concatenate([x.back(g, size), extra.T @ g, [g.sum()]]) + L2 * w
        grad[-1] -= L2 * w[-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.15 * (1 - t / (STEPS + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
    return w


def predict(x: Rows, extra: np.ndarray, w: np.ndarray, size: int) -> np.ndarray:
    z = x.dot(w[:size]) + extra @ w[size:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    categories: tuple[str, ...]
    kept: np.ndarray
    weights: list[np.ndarray]

    def score(self, slots: list[np.ndarray]) -> np.ndarray:
        """Probabilities, one column per category in the order of the chain."""
        x = Rows(slots, self.kept)
        out = np.zeros((len(slots), 0))
        for w in self.weights:
            out = np.column_stack([out, predict(x, out, w, len(self.kept))])
        return out


def fit(slots: list[np.ndarray], targets: np.ndarray, categories: tuple[str, ...]) -> Chain:
    """The chain, later models fitted with out-of-fold probabilities of the earlier ones."""
    kept = choose(slots, targets)
    x, n, size = Rows(slots, kept), len(slots), len(kept)
    fold = np.random.default_rng(5).permutation(n) % FOLDS
    earlier, weights = np.zeros((n, 0)), []
    for k in range(len(categories)):
        y = targets[:, k].astype(float)
        weights.append(linear(x, earlier, y, size))
        if k + 1 < len(categories):
            out = np.zeros(n)
            for f in range(FOLDS):
                inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                w = linear(x.of(inside), earlier[inside], y[inside], size)
                out[outside] = predict(x.of(outside), earlier[outside], w, size)
            earlier = np.column_stack([earlier, out])
    return Chain(categories, kept, weights)


def graded(slots: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Two nested categories below one label, for tables that carry no finer ones.

    Telling slots are those held by MIN_ROWS rows of which nine in ten are
    toxic. A toxic row is offensive if it holds one, abusive from MANY on.
    """
    rows = Rows(slots)
    n = np.bincount(rows.column, minlength=SLOTS)
    pos = np.bincount(rows.column, toxic[rows.row].astype(float), SLOTS)
    telling = (n >= MIN_ROWS) & (pos >= 0.9 * n)
    held = np.bincount(rows.row, telling[rows.column].astype(float), rows.n)
    return np.column_stack([(toxic == 1) & (held >= 1), (toxic == 1) & (held >= MANY)]).astype(int)


def with_slots(texts: DataFrame, extra: str) -> DataFrame:
    """``extra`` columns with the slots of each text, as int32 bytes."""
    keep = [c for c in texts.columns if c != "text"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = pa.array([text_slots(t).tobytes() for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], found], [*keep, "slots"])
    return texts.mapInArrow(run, f"{extra}, slots binary")


def train(texts: DataFrame, labels: DataFrame, categories: tuple[str, ...], grade: bool) -> Chain | None:
    """Fit on at most MAX_LABELLED rows of each class of the last category; None where a class is empty."""
    marked = labels_of(labels, *categories)
    for c in categories:
        marked = marked.filter(F.col(c).isNotNull())
    last = F.col(categories[-1])
    sizes = {r[0]: r[1] for r in marked.groupBy(last).count().collect()}  # two rows
    if len([k for k in sizes if k in (0, 1)]) < 2:
        return None
    share = {k: max(1, -(-n // MAX_LABELLED)) for k, n in sizes.items()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.when(last == 1, F.lit(share[1])).otherwise(F.lit(share[0]))) == 0
    # About 2 * MAX_LABELLED rows of a few numbers: they go to the texts, not the texts to them.
    sample = F.broadcast(stage(marked.filter(last.isin(0, 1) & drawn), "toxic-sample"))
    rows = with_slots(texts.join(sample, "doc_id"),
                      "doc_id long, " + ", ".join(f"{c} int" for c in categories)).limit(4 * MAX_LABELLED).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["slots"])))
    slots = [np.frombuffer(r["slots"], np.int32) for r in rows]
    targets = np.array([[r[c] for c in categories] for r in rows], int).reshape(len(rows), len(categories))
    if grade:
        targets, categories = np.column_stack([graded(slots, targets[:, -1]), targets]), (*GRADES, *categories)
    return fit(slots, targets, categories)


def score(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("toxic",), grade: bool = True,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, one probability p_<category> per category, and toxic (1 where the last one reaches THRESHOLD).

    ``categories`` are 0/1 columns of ``labels`` in the order of the chain;
    ``grade`` puts the categories of ``graded`` in front of them. A null or empty text holds no features and gets the chain's biases. Null and
    repeated ids stay, each row for itself. With one class only (or no labels)
    every probability is 0. Other columns are not read.
    """
    texts = keyed_texts(docs, id_col, text_col)
    chain = train(texts, labels, categories, grade)
    names = [f"p_{c}" for c in ((*GRADES, *categories) if grade else categories)]
    if chain is None:
        done = texts.select("doc_id", *[F.lit(0.0).alias(n) for n in names])
    else:
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                if part.num_rows:
                    found = chain.score([text_slots(t) for t in part.column(1).to_pylist()])
                    yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c) for c in found.T]], ["doc_id", *names])
        done = texts.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return done.withColumn("toxic", F.when(F.col(names[-1]) >= THRESHOLD, 1).otherwise(0).cast("int"))
