"""Boosted trees and forests grown level by level over one staged table, many trees in the same scans.

Features are cut into bins once. For every level one scan adds up histograms
(node, feature, bin) of all growing trees, of all classes, folds and parameter
combinations; the histograms of a node meet by blocks of features, where the
best cut is found, and only one cut per node comes to the driver. Where the
histograms of a level are larger than ``CELLS`` they are made in several scans.

Boosting follows softmax loss by first and second derivatives: with
T(G) = sign(G) max(|G| - reg_alpha, 0) a node has the value
-T(G) / (H + reg_lambda) and a cut the gain T(GL)^2 / (HL + reg_lambda)
+ T(GR)^2 / (HR + reg_lambda) - T(G)^2 / (H + reg_lambda).
Forests use the decrease of Gini impurity on weighted class counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.models.design import FAN_IN, block_counts, matrices, numbers, training_counts, training_medians
from weekloom.models.linear import class_weights
from weekloom.session import stage

BINS, MISSING = 64, 255
# Numbers of the histograms one scan makes, and features of a block.
CELLS, BLOCK = 4_000_000, 64
# Boosting rounds after which the scores of all rows are written anew.
RESTAGE = 10
# Shares of a Poisson distribution of mean 1, summed: how often a row is drawn into a tree.
DRAWN = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(12)])


@dataclass
class Tree:
    """Nodes in order of creation; a leaf has feature -1. ``stats`` are the sums of the rows that reached a node."""

    model: int
    params: Mapping[str, Any]
    cls: int = -1
    number: int = 0
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[np.ndarray | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        for side, stats in ((self.left, left), (self.right, right)):
            side[node] = len(self.feature)
            for column, value in zip((self.feature, self.cut, self.left, self.right, self.depth, self.gain, self.stats),
                                     (-1, 0, -1, -1, self.depth[node] + 1, 0.0, stats)):
                column.append(value)
        return self.left[node], self.right[node]

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf each row of bins ends in."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        at, open_ = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(open_):
            open_ = open_[feature[at[open_]] >= 0]
            here = at[open_]
            at[open_] = np.where(bins[open_, feature[here]] > cut[here], right[here], left[here])
        return at


def bin_edges(design: DataFrame, width: int, most: int = BINS) -> list[np.ndarray]:
    """Cut values per feature: all values but the greatest where there are few, else approximate quantiles."""
    long = design.select(F.posexplode("x").alias("feature", "value")).filter(~F.isnan("value"))
    shares = F.array(*[F.lit(k / most) for k in range(1, most)])
    found = long.groupBy("feature").agg(F.approx_count_distinct("value", 0.02).alias("n"), F.percentile_approx("value", shares, 10_000).alias("at"),
                                        F.max("value").alias("top")).collect()  # one row per feature
    edges = [np.zeros(0)] * width
    few = []
    for r in found:
        if r["n"] <= most * 0.9:
            few.append(r["feature"])
        else:
            edges[r["feature"]] = np.unique([v for v in r["at"] if v < r["top"]])
    if few:
        values: dict[int, list[float]] = {f: [] for f in few}
        for r in long.filter(F.col("feature").isin(few)).distinct().collect():  # at most about ``most`` values of each
            values[r["feature"]].append(r["value"])
        for f, v in values.items():
            edges[f] = np.sort(np.array(v))[:-1]
    return edges


def binned(design: DataFrame, edges: Sequence[np.ndarray]) -> DataFrame:
    """Stage code, fold, row and the bin of every feature in one byte each."""
    width = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, width):
            b = bins_of(x, edges)
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in ("code", "fold", "row")),
                                              pa.array([r.tobytes() for r in b], pa.binary())], ["code", "fold", "row", "bins"])
    return stage(design.mapInArrow(run, "code int, fold int, row long, bins binary"), "binned")


def bins_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(e, x[:, f], side="left"))
    return out


def _filled(bins: np.ndarray, medians: np.ndarray) -> np.ndarray:
    return np.where(bins == MISSING, medians, bins)


def _grown(table: DataFrame, trees: Sequence[Tree], width: int, size: int, rows_of: Callable, score: Callable, goes_on: Callable) -> None:
    """Grow all trees together until ``goes_on(tree, node)`` holds for no node.

    ``rows_of(part, bins, tree number)`` gives the rows a tree learns from, their bins and their
    sums (row, ``size``); ``score(tree, node, left, right, total)`` the gains of all cuts, -inf where not allowed.
    """
    active = [(t, 0) for t in range(len(trees))]
    while active:
        several = max(1, CELLS // (width * BINS * size))
        found: dict[tuple[int, int], tuple] = {}
        for at in range(0, len(active), several):
            found |= _cuts(table, trees, active[at:at + several], width, size, rows_of, score)
        following = []
        for t, node in active:
            tree, (gain, feature, cut, left, total) = trees[t], found.get((t, node), (-np.inf, -1, 0, np.zeros(size), np.zeros(size)))
            tree.stats[node] = total
            if gain > 0 and goes_on(tree, node):
                following += [(t, child) for child in tree.split(node, feature, cut, gain, left, total - left) if goes_on(tree, child)]
        active = following


def _cuts(table: DataFrame, trees: Sequence[Tree], nodes: Sequence[tuple[int, int]], width: int, size: int, rows_of: Callable, score: Callable) -> dict:
    """Best cut of each node as (gain, feature, cut, sums of the left side, sums of the node)."""
    mine: dict[int, list[tuple[int, int]]] = {}
    for k, (t, node) in enumerate(nodes):
        mine.setdefault(t, []).append((k, node))
    sent = table.sparkSession.sparkContext.broadcast(list(trees))

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, total, seen = sent.value, np.zeros((len(nodes), width, BINS, size)), False
        for batch in batches:
            for k in range(0, batch.num_rows, step := max(1, CELLS // width)):
                part, seen = batch.slice(k, step), True
                raw = np.frombuffer(b"".join(part.column(part.schema.get_field_index("bins")).to_pylist()), np.uint8).reshape(-1, width)
                for t, own in mine.items():
                    _, bins, sums = rows_of(part, raw, t, trees)
                    place = np.full(len(trees[t].feature), -1)
                    for i, (_, node) in enumerate(own):
                        place[node] = i
                    local = place[trees[t].leaves_of(bins)]
                    take = local >= 0
                    local, bins, sums = local[take], bins[take], sums[take]
                    cell = ((local[:, None] * width + np.arange(width)) * BINS + bins).ravel()
                    for s in range(size):
                        got = np.bincount(cell, np.repeat(sums[:, s], width), len(own) * width * BINS).reshape(len(own), width, BINS)
                        for i, (at, _) in enumerate(own):
                            total[at, :, :, s] += got[i]
        if seen:
            for k in range(len(nodes)):
                for f in range(0, width, BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([f], pa.int32()), pa.array([total[k, f:f + BLOCK].tobytes()], pa.binary())],
                                                     ["node", "first", "sums"])

    def plus(pdf: pd.DataFrame) -> np.ndarray:
        return np.sum([np.frombuffer(b) for b in pdf["sums"]], axis=0)

    def some(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": [key[0]], "first": [key[1]], "sums": [plus(pdf).tobytes()]})

    def best(key, pdf: pd.DataFrame) -> pd.DataFrame:
        sums = plus(pdf).reshape(-1, BINS, size)
        t, node = nodes[key[0]]
        left = np.cumsum(sums, axis=1)
        total = left[:, -1:]
        gains = score(sent.value[t], node, left[:, :-1], total - left[:, :-1], total, np.arange(key[1], key[1] + len(sums)))
        f, c = np.unravel_index(np.argmax(gains), gains.shape)
        return pd.DataFrame({"node": [key[0]], "gain": [float(gains[f, c])], "feature": [int(key[1] + f)], "cut": [int(c)],
                             "lsum": [left[f, c].tobytes()], "total": [total[f, 0].tobytes()]})

    parts = table.mapInArrow(histograms, "node int, first int, sums binary").withColumn("_of", F.spark_partition_id() % FAN_IN)
    met = parts.groupBy("node", "first", "_of").applyInPandas(some, "node int, first int, sums binary")
    cuts = met.groupBy("node", "first").applyInPandas(best, "node int, gain double, feature int, cut int, lsum binary, total binary")
    rows = cuts.groupBy("node").agg(F.max_by(F.struct("gain", "feature", "cut", "lsum", "total"), F.struct("gain", -F.col("feature"))).alias("b")).collect()
    sent.unpersist()
    return {nodes[r["node"]]: (r["b"]["gain"], r["b"]["feature"], r["b"]["cut"], np.frombuffer(r["b"]["lsum"]), np.frombuffer(r["b"]["total"])) for r in rows}


def _hashed(row: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per row and seed, the same on every run."""
    x = row.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


@dataclass
class TreeModel:
    """Trees of one combination and fold, with what is needed to use them on raw features."""

    kind: str
    model: int
    params: Mapping[str, Any]
    trees: list[Tree]
    edges: list[np.ndarray]
    medians: np.ndarray
    present: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(row, class), each row summing to 1; 0 for classes without training rows."""
        return self.of_bins(bins_of(np.where(np.isnan(x), self.medians, x), self.edges))

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), len(self.present)))
        if self.kind == "boost":
            for tree in self.trees:
                out[:, tree.cls] += leaf_values(tree)[tree.leaves_of(bins)]
            out = np.where(self.present, out, -np.inf)
            out = np.exp(out - out.max(1, keepdims=True))
        else:
            for tree in self.trees:
                shares = np.array([s[:-1] / max(s[:-1].sum(), 1e-300) for s in tree.stats])
                out += shares[tree.leaves_of(bins)]
        return out / out.sum(1, keepdims=True)

    def table(self, spark: SparkSession, features: Sequence[str]) -> DataFrame:
        """One row per node: tree, class, node, path (L and R from the root), depth, feature, threshold (go left up to it), children, gain, value, stats."""
        rows = []
        for i, t in enumerate(self.trees):
            values = leaf_values(t) if self.kind == "boost" else [None] * len(t.feature)
            path = {0: ""}
            for node, f in enumerate(t.feature):
                inner = f >= 0
                if inner:
                    path |= {t.left[node]: path[node] + "L", t.right[node]: path[node] + "R"}
                rows.append((i, t.cls, node, path[node], t.depth[node], features[f] if inner else None, float(self.edges[f][t.cut[node]]) if inner else None,
                             t.left[node] if inner else None, t.right[node] if inner else None, float(t.gain[node]) if inner else None,
                             None if values[node] is None else float(values[node]), [float(v) for v in t.stats[node]]))
        return spark.createDataFrame(rows, "tree int, cls int, node int, path string, depth int, feature string, threshold double, left int, right int, "
                                           "gain double, value double, stats array<double>")

    def record(self) -> dict[str, Any]:
        """What besides the table of nodes makes up the model."""
        return {"kind": self.kind, "params": dict(self.params), "medians": self.medians.tolist(), "present": [bool(p) for p in self.present]}

    @staticmethod
    def restored(rows: Sequence, features: Sequence[str], record: Mapping[str, Any]) -> "TreeModel":
        """The model of a table of nodes and a record; only thresholds in use stay as cuts."""
        place = {f: i for i, f in enumerate(features)}
        edges = [np.array(sorted({r["threshold"] for r in rows if r["feature"] == f})) for f in features]
        trees: dict[int, Tree] = {}
        for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
            f = place[r["feature"]] if r["feature"] is not None else -1
            t = trees.setdefault(r["tree"], Tree(0, record["params"], r["cls"], r["tree"], [], [], [], [], [], [], []))
            for column, value in zip((t.feature, t.cut, t.left, t.right, t.depth, t.gain, t.stats),
                                     (f, int(np.searchsorted(edges[f], r["threshold"])) if f >= 0 else 0, r["left"], r["right"], r["depth"], r["gain"] or 0.0,
                                      np.array(r["stats"]))):
                column.append(-1 if value is None else value)
        return TreeModel(record["kind"], 0, record["params"], list(trees.values()), edges, np.array(record["medians"]), np.array(record["present"]))

    def importances(self, features: Sequence[str]) -> list[tuple[str, float]]:
        """Share of the gain of all cuts by feature."""
        gain = np.zeros(len(features))
        for t in self.trees:
            for f, g, s in zip(t.feature, t.gain, t.stats):
                if f >= 0:
                    gain[f] += g * (1.0 if self.kind == "boost" else s[-1])
        return list(zip(features, (gain / gain.sum() if gain.sum() else gain).tolist()))


def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def leaf_values(tree: Tree) -> np.ndarray:
    p = tree.params
    g, h = (np.array([s[k] for s in tree.stats]) for k in (0, 1))
    # Without rows and penalty a node has no value.
    bottom = h + float(p.get("reg_lambda", 1.0))
    return -np.divide(_soft(g, float(p.get("reg_alpha", 0.0))), bottom, out=np.zeros_like(g), where=bottom > 0) * float(p.get("learning_rate", 0.05))


def _prepared(design: DataFrame, width: int, n_classes: int, n_folds: int):
    edges = bin_edges(design, width)
    medians = training_medians(design, width, n_folds)
    counts = training_counts(block_counts(design, n_classes, n_folds))
    return binned(design, edges), edges, medians, bins_of(medians, edges), counts


def _training(part: pa.RecordBatch, model: int) -> np.ndarray:
    return np.flatnonzero(numbers(part, "fold") < model) if model else np.arange(part.num_rows)


def boost(design: DataFrame, width: int, n_classes: int, n_folds: int, tasks: Sequence[tuple[Mapping[str, Any], int]]) -> list[TreeModel]:
    """Softmax boosting of each (parameters, model); model 0 learns from all rows, model k from the blocks before k.

    Parameters: n_estimators, max_depth, learning_rate, subsample, colsample_bytree, min_child_weight, gamma, reg_lambda, reg_alpha,
    class_weight, random_state. A class has one tree per round.
    """
    table, edges, medians, filler, counts = _prepared(design, width, n_classes, n_folds)
    models = [TreeModel("boost", m, p, [], edges, medians[m], counts[m] > 0) for p, m in tasks]
    weight = [class_weights(counts, p.get("class_weight"))[m] for p, m in tasks]
    held = table.withColumn("scores", F.lit(None).cast("binary"))
    staged = [0] * len(models)  # trees of each model that the written scores hold
    shape = (len(models), n_classes)

    def margins(part: pa.RecordBatch, raw: np.ndarray, k: int, models: Sequence[TreeModel], staged: Sequence[int]) -> np.ndarray:
        scores = part.column(part.schema.get_field_index("scores"))
        out = np.zeros((part.num_rows, n_classes)) if scores.null_count else \
            np.frombuffer(b"".join(scores.to_pylist())).reshape(-1, *shape)[:, k].copy()
        bins = _filled(raw, filler[models[k].model])
        for tree in models[k].trees[staged[k]:]:
            out[:, tree.cls] += leaf_values(tree)[tree.leaves_of(bins)]
        return out

    rounds = max([int(p.get("n_estimators", 300)) for p, _ in tasks], default=0)
    for r in range(rounds):
        growing = [k for k, (p, m) in enumerate(tasks) if r < int(p.get("n_estimators", 300)) and counts[m].sum()]
        trees = [Tree(models[k].model, tasks[k][0], int(c), r) for k in growing for c in np.flatnonzero(models[k].present)]
        owner = [k for k in growing for _ in np.flatnonzero(models[k].present)]
        before = design.sparkSession.sparkContext.broadcast((models, list(staged)))

        def rows_of(part, raw, t, grown):
            models, staged = before.value
            k, p = owner[t], tasks[owner[t]][0]
            take = _training(part, models[k].model)
            share = float(p.get("subsample", 1.0))
            if share < 1:
                take = take[_hashed(numbers(part, "row")[take], int(p.get("random_state", 42)) * 1009 + r) < share]
            score = np.where(models[k].present, margins(part, raw, k, models, staged)[take], -np.inf)
            prob = np.exp(score - score.max(1, keepdims=True))
            prob = (prob / prob.sum(1, keepdims=True))[:, grown[t].cls]
            truth = numbers(part, "code")[take]
            w = weight[k][truth]
            sums = np.stack([(prob - (truth == grown[t].cls)) * w, np.maximum(2 * prob * (1 - prob), 1e-16) * w], axis=1)
            return take, _filled(raw[take], filler[models[k].model]), sums

        _grown(held, trees, width, 2, rows_of, _boost_gains(width), lambda tree, node: tree.depth[node] < int(tree.params.get("max_depth", 4)))
        before.unpersist()
        for k, tree in zip(owner, trees):
            models[k].trees.append(tree)
        if r % RESTAGE == RESTAGE - 1 and r + 1 < rounds:
            sent = (models, list(staged))

            def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for part in batches:
                    raw = np.frombuffer(b"".join(part.column(part.schema.get_field_index("bins")).to_pylist()), np.uint8).reshape(-1, width)
                    every = np.stack([margins(part, raw, k, *sent) for k in range(len(models))], axis=1)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([s.tobytes() for s in every], pa.binary())], names=part.schema.names)

            held = stage(held.mapInArrow(write, held.schema), "boosted")
            staged = [len(m.trees) for m in models]
    return models


def _boost_gains(width: int) -> Callable:
    def gains(tree, node, left, right, total, features):
        p = tree.params
        lam, alpha, least = float(p.get("reg_lambda", 1.0)), float(p.get("reg_alpha", 0.0)), float(p.get("min_child_weight", 1.0))

        def of(s):
            return np.divide(_soft(s[..., 0], alpha) ** 2, s[..., 1] + lam, out=np.zeros(s.shape[:-1]), where=s[..., 1] + lam > 0)

        gain = of(left) + of(right) - of(total) - float(p.get("gamma", 0.0))
        gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
        share = p.get("colsample_bytree", 1.0)
        share = 1.0 if share in (None, "all") else float(share)
        if share < 1:
            chosen = np.random.default_rng([int(p.get("random_state", 42)), tree.number, tree.cls]).permutation(width)[:max(1, int(share * width))]
            gain[~np.isin(features, chosen)] = -np.inf
        return gain
    return gains


def forest(design: DataFrame, width: int, n_classes: int, n_folds: int, tasks: Sequence[tuple[Mapping[str, Any], int]]) -> list[TreeModel]:
    """Random forest of each (parameters, model); as in :func:`boost` for the models.

    Parameters: n_estimators, max_depth (None: no limit), min_samples_split, min_samples_leaf, max_features (sqrt, log2, all, a share or a
    number), bootstrap, class_weight, random_state. Rows are drawn with replacement by seeded Poisson counts; node sizes count draws.
    """
    table, edges, medians, filler, counts = _prepared(design, width, n_classes, n_folds)
    models = [TreeModel("forest", m, p, [], edges, medians[m], counts[m] > 0) for p, m in tasks]
    weight = [class_weights(counts, p.get("class_weight"))[m] for p, m in tasks]
    trees, owner = [], []
    for k, (p, m) in enumerate(tasks):
        if counts[m].sum():
            models[k].trees = [Tree(m, p, -1, n) for n in range(int(p.get("n_estimators", 500)))]
            trees += models[k].trees
            owner += [k] * len(models[k].trees)

    def rows_of(part, raw, t, grown):
        k, tree = owner[t], grown[t]
        take = _training(part, tree.model)
        drawn = np.ones(len(take))
        if tree.params.get("bootstrap", True):
            drawn = np.searchsorted(DRAWN, _hashed(numbers(part, "row")[take], int(tree.params.get("random_state", 42)) * 100_003 + tree.number)).astype(float)
            take, drawn = take[drawn > 0], drawn[drawn > 0]
        truth = numbers(part, "code")[take]
        sums = np.zeros((len(take), n_classes + 1))
        sums[np.arange(len(take)), truth] = drawn * weight[k][truth]
        sums[:, -1] = drawn
        return take, _filled(raw[take], filler[tree.model]), sums

    def gains(tree, node, left, right, total, features):
        p = tree.params

        def spread(s):  # size times Gini impurity
            n = s[..., :-1].sum(-1)
            return n - np.divide((s[..., :-1] ** 2).sum(-1), n, out=np.zeros_like(n), where=n > 0)

        n = total[..., :-1].sum(-1)
        gain = np.divide(spread(total) - spread(left) - spread(right), n, out=np.zeros(left.shape[:-1]), where=n > 0)
        least = int(p.get("min_samples_leaf", 1))
        gain[(left[..., -1] < least) | (right[..., -1] < least) | (gain <= 1e-12)] = -np.inf
        many = _how_many(p.get("max_features", "sqrt"), width)
        if many < width:
            chosen = np.random.default_rng([int(p.get("random_state", 42)), tree.number, node]).permutation(width)[:many]
            gain[~np.isin(features, chosen)] = -np.inf
        return gain

    def goes_on(tree: Tree, node: int) -> bool:
        s, deepest = tree.stats[node], tree.params.get("max_depth")
        if s is None:
            return True
        return s[-1] >= max(2, int(tree.params.get("min_samples_split", 2))) and (s[:-1] > 0).sum() > 1 and (not deepest or tree.depth[node] < int(deepest))

    _grown(table, trees, width, n_classes + 1, rows_of, gains, goes_on)
    return models


def _how_many(wanted: Any, width: int) -> int:
    if wanted in (None, "all", "auto"):
        return width
    if wanted in ("sqrt", "log2"):
        return max(1, int(np.sqrt(width) if wanted == "sqrt" else np.log2(width)))
    return max(1, min(width, int(wanted * width) if isinstance(wanted, float) else int(wanted)))


def fold_scores(design: DataFrame, models: Sequence[TreeModel], width: int, n_classes: int) -> list[tuple[int, int, float, float]]:
    """(position in ``models``, fold, macro F1, balanced accuracy) of the fold models on their test blocks; one scan."""
    from weekloom.models.design import scores_of, summed

    sent = design.sparkSession.sparkContext.broadcast(list(models))

    def add(part, x, total):
        out, fold, code = total.reshape(len(sent.value), n_classes, n_classes), numbers(part, "fold"), numbers(part, "code")
        for k, m in enumerate(sent.value):
            take = fold == m.model
            if take.any() and m.trees:
                np.add.at(out[k], (code[take], m.probabilities(x[take]).argmax(1)), 1)

    counts = summed(design, add, len(models) * n_classes ** 2, width).reshape(len(models), n_classes, n_classes)
    sent.unpersist()
    return [(k, m.model, *scores_of(counts[k])) for k, m in enumerate(models) if counts[k].sum()]
