"""Softmax regressions of a whole search grid, fitted together.

All (combination, fold) models take the same steps. In every step one scan of
the staged rows returns the gradients of all of them, so the number of scans
does not depend on the grid. Where at most half of the rows differ, equal rows
are put together before the first step, and a scan reads the distinct ones with
their numbers. Steps are accelerated gradient steps, scaled by
the upper bound A / 2 + penalty of the curvature, where A is the weighted
second moment of the scaled features, one per fold and weighting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame

from weekloom.models.design import block_counts, distinct_rows, numbers, scores_of, summed, training_counts, training_medians, training_scales

# A model rests once no scaled weight moves by more than this in a step.
STILL = 1e-5
# Parameters a combination may have.
PARAMS = {"C", "class_weight", "max_iter", "solver", "penalty"}


@dataclass
class LinearGrid:
    """Weights [model, combination, feature (intercept last), class] over scaled features, and how to scale them."""

    combos: list[Mapping[str, Any]]
    weights: np.ndarray
    present: np.ndarray
    medians: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    steps: int

    def scaled(self, x: np.ndarray, model: int) -> np.ndarray:
        z = (np.where(np.isnan(x), self.medians[model], x) - self.mean[model]) / self.std[model]
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def probabilities(self, x: np.ndarray, model: int, weights: np.ndarray | None = None) -> np.ndarray:
        """[row, combination, class]; classes without training rows have 0."""
        w = (self.weights if weights is None else weights)[model]
        z = self.scaled(x, model)
        return softmax(np.einsum("nd,cdk->nck", z, w, optimize=True), self.present[model])


def softmax(scores: np.ndarray, present: np.ndarray) -> np.ndarray:
    scores = np.where(present, scores, -np.inf)
    raised = np.exp(scores - scores.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


def class_weights(counts: np.ndarray, kind: str | None) -> np.ndarray:
    """Weight per (model, class): 1, or such that the classes present weigh the same."""
    if kind is None:
        return np.ones_like(counts)
    if kind != "balanced":
        raise ValueError(f"class_weight {kind!r}")
    many = (counts > 0).sum(1, keepdims=True)
    return np.divide(counts.sum(1, keepdims=True), many * counts, out=np.zeros_like(counts), where=counts > 0)


def fit_grid(design: DataFrame, width: int, n_classes: int, n_folds: int, combos: Sequence[Mapping[str, Any]], only: Sequence[int] | None = None) -> LinearGrid:
    """Fit every combination for model 0 (all rows) and for each fold 1..n_folds (rows of the blocks before it).

    ``only`` names the models wanted; the others keep zero weights.
    """
    for c in combos:
        if set(c) - PARAMS:
            raise ValueError(f"unknown parameters: {sorted(set(c) - PARAMS)}")
        if float(c.get("C", 1.0)) <= 0:
            raise ValueError(f"C {c['C']} is not positive")
    models, many = n_folds + 1, len(combos)
    counts = training_counts(block_counts(design, n_classes, n_folds))
    medians = training_medians(design, width, n_folds)
    rows = distinct_rows(design)
    mean, std = training_scales(rows, medians)
    weights = np.zeros((models, many, width + 1, n_classes))
    grid = LinearGrid(list(combos), weights, counts > 0, medians, mean, std, 0)
    wanted = [m for m in (range(models) if only is None else only) if counts[m].sum() > 0]
    kinds = sorted({c.get("class_weight") for c in combos}, key=str)
    by_kind = np.stack([class_weights(counts, k) for k in kinds])  # [kind, model, class]
    kind_of = [kinds.index(c.get("class_weight")) for c in combos]

    def rows_of(part, model):
        return slice(None) if model == 0 else numbers(part, "fold") < model

    def add_moments(part, x, total):
        out, code, n = total.reshape(len(kinds), models, width + 1, width + 1), numbers(part, "code"), numbers(part, "n")
        for m in wanted:
            take = rows_of(part, m)
            z = grid.scaled(x[take], m)
            for k in range(len(kinds)):
                out[k, m] += (z * (by_kind[k, m][code[take]] * n[take])[:, None]).T @ z

    moments = summed(rows, add_moments, len(kinds) * models * (width + 1) ** 2, width).reshape(len(kinds), models, width + 1, width + 1)
    total = np.einsum("kmc,mc->km", by_kind, counts)
    free = np.append(np.ones(width), 0.0)  # the intercept has no penalty
    penalty = np.zeros((models, many))
    solve = {}
    for m in wanted:
        for c, combo in enumerate(combos):
            penalty[m, c] = 1.0 / (float(combo.get("C", 1.0)) * counts[m].sum())
            bound = moments[kind_of[c], m] / (2 * total[kind_of[c], m]) + np.diag(penalty[m, c] * free + 1e-10)
            solve[m, c] = np.linalg.inv(bound)
    at, ahead, speed = weights, weights.copy(), np.ones((models, many))
    limit = np.array([int(c.get("max_iter", 500)) for c in combos])
    open_ = np.zeros((models, many), bool)
    open_[wanted] = True
    context = design.sparkSession.sparkContext
    while open_.any():
        sent = context.broadcast((grid, ahead, open_.copy()))

        def add_gradient(part, x, total):
            grid, ahead, open_ = sent.value
            out, code, n = total.reshape(weights.shape), numbers(part, "code"), numbers(part, "n")
            for m in wanted:
                some = np.flatnonzero(open_[m])
                if not len(some):
                    continue
                take = rows_of(part, m)
                z, truth = grid.scaled(x[take], m), code[take]
                p = softmax(np.einsum("nd,cdk->nck", z, ahead[m, some], optimize=True), grid.present[m])
                p[np.arange(len(truth)), :, truth] -= 1.0
                p *= (by_kind[np.array(kind_of)[some], m][:, truth] * n[take]).T[:, :, None]
                out[m, some] += np.einsum("nd,nck->cdk", z, p, optimize=True)

        slope = summed(rows, add_gradient, weights.size, width).reshape(weights.shape)
        sent.unpersist()
        grid.steps += 1
        for m, c in zip(*np.nonzero(open_)):
            g = slope[m, c] / total[kind_of[c], m] + penalty[m, c] * free[:, None] * ahead[m, c]
            new = ahead[m, c] - solve[m, c] @ g
            move = new - at[m, c]
            if (g * move).sum() > 0:
                speed[m, c] = 1.0  # the step went too far: start slow again
            faster = (1 + np.sqrt(1 + 4 * speed[m, c] ** 2)) / 2
            ahead[m, c] = new + (speed[m, c] - 1) / faster * move
            speed[m, c], at[m, c] = faster, new
            open_[m, c] = np.abs(move).max() > STILL and grid.steps < limit[c]
    return grid


def grid_scores(design: DataFrame, grid: LinearGrid, width: int, n_classes: int, n_folds: int) -> list[tuple[int, int, float, float]]:
    """(combination, fold, macro F1, balanced accuracy) on the test block of each fold that has training and test rows; one scan."""
    many = len(grid.combos)

    def add(part, x, total):
        out, fold, code = total.reshape(n_folds + 1, many, n_classes, n_classes), numbers(part, "fold"), numbers(part, "code")
        for f in range(1, n_folds + 1):
            take = fold == f
            if take.any() and grid.present[f].any():
                answer = grid.probabilities(x[take], f).argmax(-1)
                for c in range(many):
                    np.add.at(out[f, c], (code[take], answer[:, c]), 1)

    counts = summed(design, add, (n_folds + 1) * many * n_classes ** 2, width).reshape(n_folds + 1, many, n_classes, n_classes)
    return [(c, f, *scores_of(counts[f, c])) for f in range(1, n_folds + 1) for c in range(many) if counts[f, c].sum()]
