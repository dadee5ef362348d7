"""Classification metrics from counted (truth, prediction) pairs.

Everything is derived from one row of class-by-class counts per group, so the
rows are shuffled only as partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.scalars import LABELS


def _cell(t: str, p: str) -> str:
    return f"n_{t}_{p}"


def confusion_counts(df: DataFrame, truth: str, pred: str, groups: Sequence[str] = (),
                     classes: Sequence[str] = LABELS) -> DataFrame:
    """One row per group with a count for every (truth, prediction) pair, 0 where absent."""
    return df.groupBy(*groups).agg(*[
        F.count(F.when((F.col(truth) == t) & (F.col(pred) == p), 1)).alias(_cell(t, p))
        for t in classes for p in classes
    ])


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence[str] = LABELS) -> DataFrame:
    """One row per true class, one column per predicted class, in fixed class order."""
    counts = confusion_counts(df, truth, pred, (), classes)
    rows = F.array(*[
        F.struct(F.lit(t).alias("truth"), *[F.col(_cell(t, p)).alias(p) for p in classes]) for t in classes
    ])
    return counts.select(F.inline(rows))


def _sum(cols: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + c
    return total


def _ratio0(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _class_columns(c: str, classes: Sequence[str]) -> tuple[Column, Column, Column, Column]:
    """(precision, recall, f1, support) of one class; 0 where a denominator is 0."""
    hit = F.col(_cell(c, c))
    predicted = _sum([F.col(_cell(t, c)) for t in classes])
    support = _sum([F.col(_cell(c, p)) for p in classes])
    return _ratio0(hit, predicted), _ratio0(hit, support), _ratio0(2.0 * hit, predicted + support), support


def class_report(df: DataFrame, truth: str, pred: str, classes: Sequence[str] = LABELS) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted averages and accuracy."""
    counts = confusion_counts(df, truth, pred, (), classes)
    per = {c: _class_columns(c, classes) for c in classes}
    n = _sum([per[c][3] for c in classes])
    def row(name: str, values: Sequence[Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("row"), *[
            v.cast("double").alias(m) for m, v in zip(("precision", "recall", "f1"), values)
        ], support.cast("bigint").alias("support"))

    macro = [_sum([per[c][i] for c in classes]) / len(classes) for i in range(3)]
    weighted = [_ratio0(_sum([per[c][i] * per[c][3] for c in classes]), n) for i in range(3)]
    accuracy = _ratio0(_sum([F.col(_cell(c, c)) for c in classes]), n)
    rows = [row(c, per[c][:3], per[c][3]) for c in classes]
    rows += [row("accuracy", [accuracy] * 3, n), row("macro avg", macro, n), row("weighted avg", weighted, n)]
    return counts.select(F.inline(F.array(*rows)))


def macro_scores(df: DataFrame, truth: str, pred: str, groups: Sequence[str] = (),
                 classes: Sequence[str] = LABELS) -> DataFrame:
    """Macro F1 over the classes seen in truth or prediction, balanced accuracy over those in truth."""
    counts = confusion_counts(df, truth, pred, groups, classes)
    per = {c: _class_columns(c, classes) for c in classes}
    predicted = {c: _sum([F.col(_cell(t, c)) for t in classes]) for c in classes}
    seen = _sum([F.when(per[c][3] + predicted[c] > 0, 1).otherwise(0) for c in classes])
    true = _sum([F.when(per[c][3] > 0, 1).otherwise(0) for c in classes])
    f1 = _sum([per[c][2] for c in classes])
    recall = _sum([per[c][1] for c in classes])
    return counts.select(
        *groups,
        F.try_divide(f1, seen.cast("double")).alias("f1_macro"),
        F.try_divide(recall, true.cast("double")).alias("balanced_acc"),
        _sum([per[c][3] for c in classes]).cast("bigint").alias("n_rows"),
    )


def mean_scores(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the per-fold scores."""
    return scores.groupBy(*by).agg(F.avg("f1_macro").alias("f1_macro"), F.avg("balanced_acc").alias("balanced_acc"))


def class_distribution(df: DataFrame, label: str, groups: Sequence[str] = (),
                       classes: Sequence[str] = LABELS) -> DataFrame:
    """Count and percent of every class in fixed order, 0 for absent classes, nulls left out."""
    counts = df.groupBy(*groups).agg(*[
        F.count(F.when(F.col(label) == c, 1)).alias(f"n_{c}") for c in classes
    ])
    total = _sum([F.col(f"n_{c}") for c in classes])
    rows = F.array(*[
        F.struct(F.lit(c).alias("label"), F.col(f"n_{c}").alias("count"),
                 F.round(F.col(f"n_{c}") * 100.0 / F.greatest(total, F.lit(1)), 2).alias("percent"))
        for c in classes
    ])
    return counts.select(*groups, F.inline(rows))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per present class: n / (classes × count). One row per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # At most one row per class, folded into one array and back.
    folded = counts.agg(F.collect_list(F.struct(label, "count")).alias("_c"), F.sum("count").alias("_n"))
    return folded.select("_n", F.size("_c").alias("_k"), F.inline("_c")).select(
        label, "count", (F.col("_n") / (F.col("_k") * F.col("count"))).alias("weight"))
