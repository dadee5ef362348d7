"""The staged table that models are fitted on, and sums over it.

One row per labelled row: class code, time block (``fold``), a row number for
draws, and all features as one array, NaN where missing. Model k is trained on
the blocks before k and tested on block k, so what a model needs of its
training rows comes from sums per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.hot import exact_quantiles
from weekloom.session import stage

# Numbers of one piece of a sum, and pieces of the first step that meet in one task of the second.
PIECE, FAN_IN = 8192, 64
# Cells (rows x features) a task turns into one matrix.
CELLS = 2_000_000


def design_rows(df: DataFrame, features: Sequence[str], code: Column, fold: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Stage code, fold, row and x for all rows whose code is not null."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    rows = df.withColumn("_code", code).filter(F.col("_code").isNotNull())
    fold = F.lit(0) if fold is None else fold
    return stage(rows.select(F.col("_code").cast("int").alias("code"), fold.cast("int").alias("fold"),
                             F.monotonically_increasing_id().alias("row"), x.alias("x"), *keep), "design")


def matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut to a bounded number of cells, each with its features as a matrix."""
    rows = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            flat = part.column(part.schema.get_field_index("x")).flatten()
            yield part, flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def numbers(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(part.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def summed(design: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], None], size: int, width: int) -> np.ndarray:
    """The sum over all rows of what ``add(part, x, total)`` puts into ``total``.

    Every task adds up its own rows; the pieces of its total are added in two
    steps, so that no task holds more than a piece for each of a few others.
    Only the sum, whose size is that of the models, comes to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for part, x in matrices(batches, width):
            add(part, x, total)
            seen = True
        if seen:
            for k in range(0, size, PIECE):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([total[k:k + PIECE].tobytes()], pa.binary())], ["piece", "total"])

    def plus(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = np.sum([np.frombuffer(t) for t in pdf["total"]], axis=0)
        return pd.DataFrame({"piece": pdf["piece"].iloc[:1], "total": [whole.tobytes()]})

    schema = "piece long, total binary"
    parts = design.mapInArrow(run, schema).withColumn("_of", F.spark_partition_id() % FAN_IN)
    if design.rdd.getNumPartitions() > FAN_IN:
        parts = parts.groupBy("piece", "_of").applyInPandas(plus, schema)
    out = np.zeros(size)
    for r in parts.groupBy("piece").applyInPandas(plus, schema).collect():
        out[r["piece"]:r["piece"] + PIECE] = np.frombuffer(r["total"])
    return out


def distinct_rows(design: DataFrame) -> DataFrame:
    """Code, fold and x of the rows with the number of rows ``n`` that are equal in them.

    Where that at least halves the table (by an estimate), equal rows are put
    together and staged, so that many scans read each of them once; elsewhere
    every row stays, with n = 1. Sums weighted by n are the same either way.
    """
    size = design.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64("code", "fold", "x")).alias("kinds")).first()
    if 2 * size["kinds"] > size["rows"]:
        return design.select("code", "fold", "x", F.lit(1).cast("long").alias("n"))
    return stage(design.groupBy("code", "fold", "x").agg(F.count(F.lit(1)).alias("n")), "design-distinct")


def block_counts(design: DataFrame, n_classes: int, n_folds: int) -> np.ndarray:
    """Rows per (block, class)."""
    out = np.zeros((n_folds + 1, n_classes))
    for r in design.groupBy("fold", "code").count().collect():  # one row per block and class
        out[r["fold"], r["code"]] = r["count"]
    return out


def training_counts(blocks: np.ndarray) -> np.ndarray:
    """Rows per (model, class): those of the blocks before each block; model 0 has all blocks."""
    before = np.cumsum(blocks, axis=0)
    return np.concatenate([before[-1:], before[:-1]])


def training_medians(design: DataFrame, width: int, n_folds: int) -> np.ndarray:
    """Exact medians (model, feature) over each model's training rows; 0 for a feature without values."""
    models = F.explode(F.array(*[F.lit(k) for k in range(n_folds + 1)])).alias("model")
    each = design.select("fold", models, *[F.col("x")[i].alias(f"x{i}") for i in range(width)])
    each = each.filter((F.col("model") == 0) | (F.col("fold") < F.col("model")))
    each = each.select("model", *[F.nanvl(f"x{i}", F.lit(None)).alias(f"x{i}") for i in range(width)])
    out = np.zeros((n_folds + 1, width))
    for r in exact_quantiles(each, ["model"], [f"x{i}" for i in range(width)], [0.5]).collect():  # one row per model and feature
        out[r["model"], int(r["variable"][1:])] = r["value"]
    return out


def training_scales(design: DataFrame, medians: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample standard deviation (model, feature) of :func:`distinct_rows` after filling with the model's medians; 1 where it is 0."""
    models, width = medians.shape
    pivot = medians[0]

    def add(part, x, total):
        sums = total.reshape(models, 4, width)
        fold, many = numbers(part, "fold"), numbers(part, "n")
        for f in np.unique(fold):
            mine, n = x[fold == f] - pivot, many[fold == f]
            missing = np.isnan(mine)
            mine[missing] = 0.0
            sums[f] += [np.full(width, n.sum()), n @ missing, n @ mine, n @ (mine * mine)]

    blocks = summed(design, add, models * 4 * width, width).reshape(models, 4, width)
    n, miss, one, two = np.moveaxis(training_counts(blocks.reshape(models, -1)).reshape(models, 4, width), 1, 0)
    shift = medians - pivot
    one, two = one + miss * shift, two + miss * shift * shift
    mean = one / np.maximum(n, 1)
    var = np.maximum(two - n * mean * mean, 0) / np.maximum(n - 1, 1)
    std = np.sqrt(var)
    return mean + pivot, np.where(std > 1e-12 * (1 + np.abs(mean + pivot)), std, 1.0)


def scores_of(confusion: np.ndarray) -> tuple[float, float]:
    """Macro F1 over the classes seen on either side and balanced accuracy over the true ones, of counts [truth, answer]."""
    hit, truth, answer = np.diag(confusion), confusion.sum(1), confusion.sum(0)
    seen, known = (truth + answer) > 0, truth > 0
    f1 = np.divide(2 * hit, truth + answer, out=np.zeros(len(hit)), where=seen)
    recall = np.divide(hit, truth, out=np.zeros(len(hit)), where=known)
    return float(f1[seen].mean()), float(recall[known].mean())
