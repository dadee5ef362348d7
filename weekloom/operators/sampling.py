"""Minority oversampling with repeatable picks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions.scalars import LABELS
from weekloom.operators.hot import hash_order, number_rows


def extra_draws(counts: Mapping[str, int], min_fraction: float, classes: Sequence[str] = LABELS) -> dict[str, int]:
    """How many extra rows lift each class to the wanted share, class after class.

    Raising one class enlarges the total the next class is measured against.
    """
    total = sum(counts.values())
    extra = {}
    for c in classes:
        have = counts.get(c, 0)
        if not total or not have or have / total >= min_fraction:
            continue
        k = math.ceil(max(0.0, (min_fraction * total - have) / (1.0 - min_fraction)))
        extra[c] = k
        total += k
    return extra


# Rows whose numbers of draws are found together.
DRAW_BLOCK = 4096


def draws_of_rank(counts: Mapping[str, int], draws: Mapping[str, int], seed: int):
    """A column function (class, 1-based rank): how often that row is drawn, with replacement.

    The draws of a class are split down a tree of rank ranges, each time by a
    binomial whose seed names the range, and inside a block of ranks by one
    multinomial. Any task finds the same numbers for its ranks on its own, in
    as many steps as the tree is deep, and over all ranks they add up to the
    wanted number of draws.
    """
    classes = {c: (i, counts[c], k) for i, (c, k) in enumerate(sorted(draws.items()))}
    size, root = DRAW_BLOCK, seed % (1 << 64)

    @F.pandas_udf("long")
    def drawn(label: pd.Series, rank: pd.Series) -> pd.Series:
        def chance(*node: int) -> np.random.Generator:
            return np.random.Generator(np.random.Philox(np.random.SeedSequence([root, *node])))

        def block(number: int, n: int, left: int, wanted: int) -> np.ndarray:
            first, last = 0, -(-n // size)
            while last - first > 1:
                middle = (first + last) // 2
                share = (middle - first) * size / (min(last * size, n) - first * size)
                low = int(chance(number, first, last).binomial(left, share))
                first, last, left = (first, middle, low) if wanted < middle else (middle, last, left - low)
            rows = min(last * size, n) - first * size
            return chance(number, first, first).multinomial(left, np.full(rows, 1 / rows))

        names, place = label.to_numpy(), rank.to_numpy() - 1
        out = np.zeros(len(place), np.int64)
        for c in set(names):
            mine = np.flatnonzero(names == c)
            held = place[mine] // size
            for b in np.unique(held).tolist():
                at = mine[held == b]
                out[at] = block(*classes[c], b)[place[at] - b * size]
        return pd.Series(out)

    return drawn


def oversample_minority(df: DataFrame, label: str, row_key: Sequence[str], min_fraction: float = 0.25,
                        seed: int = 42, copy_col: str = "copy_no", replacement: bool = False) -> DataFrame:
    """Repeat minority rows until every present class reaches ``min_fraction``.

    A class of n rows that needs k more gets k // n extra copies of every row
    and one more of k % n rows chosen by a seeded hash of ``row_key``, so the
    result is the same on every run and after a lost executor. ``copy_no`` is 0
    for the original row.

    With ``replacement`` the k extra rows are seeded draws with replacement
    from the class, as equal on every run: some rows get several, some none.
    """
    if min_fraction <= 0 or min_fraction >= 1:
        return df.withColumn(copy_col, F.lit(0).cast("bigint"))
    counts = {
        r[label]: r["count"]
        for r in df.filter(F.col(label).isin(*LABELS)).groupBy(label).count().collect()  # one row per class
    }
    extra = extra_draws(counts, min_fraction)
    if not extra:
        return df.withColumn(copy_col, F.lit(0).cast("bigint"))
    minority = F.col(label).isin(*extra)
    ranked = number_rows(
        df.filter(minority).withColumn("_draw", hash_order(row_key, seed)), [label], ["_draw", *row_key], "_rank")
    copies = draws_of_rank(counts, extra, seed)(label, "_rank") if replacement else None
    for c, k in extra.items() if not replacement else ():
        n = counts[c]
        value = F.lit(k // n) + F.when(F.col("_rank") <= k % n, 1).otherwise(0)
        copies = F.when(F.col(label) == c, value) if copies is None else copies.when(F.col(label) == c, value)
    repeated = ranked.withColumn(copy_col, F.explode(F.sequence(F.lit(0).cast("bigint"), copies.cast("bigint"))))
    rest = df.filter(~F.coalesce(minority, F.lit(False))).withColumn(copy_col, F.lit(0).cast("bigint"))
    return rest.unionByName(repeated.drop("_draw", "_rank"))
