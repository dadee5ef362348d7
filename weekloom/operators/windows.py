"""Ordered operators over daily or weekly rows.

All of them run on tables that are already one row per key and day (or week),
so a window partition is bounded by the length of the calendar, however many
raw rows a key had. Operators that must order raw rows are in ``hot``.

Every operator uses the same ``partitionBy(keys).orderBy(time)``, so a chain of
them needs one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(keys: Sequence[str], time: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(time)


def trailing(keys: Sequence[str], time: str, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return ordered(keys, time).rowsBetween(-(rows - 1), 0)


def densify(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Insert the missing days between each key's first and last day, with null values.

    Each row is expanded up to the day before the next one, which needs no
    calendar table and no join. Rows that repeat a day stay as they are and add
    no others.
    """
    cols = [c for c in df.columns if c not in (*keys, day)] if cols is None else list(cols)
    upto = F.date_sub(F.coalesce(F.lead(day).over(ordered(keys, day)), F.date_add(F.col(day), 1)), 1)
    wide = df.select(*keys, day, *cols, upto.alias("_upto")).select(
        *keys, F.col(day).alias("_from"), *cols,
        F.explode(F.when(F.col("_upto") < F.col(day), F.array(day)).otherwise(F.sequence(day, "_upto"))).alias(day),
    )
    here = F.col(day) == F.col("_from")
    return wide.select(*keys, day, *[F.when(here, F.col(c)).alias(c) for c in cols])


def forward_fill(df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str],
                 limit: int | None = None) -> DataFrame:
    """Carry the last non-null value forward, at most ``limit`` rows where given."""
    start = Window.unboundedPreceding if limit is None else -limit
    w = ordered(keys, time).rowsBetween(start, 0)
    filled = set(cols)
    return df.select(*[
        F.last(c, ignorenulls=True).over(w).alias(c) if c in filled else F.col(c) for c in df.columns
    ])


def lag_roll_columns(cols: Sequence[str], keys: Sequence[str], time: str,
                     lags: Sequence[int], rolls: Sequence[int]) -> list[Column]:
    """Lag and rolling mean/std columns for one ``select``."""
    w = ordered(keys, time)
    out = []
    for c in cols:
        out += [F.lag(c, n).over(w).alias(f"{c}_lag{n}w") for n in lags]
        for n in rolls:
            frame = trailing(keys, time, n)
            out.append(F.avg(c).over(frame).alias(f"{c}_r{n}w_mean"))
            out.append(F.stddev_samp(c).over(frame).alias(f"{c}_r{n}w_std"))
    return out


def add_lags_rolls(df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str],
                   lags: Sequence[int] = (1, 2, 4), rolls: Sequence[int] = (2, 4)) -> DataFrame:
    return df.select("*", *lag_roll_columns(cols, keys, time, lags, rolls))


def rolling_sums(df: DataFrame, keys: Sequence[str], time: str, named: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Trailing sums; ``named`` maps an output name to (column, number of rows)."""
    return df.select("*", *[
        F.sum(c).over(trailing(keys, time, n)).alias(out) for out, (c, n) in named.items()
    ])


def negative_share(value, keys: Sequence[str], time: str, rows: int = 52, min_rows: int = 12) -> Column:
    """Share of trailing rows with a negative value; a null value counts as not negative."""
    value = F.col(value) if isinstance(value, str) else value
    frame = trailing(keys, time, rows)
    flag = F.coalesce(value < 0, F.lit(False)).cast("double")
    return F.when(F.count(F.lit(1)).over(frame) >= min_rows, F.avg(flag).over(frame))


def run_of(flag: Column, keys: Sequence[str], time: str, length: int) -> Column:
    """True where the flag held on this row and the ``length - 1`` before it; null breaks a run."""
    hit = F.coalesce(flag, F.lit(False))
    if length <= 1:
        return hit
    return F.sum(hit.cast("int")).over(trailing(keys, time, length)) == length


def lead_target(df: DataFrame, keys: Sequence[str], time: str, label: str, horizon: int,
                out: str = "target", drop_null: bool = True) -> DataFrame:
    """Attach the label ``horizon`` rows ahead."""
    col = F.lead(label, horizon).over(ordered(keys, time)) if horizon else F.col(label)
    shifted = df.withColumn(out, col)
    return shifted.filter(F.col(out).isNotNull()) if drop_null else shifted


def successive_step(df: DataFrame, keys: Sequence[str], time: str, out: str = "step_hours") -> DataFrame:
    """Hours since the previous row of the key."""
    prev = F.lag(time).over(ordered(keys, time))
    secs = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(prev.cast("timestamp"))) / 1e6
    return df.withColumn(out, secs / 3600.0)


def shared_times(df: DataFrame, time: str) -> DataFrame:
    """Every distinct instant of all series together, with its 1-based place and their number.

    One row per week of the calendar, so one ordered pass over it is small.
    """
    every = df.filter(F.col(time).isNotNull()).select(time).distinct()
    return every.select(time, F.row_number().over(Window.orderBy(time)).alias("_place"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))


def tail_split(df: DataFrame, time: str, fraction: float, out: str = "split") -> DataFrame:
    """Mark the rows of the last ``max(1, floor(n * fraction))`` instants as ``holdout``.

    The cut is one date for all series, so that nothing trained on is later
    than anything held out. A fraction of 0 or less, or 0.9 and more, holds
    nothing out; rows without an instant train.
    """
    if fraction <= 0 or fraction >= 0.9:
        return df.withColumn(out, F.lit("train"))
    hold = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(fraction)))
    return df.join(shared_times(df, time), time, "left").withColumn(
        out, F.when(F.col("_place") > F.col("_n") - hold, "holdout").otherwise("train")).select(*df.columns, out)


def expanding_folds(df: DataFrame, time: str, n_splits: int = 5, out: str = "fold") -> DataFrame:
    """Number the test block of each row for expanding-window validation.

    Blocks of ``n // (n_splits + 1)`` instants, the same for all series, end at
    the last instant; rows before the first block get 0. Fold ``f`` tests on
    ``fold == f`` and trains on ``fold < f``, so training is never later than
    the test.
    """
    size = F.floor(F.col("_n") / F.lit(n_splits + 1))
    from_end = F.floor((F.col("_n") - F.col("_place")) / F.nullif(size, F.lit(0)))
    fold = F.when(from_end < n_splits, F.lit(n_splits) - from_end).otherwise(0)
    return df.join(shared_times(df, time), time, "left").withColumn(
        out, F.coalesce(fold, F.lit(0)).cast("int")).select(*df.columns, out)
