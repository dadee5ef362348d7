"""Curtailed energy from intraday, monthly and estimated/verified feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.scalars import clip_low
from weekloom.operators.align import join_null_safe
from weekloom.operators.hot import exact_quantiles, next_instant
from weekloom.session import stage

# Hours from which a step no longer counts as intraday.
LONG_STEP = 6
METHODS = ("ref_minus_limited", "ref_minus_gen", "limited")


def curtailed_power(reference, limited=None, generated=None, method: str = "ref_minus_limited") -> Column:
    """Power not generated, never below 0; null where an input is null."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "limited":
        return clip_low(limited)
    other = limited if method == "ref_minus_limited" else generated
    ref = F.col(reference) if isinstance(reference, str) else reference
    other = F.col(other) if isinstance(other, str) else other
    return clip_low(ref - other)


def _steps(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Hours to the next instant of the key, for rows unique per key and instant.

    Written once: the shuffles behind it are the costly part, and both the
    typical step and the sums are taken from it.
    """
    hours = (F.unix_micros(F.col("_next").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 3.6e9
    return stage(next_instant(df, keys, ts, "_next").withColumn("step_hours", hours).drop("_next"), "steps")


def cadence(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Median hours between successive instants per key, and whether that is intraday.

    Intraday means a median step below 6 hours and at least 10 rows.
    """
    instants = df.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_rows"))
    steps = _steps(instants, keys, ts)
    sizes = steps.groupBy(*keys).agg(F.sum("_rows").alias("n_rows"))
    median = exact_quantiles(steps, keys, ["step_hours"], [0.5]).select(*keys, F.col("value").alias("median_hours"))
    return join_null_safe(sizes, median, keys).select(
        *keys, "n_rows", "median_hours",
        F.coalesce((F.col("n_rows") >= 10) & (F.col("median_hours") < LONG_STEP), F.lit(False)).alias("is_intraday"),
    )


def is_intraday(instants: DataFrame, ts: str, rows: str) -> bool:
    """Whether a feed has at least ten rows and a median step below six hours.

    ``instants`` has one row per distinct instant with the number of its rows.
    A span of S hours holds at most S / 6 steps of six hours or more; where
    these are fewer than half of all steps, that settles it. Otherwise the
    instants are put in order.
    """
    hours = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 3.6e9
    row = instants.agg(F.sum(rows).alias("n_rows"), F.count(ts).alias("n"), hours.alias("hours")).first()
    if (row["n_rows"] or 0) < 10:
        return False
    if row["hours"] // LONG_STEP <= (row["n"] - 3) / 2:
        return True
    steps = _steps(instants.filter(F.col(ts).isNotNull()), [], ts)
    found = exact_quantiles(steps, [], ["step_hours"], [0.5]).first()
    return bool(found and found["value"] < LONG_STEP)


def power_by_instant(df: DataFrame, plant: Sequence[str], ts: str, power: Column, order: str) -> DataFrame:
    """One row per plant and instant: ``_power`` of the last row by ``order`` (ties: the greatest power), and ``_rows``.

    Rows without an instant are left out; null power is 0.
    """
    rows = df.filter(F.col(ts).isNotNull()).select(
        *plant, ts, F.col(order).alias("_order"), F.coalesce(power, F.lit(0.0)).alias("_power"))
    return rows.groupBy(*plant, ts).agg(
        F.max_by("_power", F.struct("_order", "_power")).alias("_power"), F.count(F.lit(1)).alias("_rows"))


def integrate_energy(df: DataFrame, plant: Sequence[str], ts: str, power: Column, order: str,
                     out: str, by: Sequence[str] | None = None, day: str = "data") -> DataFrame:
    """Energy per day: power times the hours to the plant's next instant, summed.

    The last instant of a plant lasts the plant's median step (half an hour
    where there is none). Rows of one plant at the same instant follow each
    other with no time between them, so only the last by ``order`` counts.
    Null power counts as 0. ``by`` are the columns among ``plant`` to sum by,
    all of them by default.
    """
    return integrate_instants(power_by_instant(df, plant, ts, power, order), plant, ts, out, by, day)


def integrate_instants(picked: DataFrame, plant: Sequence[str], ts: str, out: str,
                       by: Sequence[str] | None = None, day: str = "data") -> DataFrame:
    """``integrate_energy`` for rows of ``power_by_instant``."""
    by = list(plant) if by is None else list(by)
    if not set(by) <= set(plant):
        raise ValueError("energy can only be summed by columns that identify a plant")
    steps = _steps(picked.select(*plant, ts, "_power"), plant, ts)
    # Days per plant are few; the typical step joins there, not row by row.
    daily = steps.groupBy(*plant, F.col(ts).cast("date").alias(day)).agg(
        F.coalesce(F.sum(F.col("_power") * F.col("step_hours")), F.lit(0.0)).alias("_timed"),
        F.sum(F.when(F.col("step_hours").isNull(), F.col("_power"))).alias("_last"),
    )
    typical = exact_quantiles(steps, plant, ["step_hours"], [0.5]).select(*plant, F.col("value").alias("_typical"))
    last_hours = F.when(F.col("_typical") > 0, F.col("_typical")).otherwise(0.5)
    energy = F.col("_timed") + F.coalesce(F.col("_last") * last_hours, F.lit(0.0))
    return join_null_safe(daily, typical, plant).groupBy(*by, day).agg(F.sum(energy).alias(out))
