"""Changes of cadence: instants to days, days to weeks, months to days.

``keys`` are the series columns. Every aggregation here combines partially
before its shuffle, so a key that holds a large share of the rows sends only
one row per day (or week, or month) and map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.aggregates import AGGREGATES, weekly_name
from weekloom.functions.dates import days_in_month, month_days, month_start, week_end
from weekloom.functions.scalars import clip_low
from weekloom.operators.windows import densify


def daily_metrics(df: DataFrame, keys: Sequence[str], ts: str, metrics: Mapping[str, Column],
                  day: str = "data") -> DataFrame:
    """One row per key and day with any number of aggregates, in one shuffle."""
    return df.groupBy(*keys, F.col(ts).cast("date").alias(day)).agg(
        *[agg.alias(name) for name, agg in metrics.items()]
    )


def daily_sum(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
              step_hours: float = 1.0, day: str = "data", continuous: bool = True) -> DataFrame:
    """Sum per day, null where a day has no value; days between first and last are all present.

    ``step_hours`` turns mean power into energy for feeds that are not hourly.
    """
    scaled = {c: F.sum(F.col(c) * F.lit(step_hours) if step_hours != 1.0 else F.col(c)) for c in cols}
    out = daily_metrics(df, keys, ts, scaled, day)
    return densify(out, keys, day, cols) if continuous else out


def daily_mean(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
               day: str = "data", continuous: bool = True) -> DataFrame:
    """Mean per day; days between first and last are all present."""
    out = daily_metrics(df, keys, ts, {c: F.avg(c) for c in cols}, day)
    return densify(out, keys, day, cols) if continuous else out


def weekly_aggregate(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str],
                     hows: Sequence[str] = tuple(AGGREGATES), week: str = "data") -> DataFrame:
    """Several statistics per Monday-to-Sunday week, labelled by its Sunday.

    Expects one row per key and day on a continuous calendar, so a week of
    nulls inside the range has sum 0 and null everything else.
    """
    unknown = [h for h in hows if h not in AGGREGATES]
    if unknown:
        raise ValueError(f"unknown aggregates: {unknown}")
    return df.groupBy(*keys, week_end(day).alias(week)).agg(
        *[AGGREGATES[h](F.col(c)).alias(weekly_name(c, h)) for c in cols for h in hows]
    )


def monthly_sum(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str],
                month: str = "data") -> DataFrame:
    """Sum per calendar month, 0 for a month without values."""
    return df.groupBy(*keys, month_start(day).alias(month)).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cols]
    )


def spread_month(df: DataFrame, keys: Sequence[str], month: str, value: str,
                 day: str = "data") -> DataFrame:
    """Spread monthly values evenly over the days of their month (null counts as 0).

    Months are summed before they are spread: the shuffle then carries one row
    per key and month, and each becomes at most 31 rows.
    """
    totals = df.groupBy(*keys, month_start(month).alias("_month")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("_total")
    )
    return totals.select(
        *keys,
        F.explode(month_days("_month")).alias(day),
        (F.col("_total") / days_in_month("_month")).alias(value),
    )


def shortfall_month_energy(df: DataFrame, keys: Sequence[str], day: str, expected: str,
                           actual: str, out: str, month: str = "data") -> DataFrame:
    """Monthly energy Σ max(expected − actual, 0) × 24 × days in the month."""
    gap = df.select(*keys, F.col(day).alias(day), clip_low(F.col(expected) - F.col(actual)).alias("_gap"))
    return monthly_sum(gap, keys, day, ["_gap"], month).select(
        *keys, month, (F.col("_gap") * 24 * days_in_month(month)).alias(out)
    )


def spatial_mean(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str],
                 points: str = "n_points") -> DataFrame:
    """Mean over measuring points per day, with the number of contributing rows."""
    return df.groupBy(*keys, day).agg(
        *[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias(points)
    )
