"""Aggregate builders by name, as used by the day-to-week step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A week holds at most seven days, so an exact percentile per group is bounded.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "max": F.max,
    "min": F.min,
    "std": F.stddev_samp,
    "p95": lambda c: F.percentile(c, F.lit(0.95)),
    "p05": lambda c: F.percentile(c, F.lit(0.05)),
}

# Percentile columns carry a double underscore; the fact table relies on it.
_TAGS = {"p95": "_p95", "p05": "_p05"}


def weekly_name(col: str, how: str) -> str:
    return f"{col}_{_TAGS.get(how, how)}_w"
