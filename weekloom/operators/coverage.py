"""Column coverage: which columns hold enough values to be worth keeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (variable, ratio): the share of non-null values per column, in one pass."""
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in cols])
    return one.unpivot([], list(cols), "variable", "ratio")


def covered_columns(df: DataFrame, cols: Sequence[str], min_ratio: float) -> list[str]:
    """Columns whose non-null share reaches ``min_ratio`` (one aggregate row is read back)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return []
    row = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(f"r{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if (row[f"r{i}"] or 0.0) >= min_ratio]


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns without any value, other than ``keep``."""
    cols = [c for c in df.columns if c not in keep]
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    full = {c for i, c in enumerate(cols) if row[f"n{i}"]}
    return df.select(*[c for c in df.columns if c in keep or c in full])


def reindex_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected columns, as null doubles where missing."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [name for name, kind in df.dtypes if kind in numeric or kind.startswith("decimal")]
