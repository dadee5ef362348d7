"""Alignment of series: outer alignment, flows between keys, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.windows import densify


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one frame is null there."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outer_align(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer alignment of frames with one row per ``on`` and different value columns.

    A union and one grouping take a single shuffle, where a chain of full outer
    joins would take one per frame.
    """
    values = [c for f in frames for c in f.columns if c not in on]
    if len(values) != len(set(values)):
        raise ValueError("value columns must differ between frames")
    return union_all(frames).groupBy(*on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def union_keys(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Every key that occurs in any of the frames, once."""
    return union_all([f.select(*on) for f in frames]).distinct()


def flows_by_key(df: DataFrame, origin: str, destination: str, ts: str, value: str,
                 key: str = "series_key", day: str = "data",
                 names: tuple[str, str] = ("import_mwh", "export_mwh")) -> DataFrame:
    """Daily inflow and outflow of every key from origin/destination rows, in one pass.

    A row with the same origin and destination counts on both sides. Days
    inside a key's range that have no row on one side are 0 there.
    """
    inflow, outflow = names
    ends = F.array(
        F.struct(F.col(destination).alias(key), F.lit(True).alias("_in")),
        F.struct(F.col(origin).alias(key), F.lit(False).alias("_in")),
    )
    sides = df.select(F.col(ts).cast("date").alias(day), F.col(value).alias("_v"), F.inline(ends))
    daily = sides.filter(F.col(key).isNotNull()).groupBy(key, day).agg(
        F.sum(F.when(F.col("_in"), F.col("_v"))).alias(inflow),
        F.sum(F.when(~F.col("_in"), F.col("_v"))).alias(outflow),
        F.max("_in").alias("_any_in"),
        F.min("_in").alias("_all_in"),
    )
    # Each side's calendar runs from its own first to its own last day.
    dense = densify(daily, [key], day)
    whole = Window.partitionBy(key)
    in_day = F.when(F.col("_any_in"), F.col(day))
    out_day = F.when(~F.col("_all_in"), F.col(day))

    def inside(mark):
        return F.col(day).between(F.min(mark).over(whole), F.max(mark).over(whole))

    ranged = dense.withColumn("_keep", F.coalesce(inside(in_day), F.lit(False)) | F.coalesce(inside(out_day), F.lit(False)))
    return ranged.filter("_keep").select(
        key, day,
        F.coalesce(F.col(inflow), F.lit(0.0)).alias(inflow),
        F.coalesce(F.col(outflow), F.lit(0.0)).alias(outflow),
    )


def attach_left(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left alignment on the index columns."""
    return left.join(right, list(on), "left")


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which null keys match each other; meant for small right sides."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])
