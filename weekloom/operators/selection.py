"""Feature importances and feature selection."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.config import SelectionSettings
from weekloom.functions.scalars import to_number


def importances_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows (feature, importance) from one of three layouts, largest first.

    An object with a list of records under ``feature_importances``, a plain
    object of feature to number, or a list of records. Bad entries are skipped.
    """
    text = spark.read.text(path, wholetext=True)
    return importances_from_text(text, "value")


def importances_from_text(df: DataFrame, col: str) -> DataFrame:
    records = "array<string>"
    # Every record is kept as its own JSON text, so one bad record spoils nothing else.
    parsed = df.select(
        F.get_json_object(col, "$.feature_importances").alias("_nested"),
        F.trim(F.col(col)).alias("_all"),
    ).withColumn("_list", F.when(F.col("_all").startswith("["), F.col("_all")).otherwise(F.col("_nested")))
    listed = parsed.filter(F.col("_list").isNotNull()).select(F.explode(F.from_json("_list", records)).alias("_r"))
    rows = listed.select(F.get_json_object("_r", "$.feature").alias("feature"),
                         to_number(F.get_json_object("_r", "$.importance")).alias("importance"))
    plain = parsed.filter(F.col("_list").isNull()).select(
        F.explode(F.from_json("_all", "map<string,string>")).alias("feature", "_v")
    ).select("feature", to_number("_v").alias("importance"))
    return (
        rows.unionByName(plain).filter(F.col("feature").isNotNull() & F.col("importance").isNotNull())
        .orderBy(F.desc("importance"), "feature")
    )


def rank_importances(importances: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    return importances.orderBy(F.desc(value), feature)


def top_importances(importances: DataFrame, k: int) -> DataFrame:
    return rank_importances(importances).limit(k)


def selected_features(importances: DataFrame, settings: SelectionSettings, available: Sequence[str]) -> DataFrame:
    """Rows (feature, importance, reason): the keep list, the top k and those above the minimum.

    When nothing of these applies, every feature with an importance.
    """
    offered = F.col("feature").isin(*available)
    kept = F.col("feature").isin(*settings.keep) if settings.keep else F.lit(False)
    # The ranking has one row per feature of the table, so the top k is read back as names.
    top = [r["feature"] for r in top_importances(importances, settings.top_k).collect()] if settings.top_k else []
    in_top = F.col("feature").isin(*top) if top else F.lit(False)
    high = F.col("importance") >= settings.min_importance if settings.min_importance is not None else F.lit(False)
    # Listed columns need not have an importance of their own.
    missing = [c for c in settings.keep if c in available]
    listed = importances.sparkSession.createDataFrame([(c,) for c in missing], "feature string").withColumn(
        "importance", F.lit(None).cast("double"))
    pool = importances.unionByName(listed).groupBy("feature").agg(F.max("importance").alias("importance"))
    marked = pool.filter(offered).withColumn(
        "reason", F.when(kept, "keep_list").when(in_top, "top_k").when(high, "min_importance"))
    if not missing and settings.top_k is None and settings.min_importance is None:
        return marked.withColumn("reason", F.lit("importance"))
    return marked.filter(F.col("reason").isNotNull())


def selected_columns(importances: DataFrame | None, settings: SelectionSettings | None,
                     available: Sequence[str]) -> list[str] | None:
    """Names to train on, keep list first; ``None`` leaves all columns in."""
    if settings is None:
        return None
    absent = [c for c in settings.keep if c not in available]
    if absent:
        warnings.warn(f"listed columns are not in the data: {absent}", stacklevel=2)
    needs = settings.top_k is not None or settings.min_importance is not None
    if importances is None:
        if needs:
            warnings.warn("no importances given; all columns stay in", stacklevel=2)
            return None
        names = [c for c in settings.keep if c in available]
    else:
        chosen = selected_features(importances, settings, available)
        order = F.when(F.col("reason") == "keep_list", 0).otherwise(1)
        names = [r["feature"] for r in chosen.orderBy(order, F.desc("importance"), "feature").collect()]
        if not names:
            names = [r["feature"] for r in rank_importances(importances).collect() if r["feature"] in available]
    if not names:
        raise ValueError("no valid column selected")
    return names
