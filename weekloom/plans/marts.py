"""The calendar dimension and the weekly energy fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.dates import month_name_pt, month_start, year_part

# Names in the fact table. Column = {name}_{statistic}[_{unit}].
STATISTICS = {"mean": "media", "sum": "total", "max": "max", "min": "min", "std": "desvio_padrao"}
MEASURES = {
    "ger_hidreletrica_mwh": ("hidreletrica", "mwh"),
    "ger_eolica_mwh": ("eolica", "mwh"),
    "ger_fv_mwh": ("solar", "mwh"),
    "ger_termica_mwh": ("termica", "mwh"),
    "import_mwh": ("importacao", "mwh"),
    "export_mwh": ("exportacao", "mwh"),
    "ena_mwmed": ("ena", "mwmed"),
    "ear_pct": ("ear", "pct"),
    "ghi": ("irradiancia", ""),
    "temp2m_c": ("temperatura", "c"),
    "precipitacao_mm": ("precipitacao", "mm"),
}


def fact_columns() -> dict[str, str]:
    """Store column to fact column."""
    out = {f"carga_mwh_{s}_w": f"carga_{STATISTICS[s]}_mwh" for s in ("max", "min", "std")}
    out |= {f"carga_mwh__{p}_w": f"carga_{p}_mwh" for p in ("p95", "p05")}
    for measure, (name, unit) in MEASURES.items():
        for s, word in STATISTICS.items():
            out[f"{measure}_{s}_w"] = "_".join(x for x in (name, word, unit) if x)
    out["ratio_corte_renovavel_w"] = "proporcao_corte_renovavel"
    return out


def fact_weekly(store: DataFrame, keys=("series_key",)) -> DataFrame:
    """The published columns of the weekly store under their fact names."""
    return store.filter(F.col("data").isNotNull()).select(
        *keys, F.col("data").cast("date").alias("data"),
        *[F.col(c).cast("double").alias(name) for c, name in fact_columns().items()])


def dim_calendar(df: DataFrame, time: str = "data") -> DataFrame:
    """One row per date between the first and last date of a table, with calendar attributes."""
    bounds = df.agg(F.min(time).cast("date").alias("a"), F.max(time).cast("date").alias("z"))
    days = bounds.filter("a IS NOT NULL").select(F.explode(F.sequence("a", "z")).alias("data"))
    return days.select(
        "data",
        F.dayofmonth("data").alias("dia_do_mes"),
        month_name_pt("data").alias("nome_mes_pt"),
        F.month("data").alias("numero_mes"),
        F.year("data").alias("ano"),
        F.quarter("data").alias("trimestre"),
        year_part("data", 6).alias("semestre"),
        year_part("data", 4).alias("quadrimestre"),
        month_start("data").alias("primeiro_dia_mes"),
    )


def publish(df: DataFrame, table: str, as_view: bool = False) -> DataFrame:
    """Save as a managed table, or register as a view, and return it."""
    if as_view:
        df.createOrReplaceTempView(table)
    else:
        df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def table_scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
