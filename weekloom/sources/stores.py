"""Standard daily sources on storage, and the writers of every result."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.resample import daily_mean
from weekloom.plans.weekly import FILL_DAYS, SOURCES, continuous_daily
from weekloom.sources.delimited import read_series, write_canonical

# File names of the standard daily sources, in order of preference.
SOURCE_FILES: dict[str, tuple[str, ...]] = {
    "carga": ("ons_carga_diaria", "ons_carga"),
    "ger_fontes": ("ons_geracao_fontes_diaria",),
    "intercambio": ("ons_intercambio_diario",),
    "ena": ("ons_ena_diaria",),
    "ear": ("ons_ear_diaria",),
    "cortes_eolica": ("ons_cortes_eolica_diario",),
    "cortes_fv": ("ons_cortes_fv_diario",),
    "clima": ("clima_go_diario",),
}
SUFFIXES = (".parquet", ".csv")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path on any Hadoop file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def finished(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether a writer ended there and left at least one row."""
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return False
    reader = spark.read.format(fmt)
    try:
        return not (reader.option("header", True) if fmt == "csv" else reader).load(path).isEmpty()
    except AnalysisException:  # no file with a schema
        return False


def write_table(df: DataFrame, path: str, overwrite: bool = False, fmt: str = "parquet") -> bool:
    """Write unless a usable result is already there; tells whether it wrote."""
    if not overwrite and finished(df.sparkSession, path, fmt):
        return False
    if fmt == "csv":
        write_canonical(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
    return True


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def load_sources(spark: SparkSession, raw_dir: str, files: Mapping[str, Sequence[str]] = SOURCE_FILES,
                 default_key: str = "seco") -> dict[str, DataFrame]:
    """The daily sources found under a folder: daily mean, continuous calendar, gaps up to 7 days filled.

    A source without a ``series_key`` column is one series named ``default_key``.
    """
    out = {}
    for name, stems in files.items():
        path = first_existing(spark, [f"{raw_dir.rstrip('/')}/{stem}{suffix}" for stem in stems for suffix in SUFFIXES])
        if path is None:
            continue
        df = spark.read.parquet(path) if path.endswith(".parquet") else read_series(spark, path)
        if "series_key" not in df.columns:
            df = df.withColumn("series_key", F.lit(default_key))
        cols = [c for c in df.columns if c not in ("series_key", "data")]
        daily = daily_mean(df.filter(F.col("data").isNotNull()), ["series_key"], "data", cols, continuous=False)
        out[name] = continuous_daily(daily, ["series_key"], "data", cols, FILL_DAYS)
    if not out:
        raise FileNotFoundError(f"no source found under {raw_dir}")
    return out


def save_sources(sources: Mapping[str, DataFrame], raw_dir: str, fmt: str = "csv", overwrite: bool = True) -> None:
    """Write each daily source under its standard name."""
    for name, df in sources.items():
        write_table(df.select("series_key", "data", *[c for c in SOURCES[name] if c in df.columns]),
                    f"{raw_dir.rstrip('/')}/{SOURCE_FILES[name][0]}.{fmt}", overwrite, fmt)


def record_runs(rows: DataFrame, path: str, run: str = "run_key") -> DataFrame:
    """Add runs to a history and return all of it; a run that is there already is replaced.

    Each run is a folder of its own, put in place by Spark once all its rows
    are written: a repeated or failed job leaves every run once, and runs that
    are not among ``rows`` stay as they are. A null or empty key is one run.
    """
    keyed = rows.withColumn(run, F.col(run).cast("string"))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)
    return rows.sparkSession.read.schema(keyed.schema).parquet(path).select(*rows.columns)


def append_scores(spark: SparkSession, path: str, model: str, f1_macro: float, balanced_acc: float,
                  run: str | None = None) -> DataFrame:
    """Add one line to the history of validation scores and return the history.

    The line of a named ``run`` replaces the one that run has left before;
    without a name every call adds a line.
    """
    row = spark.createDataFrame([(model, f1_macro, balanced_acc, run or uuid.uuid4().hex)],
                                "modelo string, f1_macro double, balanced_acc double, run_key string")
    return record_runs(row, path)


def write_json(df: DataFrame, path: str) -> None:
    """A small result (thresholds, parameters, importances) as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_record(spark: SparkSession, record: Mapping, path: str) -> None:
    """One nested record as JSON."""
    spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string").write.mode("overwrite").text(path)


def read_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def write_report(report: DataFrame, matrix: DataFrame, path: str) -> None:
    """The class report and the confusion matrix as text lines."""
    number = [F.format_string("%.3f", c) for c in ("precision", "recall", "f1")]
    top = report.select(F.concat_ws("\t", "row", *number, F.col("support").cast("string")).alias("value"))
    below = matrix.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in matrix.columns]).alias("value"))
    top.unionByName(below).write.mode("overwrite").text(path)
