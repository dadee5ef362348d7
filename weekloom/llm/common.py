"""Helpers the text operators share."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.session import stage, staging_root

__all__ = ["as_batch", "batches", "documents", "held_out", "keyed_texts", "labels_of", "prepare", "stage", "staging_root", "table"]

# Rows of one Arrow batch: whole texts travel in it, so it has to stay small.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and keep Arrow batches of whole texts small."""
    context = spark.sparkContext
    if not getattr(context, "weekloom_shipped", False):
        top = Path(__file__).resolve().parents[1]
        # Spark's file server hands the archive from the context's own folder to all executors.
        archive = Path(context._temp_dir) / "weekloom_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(archive))
        context.weekloom_shipped = True
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *extra: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names; a null text is empty."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *[F.col(c) for c in extra])


def labels_of(labels: DataFrame, *cols: str) -> DataFrame:
    """One row per labelled document; of contradicting labels the lower one counts, null labels do not."""
    return (labels.filter(F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(*[F.min(F.col(c).cast("int")).alias(c) for c in cols]))


def held_out(id_col: Column | str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text falls in the held-out part; false for a null id."""
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def batches(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 2000, most_bytes: int = 8 << 20,
            weigh=None) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches bounded in rows and, where ``weigh`` is given, in bytes."""
    kept: list[tuple] = []
    size = 0
    for row in rows:
        kept.append(row)
        size += weigh(row) if weigh else 0
        if len(kept) >= most_rows or size >= most_bytes:
            yield as_batch(kept, schema)
            kept, size = [], 0
    if kept:
        yield as_batch(kept, schema)


def as_batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
