"""Delimited text: layout detection, tolerant reading, consolidation, canonical writing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.scalars import to_instant, to_number
from weekloom.functions.text import normalize_columns
from weekloom.operators.align import union_all

# Separators in order of preference; the second encoding accepts any bytes.
SEPARATORS = (";", ",", "\t", "|")
ENCODINGS = ("UTF-8", "ISO-8859-1")
_BAD = "_bad_line"


@dataclass(frozen=True)
class Layout:
    sep: str
    encoding: str
    broken: bool = False  # quoted fields hold line breaks


def detect_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file with lines: file, header line, separator, encoding, and whether quotes stay open at line ends.

    One pass over all lines counts, per file and separator, how many lines hold
    how many of it. The separator is the one that cuts the most lines into as
    many fields as the header, and of equal ones the one that makes the most
    fields; without any it is the comma. Bytes that are not UTF-8 anywhere in a
    file make its encoding Latin-1.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(
        meta["file_path"].alias("file"), (meta["file_block_start"] == 0).alias("top"), "value",
        F.monotonically_increasing_id().alias("place")).filter(F.trim("value") != "")
    bare = F.regexp_replace("value", '"[^"]*"', "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    held = [F.struct(F.lit(i).alias("rank"), F.lit(x).alias("sep"), (F.length(bare) - F.length(F.replace(bare, F.lit(x), F.lit("")))).alias("held"))
            for i, x in enumerate(SEPARATORS)]
    counted = (
        lines.select("file", "top", "value", "place", F.inline(F.array(*held)))
        .groupBy("file", "rank", "sep", "held")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("top"), F.struct("place", "value"))).alias("head"),
             F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.sum(quotes % 2).alias("odd"))
    )
    # Few rows from here on: a file has one per separator and number of fields.
    per_sep = counted.groupBy("file", "rank", "sep").agg(
        F.min("head").alias("head"), F.min_by("held", "head").alias("fields"), F.sum("n").alias("lines"),
        F.collect_list(F.struct("held", "n")).alias("all"), F.bool_and("valid").alias("valid"), F.sum("odd").alias("odd"))
    same = F.aggregate(F.filter("all", lambda x: x["held"] == F.col("fields")), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    fit = F.struct((F.when(F.col("fields") > 0, same / F.col("lines")).otherwise(0.0)).alias("share"), "fields", (-F.col("rank")).alias("first"))
    best = per_sep.withColumn("fit", fit).groupBy("file").agg(
        F.max_by("sep", "fit").alias("sep"), F.max("fit").alias("fit"), F.min("head").alias("head"), F.bool_and("valid").alias("valid"), F.max("odd").alias("odd"))
    return best.select(
        "file", F.col("head")["value"].alias("header"), F.when(F.col("fit")["fields"] > 0, F.col("sep")).otherwise(",").alias("sep"),
        F.when(F.col("valid"), ENCODINGS[0]).otherwise(ENCODINGS[1]).alias("encoding"),
        ((F.col("odd") > 0) & (F.col("odd") % 2 == 0)).alias("broken"))


def layouts(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, Layout], list[str]]:
    """Files by header line and layout. One short row per file comes back, as Spark's own list of files does."""
    out: dict[tuple[str, Layout], list[str]] = {}
    for r in detect_files(spark, path).collect():
        out.setdefault((r["header"], Layout(r["sep"], r["encoding"], r["broken"])), []).append(unquote(r["file"]))
    return {k: sorted(v) for k, v in sorted(out.items(), key=lambda kv: min(kv[1]))}


def detect_layout(spark: SparkSession, path: str | Sequence[str]) -> Layout:
    """The layout of a file, or of several that share one."""
    found = {layout for _, layout in layouts(spark, path)}
    if len(found) > 1:
        raise ValueError(f"files of {len(found)} layouts under {path}")
    return next(iter(found), Layout(",", ENCODINGS[0]))


def _read_same(spark: SparkSession, files: str | Sequence[str], layout: Layout) -> DataFrame:
    """Files of one layout and header."""
    reader = spark.read.option("header", True).option("sep", layout.sep).option("encoding", layout.encoding)
    first = files if isinstance(files, str) else files[0]
    names = reader.csv(first).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD]])
    df = reader.schema(schema).option("columnNameOfCorruptRecord", _BAD).option("enforceSchema", True).csv(files)
    bare = F.regexp_replace(F.col(_BAD), '"[^"]*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(layout.sep), F.lit("")))
    # Spark does not tell bad lines where it parses no data column, so the test names one.
    parsed = F.coalesce(F.length(F.col(f"`{names[0]}`")) * 0, F.lit(0)) if names else F.lit(0)
    return df.filter(F.coalesce(separators + parsed, parsed - 1) < len(names)).drop(_BAD)


def _opens(text, sep: str):
    """Whether a quoted field that starts in this text is still open at its end; a quote inside a bare field is a character."""
    start = f"(^|{re.escape(sep)})"
    inside = '"[^"]*+(?:""[^"]*+)*+'
    closed = F.regexp_replace(text, f'{start}{inside}"(?={re.escape(sep)}|$)', "$1")
    return closed.rlike(f"{start}{inside}$")


def _with_state(lines: DataFrame, layout: Layout) -> DataFrame:
    """Lines with ``open``: whether a quoted field is open before the line.

    A line turns the state before it into the one after it. Inside a block the
    last line that fixes the state and the flips since give the state for both
    ways a block can begin; one row per block then carries it along the file.
    """
    shut, open_ = _opens(F.col("value"), layout.sep), _opens(F.concat(F.lit('"'), F.col("value")), layout.sep)
    told = lines.withColumns({"_if_shut": shut, "_if_open": open_})
    order = Window.partitionBy("file", "block").orderBy("place")
    told = told.withColumn("_flips", F.sum((F.col("_if_shut") & ~F.col("_if_open")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(F.col("_if_shut") == F.col("_if_open"), F.struct(F.col("_if_shut").alias("state"), F.col("_flips").alias("flips")))
    told = told.withColumns({"_fixed": F.last(fixed, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))})

    def after(begin):
        odd = (F.col("_flips") - F.coalesce(F.col("_fixed.flips"), F.lit(0))) % 2 == 1
        return F.coalesce(F.col("_fixed.state"), begin) != odd

    ends = told.groupBy("file", "block").agg(F.max_by(after(F.lit(False)), "place").alias("shut"), F.max_by(after(F.lit(True)), "place").alias("open"))
    blocks = ends.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "shut", "open"))).alias("all"))  # one row per block of a file
    grown = F.aggregate("all", F.struct(F.lit(False).alias("state"), F.array().cast("array<struct<block:bigint,begin:boolean>>").alias("seen")), lambda acc, b: F.struct(
        F.when(acc["state"], b["open"]).otherwise(b["shut"]).alias("state"),
        F.concat(acc["seen"], F.array(F.struct(b["block"].alias("block"), acc["state"].alias("begin")))).alias("seen")))
    begins = blocks.select("file", F.inline(grown["seen"]))
    told = told.join(begins, ["file", "block"])
    return told.withColumn("_after", after(F.col("begin"))).withColumn("open", F.coalesce(F.lag("_after").over(order), F.col("begin"))).select(
        "file", "block", "place", "value", "open")


def read_records(spark: SparkSession, files: str | Sequence[str], layout: Layout) -> DataFrame:
    """Files of one layout and header whose quoted fields may hold line breaks.

    A file is still read in blocks by many tasks: a line belongs to the record
    of the last line before it at which no quoted field was open, also where a
    block ends inside a record.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(files).select(meta["file_path"].alias("file"), meta["file_block_start"].cast("long").alias("block"),
                                          F.monotonically_increasing_id().alias("place"), F.decode(F.col("value").cast("binary"), layout.encoding).alias("value"))
    known = _with_state(lines, layout)
    order = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumn("start", F.last(F.when(~F.col("open"), F.col("place")), ignorenulls=True).over(order))
    last = known.groupBy("file", "block").agg(F.max("start").alias("start"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.last(F.when(F.col("start").isNotNull(), F.struct("block", "start")), ignorenulls=True).over(along).alias("_from"))
    owned = known.join(carried, ["file", "block"]).withColumn(
        "_of", F.when(F.col("start").isNotNull(), F.struct("block", "start")).otherwise(F.col("_from")))
    first = F.struct("block", "place")
    records = owned.groupBy("file", "_of").agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("lines"), F.min(first).alias("first"))
    heads = records.filter(F.trim(F.element_at("lines", 1)["value"]) != "").groupBy("file").agg(F.min("first").alias("head"))
    body = records.join(heads, "file").filter(F.col("first") > F.col("head")).select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"))
    names = spark.read.option("header", True).option("sep", layout.sep).option("encoding", layout.encoding).option("multiLine", True).csv(
        files if isinstance(files, str) else files[0]).columns
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, _BAD])
    bare = F.regexp_replace(F.regexp_replace(F.col("record"), "[\r\n]+", " "), '"[^"]*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(layout.sep), F.lit("")))
    options = {"sep": layout.sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "multiLine": "true", "escape": '"'}
    kept = body.filter((F.trim("record") != "") & (separators < len(names)))
    return kept.select(F.from_csv("record", ddl, options).alias("r")).select(*[F.col("r")[c].alias(c) for c in names])


def read_delimited(spark: SparkSession, path: str | Sequence[str], layout: Layout | None = None) -> DataFrame:
    """All columns as text, matched by name where the files of a folder differ.

    Every file is read by its own separator and encoding, unless ``layout``
    states them for all. Lines with too many fields are skipped, short ones are
    padded with null. Files with a line that leaves a quoted field open, and
    whose last one is closed, are read by records.
    """
    if layout is not None:
        return _read_same(spark, path if isinstance(path, str) else list(path), layout)
    found = layouts(spark, path)
    if not found:
        return _read_same(spark, path if isinstance(path, str) else list(path), Layout(",", ENCODINGS[0]))
    return union_all([(read_records if known.broken else _read_same)(spark, files, known) for (_, known), files in found.items()])


def read_raw(spark: SparkSession, path: str | Sequence[str], layout: Layout | None = None) -> DataFrame:
    """A raw feed with normalised column names."""
    return normalize_columns(read_delimited(spark, path, layout))


def consolidate(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of one feed as one table, matched by column name: one scan per distinct header and layout."""
    if not paths:
        raise ValueError("no files to consolidate")
    return read_delimited(spark, list(paths))


def write_canonical(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated UTF-8 with a header in every part."""
    df.write.mode(mode).option("header", True).option("sep", ",").csv(path)


def read_series(spark: SparkSession, path: str, time: str = "data", keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """A standard series: UTC instants and numeric columns; unusable numbers are null."""
    df = spark.read.option("header", True).csv(path)
    if time not in df.columns:
        raise ValueError(f"date column {time!r} not found in {path}")
    fixed = [c for c in keys if c in df.columns]
    return df.select(
        *fixed, to_instant(time).alias(time),
        *[to_number(c).alias(c) for c in df.columns if c not in (*fixed, time)])
