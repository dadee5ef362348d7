"""JSON feeds: record payloads, columnar date maps, scoring requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.scalars import to_number

# Parameters of the weather service and our column names.
WEATHER_PARAMETERS = {"ALLSKY_SFC_SW_DWN": "ghi", "T2M": "temp2m_c", "PRECTOTCORR": "precipitacao_mm"}


def _merged(fields: Sequence[T.StructField]) -> T.StructType:
    """One field per name; a name with two types is read as text."""
    kinds: dict[str, T.DataType] = {}
    for f in fields:
        kinds[f.name] = f.dataType if kinds.get(f.name, f.dataType) == f.dataType else T.StringType()
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def read_records(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Rows of JSON payloads: the root list, or the first list of records in the root object.

    A file is one payload, or with ``one_per_line`` one payload per line. Which
    list is the first is decided for each payload by its own order of keys, so
    payloads may name their lists differently or lack some of them; the rows
    have the columns of all lists. Where any payload has a list, payloads
    without one give no rows.
    """
    seen = spark.read.option("multiLine", not one_per_line).json(path).schema
    lists = [
        f.name for f in seen.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    ]
    payload = F.trim("value")
    texts = spark.read.text(path, wholetext=not one_per_line).filter(payload != "").select(payload.alias("value"))
    if not lists:
        rows = F.when(F.col("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
        return texts.select(F.inline(F.from_json(rows, T.ArrayType(seen))))
    root = [f for f in seen.fields if f.name not in lists]
    inner = [f for name in lists for f in seen[name].dataType.elementType.fields]
    # Columns of a root list stand beside the fields of objects, where both kinds of payload come together.
    is_list = texts.filter(F.col("value").startswith("["))
    record = _merged([*inner, *(root if not is_list.isEmpty() else [])])
    parts = {name: F.get_json_object("value", f"$['{name}']") for name in lists}
    order = F.filter(F.json_object_keys("value"), lambda k: k.isin(*lists))
    by_name = F.map_from_arrays(F.array(*[F.lit(n) for n in lists]), F.array(*parts.values()))
    held = F.filter(F.transform(order, lambda k: F.element_at(by_name, k)), lambda v: F.coalesce(v.startswith("[{"), F.lit(False)))
    rows = F.when(F.col("value").startswith("["), F.col("value")).otherwise(F.get(held, 0))
    return texts.select(F.inline(F.from_json(rows, T.ArrayType(record))))


def explode_map(df: DataFrame, col: str, keep: Sequence[str], name: str = "parameter", value: str = "value") -> DataFrame:
    """One row per entry of a JSON object of numbers."""
    parsed = F.from_json(col, "map<string,string>")
    return df.select(*keep, F.explode(parsed).alias(name, "_v")).select(*keep, name, to_number("_v").alias(value))


def pack_daily(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str], out: str = "payload") -> DataFrame:
    """Daily columns as one JSON text per key: parameter to {yyyymmdd: value}."""
    stamp = F.date_format(day, "yyyyMMdd")
    maps = [F.map_from_entries(F.collect_list(F.struct(stamp, c))).alias(c) for c in cols]
    return df.groupBy(*keys).agg(*maps).select(
        *keys, F.to_json(F.struct(F.struct(F.struct(*cols).alias("parameter")).alias("properties"))).alias(out))


def weather_rows(df: DataFrame, col: str, keys: Sequence[str],
                 parameters: Mapping[str, str] = WEATHER_PARAMETERS, day: str = "data") -> DataFrame:
    """Columnar weather payloads to one row per key and day.

    Values are matched by date, so a day missing from one parameter is null
    there and shifts nothing.
    """
    inner = ", ".join(f"{p}: map<string,double>" for p in parameters)
    parsed = F.from_json(col, f"properties struct<parameter: struct<{inner}>>")
    maps = df.select(*keys, parsed["properties"]["parameter"].alias("_p"))
    def entries_of(p: str):
        return F.transform(
            F.map_entries(F.col("_p")[p]),
            lambda e: F.struct(e["key"].alias("d"), F.lit(p).alias("p"), e["value"].alias("v")))

    # A point without one of the parameters still has the others.
    none = F.array().cast("array<struct<d: string, p: string, v: double>>")
    entries = F.concat(*[F.coalesce(entries_of(p), none) for p in parameters])
    return (
        maps.select(*keys, F.explode(entries).alias("e"))
        .groupBy(*keys, F.try_to_timestamp("e.d", F.lit("yyyyMMdd")).cast("date").alias(day))
        .agg(*[F.max(F.when(F.col("e.p") == p, F.col("e.v"))).alias(name) for p, name in parameters.items()])
    )


def scoring_requests(df: DataFrame, col: str, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """JSON requests to feature columns and an ``error`` text for unusable ones.

    The object may be the request itself or sit as text under ``body``; its
    ``features`` map names to numbers or numeric text. Unknown names are
    ignored, missing and unparsable ones are null.
    """
    raw = F.trim(F.col(col))
    body = F.coalesce(F.get_json_object(raw, "$.body"), raw)
    # An empty body text stands for an empty object.
    body = F.when(F.trim(body) == "", "{}").otherwise(F.trim(body))
    feats = F.get_json_object(body, "$.features")
    is_object = F.coalesce(body.startswith("{") & F.json_object_keys(body).isNotNull(), F.lit(False))
    bad_features = feats.isNotNull() & ~F.trim(feats).startswith("{")
    error = F.when(~is_object, "payload must be a JSON object").when(
        bad_features, "features must be a JSON object")
    values = F.from_json(F.when(error.isNull(), F.coalesce(feats, F.lit("{}"))), "map<string,string>")
    parsed = df.select(*keep, error.alias("error"), values.alias("_f"))
    return parsed.select(*keep, "error", *[to_number(F.col("_f")[c]).alias(c) for c in features])
