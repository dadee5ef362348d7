"""Raw operational feeds to standard daily series, all series keys in one job.

Input is a raw table with normalised column names (text or typed columns).
Each function returns (series_key, data, measures); filtering to one key gives
the series of that key. ``groups`` maps a series key to its spellings.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions import text
from weekloom.functions.dates import month_start
from weekloom.functions.scalars import clip_low, to_instant, to_number
from weekloom.operators import energy, resample
from weekloom.operators.align import flows_by_key
from weekloom.session import stage
from weekloom.sources import roles

Groups = Mapping[str, Iterable[str]] | None
KEY, DAY = "series_key", "data"


def _key(df: DataFrame, groups: Groups, default: str) -> Column:
    """The series of a row; a feed without a series column is taken as one series."""
    name = roles.series_column(df.columns)
    return F.lit(default) if name is None else text.series_key(name, groups)


def _keyed(df: DataFrame, ts: Column, groups: Groups, default: str, **measures: Column) -> DataFrame:
    """Key, instant and measures of the usable rows; nothing else is carried on."""
    out = df.select(_key(df, groups, default).alias(KEY), ts.alias("ts"), *[c.alias(n) for n, c in measures.items()])
    return out.filter(F.col("ts").isNotNull() & F.col(KEY).isNotNull())


def _daily_energy(rows: DataFrame, cols: Sequence[str], groups: Groups, step_hours: float = 1.0) -> DataFrame:
    """Daily sums by the name as written, then by series: few names are normalised, not every row."""
    by_name = resample.daily_sum(rows, ["_name"], "ts", cols, step_hours, continuous=False)
    keyed = by_name.withColumn(KEY, text.series_key("_name", groups)).filter(F.col(KEY).isNotNull())
    return resample.daily_sum(keyed, [KEY], DAY, cols)


def _named(df: DataFrame, ts: Column, default: str, **measures: Column) -> DataFrame:
    name = roles.series_column(df.columns)
    key = F.lit(default) if name is None else F.col(name).cast("string")
    out = df.select(key.alias("_name"), ts.alias("ts"), *[c.alias(n) for n, c in measures.items()])
    return out.filter(F.col("ts").isNotNull())


def generation(df: DataFrame, groups: Groups = None, default: str = "seco") -> DataFrame:
    """Hourly balance to daily energy per source."""
    found = roles.generation_columns(df.columns)
    rows = _named(df, roles.instant(df), default, **{s: to_number(c) for s, c in found.items()})
    return _daily_energy(rows, list(found), groups)


def exchange(df: DataFrame, groups: Groups = None) -> DataFrame:
    """Hourly exchanges to daily import and export of every series."""
    origin, dest, value = roles.flow_columns(df.columns)
    daily = df.groupBy(
        F.col(origin).cast("string").alias("_from"), F.col(dest).cast("string").alias("_to"),
        roles.instant(df).cast("date").alias("ts"),
    ).agg(F.sum(to_number(value)).alias("mwh"))
    # Names are normalised on the daily rows, where there are few.
    rows = daily.filter(F.col("ts").isNotNull()).select(
        text.series_key("_from", groups).alias("origin"), text.series_key("_to", groups).alias("destination"), "ts", "mwh")
    return flows_by_key(rows, "origin", "destination", "ts", "mwh", KEY, DAY)


def inflow(df: DataFrame, groups: Groups = None, default: str = "seco") -> DataFrame:
    """Natural inflow rows (series_key, data, ena_mwmed), as they are."""
    value = to_number(roles.inflow_column(df.columns))
    return _as_days(_keyed(df, roles.day_of_period(df), groups, default, ena_mwmed=value))


def storage(df: DataFrame, groups: Groups = None, default: str = "seco") -> DataFrame:
    """Storage rows (series_key, data, ear_pct), as they are."""
    value = to_number(roles.storage_column(df.columns))
    return _as_days(_keyed(df, roles.day_of_period(df), groups, default, ear_pct=value))


def _as_days(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("ts", DAY).withColumn(DAY, F.col(DAY).cast("date"))


def load(df: DataFrame, groups: Groups = None, default: str = "seco", step_hours: float = 1.0) -> DataFrame:
    """Load to daily energy.

    Sub-daily rows are summed; daily rows pass through. ``step_hours`` is the
    length of a sub-daily row: 1.0 sums half-hourly power as if hourly, 0.5
    gives its energy.
    """
    candidates = roles.load_columns(df.columns)
    timed = next((c for c in ("din_instante", "din_referenciautc") if c in df.columns), None)
    if roles.is_subdaily(df.columns):
        ts = to_instant(timed) if timed else roles.instant(df)
        daily, usable = _sums_of_all(df, ts.cast("date"), default, candidates)
        value = F.col(_slot(candidates, roles.pick_load(candidates, usable)))
        rows = daily.filter(F.col("ts").isNotNull()).select("_name", "ts", value.alias("carga_mwh"))
        return _daily_energy(rows, ["carga_mwh"], groups, step_hours)
    dated = to_instant("dat_referencia") if "dat_referencia" in df.columns else roles.day_of_period(df)
    name = roles.series_column(df.columns)
    kept = stage(df.select(
        (F.lit(default) if name is None else F.col(name).cast("string")).alias("_name"), dated.cast("date").alias(DAY),
        *[to_number(c).alias(_slot(candidates, c)) for c in candidates],
        *[roles.not_a_number(df, c).alias(_slot(candidates, c, "_bad")) for c in candidates]), "load")
    value = F.col(_slot(candidates, roles.pick_load(candidates, _usable(kept, candidates))))
    key = F.col("_name") if name is None else text.series_key("_name", groups)
    rows = kept.select(key.alias(KEY), DAY, value.alias("carga_mwh"))
    return rows.filter(F.col(DAY).isNotNull() & F.col(KEY).isNotNull())


def _slot(candidates: Sequence[str], name: str, prefix: str = "_sum") -> str:
    return f"{prefix}{list(candidates).index(name)}"


def _usable(kept: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates without a text that is no number, from their flags in a staged table."""
    if not candidates:
        return []
    row = kept.agg(*[F.max(_slot(candidates, c, "_bad")).alias(_slot(candidates, c)) for c in candidates]).first()
    return [c for c in candidates if not row[_slot(candidates, c)]]


def _sums_of_all(df: DataFrame, ts: Column, default: str, candidates: Sequence[str], **more: Column) -> tuple[DataFrame, list[str]]:
    """Sums of all candidate columns by name as written and ``ts``, and the candidates of numbers alone.

    The feed is read once: which column counts is decided on the small staged
    result. Rows without ``ts`` stay, since they speak for or against a column.
    """
    name = roles.series_column(df.columns)
    rows = df.select(
        (F.lit(default) if name is None else F.col(name).cast("string")).alias("_name"), ts.alias("ts"),
        *[to_number(c).alias(_slot(candidates, c)) for c in candidates],
        *[roles.not_a_number(df, c).alias(_slot(candidates, c, "_bad")) for c in candidates],
        *[c.alias(n) for n, c in more.items()])
    sums = [*[_slot(candidates, c) for c in candidates], *more]
    kept = stage(rows.groupBy("_name", "ts").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in sums],
        *[F.max(_slot(candidates, c, "_bad")).alias(_slot(candidates, c, "_bad")) for c in candidates]), "candidates")
    return kept, _usable(kept, candidates)


def curtailment(df: DataFrame, source: str, groups: Groups = None, default: str = "seco",
                plant: str = "id_ons", order: str | None = None, method: str = "ref_minus_limited",
                intraday: bool | None = None) -> DataFrame:
    """Curtailed energy per day of one technology (``eolica`` or ``fv``).

    Readings with a step below six hours are integrated per plant; monthly
    energy is spread over its month; otherwise estimated minus verified power
    is. ``intraday`` skips the look at the cadence.
    """
    out = f"corte_{source}_mwh"
    ts = roles.day_of_period(df)
    has_power = any(c in df.columns for c in roles.POWER_NAMES)
    if intraday or intraday is None and has_power:
        try:
            found = _power(df, ts, groups, default, plant, order, method)
        except roles.UnknownLayout:
            if intraday or _is_intraday(df.select(ts.alias("ts")).groupBy("ts").agg(F.count(F.lit(1)).alias("_rows"))):
                raise
        else:
            # Cadence and sums both come from the plants' instants, staged once.
            found = stage(found, "power") if intraday is None else found
            if intraday or _is_intraday(found.groupBy("ts").agg(F.sum("_rows").alias("_rows"))):
                known = found.filter(F.col(KEY).isNotNull())
                return energy.integrate_instants(known, [KEY, "plant"], "ts", out, by=[KEY])
    candidates = roles.cut_energy_columns(df.columns)
    pair = {"val_geracaoestimada", "val_geracaoverificada"} <= set(df.columns)
    if not candidates and not pair:
        raise roles.UnknownLayout("no curtailed energy and no estimated/verified pair")
    gap = {"_gap": clip_low(to_number("val_geracaoestimada") - to_number("val_geracaoverificada"))} if pair else {}
    monthly, usable = _sums_of_all(df, month_start(ts), default, candidates, **gap)
    name = roles.series_column(df.columns)
    monthly = monthly.withColumn(KEY, F.col("_name") if name is None else text.series_key("_name", groups))
    monthly = monthly.filter(F.col("ts").isNotNull() & F.col(KEY).isNotNull())
    if usable:
        return resample.spread_month(monthly.withColumn(out, F.col(_slot(candidates, usable[0]))), [KEY], "ts", out)
    if pair:
        hours = resample.shortfall_month_energy(monthly.withColumn("_none", F.lit(0.0)), [KEY], "ts", "_gap", "_none", out)
        return resample.spread_month(hours, [KEY], DAY, out)
    raise roles.UnknownLayout("no curtailed energy and no estimated/verified pair")


def _is_intraday(instants: DataFrame) -> bool:
    return energy.is_intraday(instants.filter(F.col("ts").isNotNull()), "ts", "_rows")


def _power(df, ts, groups, default, plant, order, method):
    """Curtailed power by plant and instant, also of rows whose series is unknown."""
    cols = df.columns
    ref = roles.reference_column(cols)
    limited = "val_geracaolimitada" if "val_geracaolimitada" in cols else None
    if method == "ref_minus_limited" and limited is None:
        method = "ref_minus_gen"
    if ref is None or (limited is None and "val_geracao" not in cols):
        raise roles.UnknownLayout("no reference or generation column")
    none = F.lit(None).cast("double")
    rows = df.select(
        _key(df, groups, default).alias(KEY), ts.alias("ts"),
        F.coalesce(F.col(plant).cast("string") if plant in cols else F.lit("all"), F.lit("")).alias("plant"),
        (F.col(order) if order else none).alias("order"), to_number(ref).alias("ref"),
        (to_number(limited) if limited else none).alias("lim"),
        (to_number("val_geracao") if "val_geracao" in cols else none).alias("gen"))
    # Without a row number, readings of one plant at one instant are ordered by their values.
    rows = rows.withColumn("tie", F.struct("order", "ref", "lim", "gen"))
    power = energy.curtailed_power("ref", F.col("lim"), F.col("gen"), method)
    return energy.power_by_instant(rows, [KEY, "plant"], "ts", power, "tie")
