"""The weekly feature store for any number of series at once.

Daily series are kept long, one row per series key, variable and day. The
calendar fill, the short forward fill and the weekly statistics are then a
handful of expressions however many variables there are, and work spreads
over series and variables alike. The wide weekly table is put together last.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.config import FeatureSettings
from weekloom.functions.aggregates import AGGREGATES, weekly_name
from weekloom.functions.dates import week_end
from weekloom.operators.align import union_all
from weekloom.operators.coverage import covered_columns
from weekloom.operators.margins import GENERATION, add_margins
from weekloom.operators.windows import densify, forward_fill, ordered, rolling_sums, trailing
from weekloom.session import stage

KEYS = ("series_key",)
TIME = "data"
LONG_KEYS = (*KEYS, "variable")

# The standard daily sources and their columns.
SOURCES: dict[str, tuple[str, ...]] = {
    "carga": ("carga_mwh",),
    "ger_fontes": GENERATION,
    "intercambio": ("import_mwh", "export_mwh"),
    "ena": ("ena_mwmed",),
    "ear": ("ear_pct",),
    "cortes_eolica": ("corte_eolica_mwh",),
    "cortes_fv": ("corte_fv_mwh",),
    "clima": ("ghi", "temp2m_c", "precipitacao_mm"),
}
RAIN = "precipitacao_mm"
RAIN_DAYS = (14, 30, 90, 180)
RAIN_SUMS = {f"precip_{n}d_mm": (RAIN, n) for n in RAIN_DAYS}
FILL_DAYS = 7


def rain_sums(df: DataFrame, keys: Sequence[str] = KEYS, time: str = TIME) -> DataFrame:
    return rolling_sums(df, keys, time, RAIN_SUMS)


def continuous_daily(df: DataFrame, keys: Sequence[str], day: str, cols: Sequence[str],
                     fill: int = FILL_DAYS) -> DataFrame:
    """A daily table on a continuous calendar with short gaps filled forward."""
    return forward_fill(densify(df, keys, day, cols), keys, day, cols, fill)


def long_daily(sources: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = SOURCES) -> DataFrame:
    """All sources as one table (series_key, variable, data, value), unfilled.

    A source has a row for each of its days and columns, with null where it
    has no value, so the first and last day of a variable are its source's.
    """
    parts = []
    for name, df in sources.items():
        cols = [c for c in columns[name] if c in df.columns]
        if cols:
            numeric = df.select(*KEYS, TIME, *[F.col(c).cast("double").alias(c) for c in cols])
            parts.append(numeric.unpivot([*KEYS, TIME], cols, "variable", "value"))
    if not parts:
        raise ValueError("none of the sources is present")
    return union_all(parts)


def long_of(df: DataFrame, present: Mapping[str, Column]) -> DataFrame:
    """Long daily rows from one wide table that holds several sources.

    ``present`` tells for each variable on which rows its source has a day.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value"), there.alias("_there"))
        for c, there in present.items()])
    return df.select(*KEYS, TIME, F.inline(cells)).filter("_there").drop("_there").select(*KEYS, TIME, "variable", "value")


def filled_daily(long: DataFrame) -> DataFrame:
    """The continuous daily series of every variable, plus the rainfall sums."""
    filled = continuous_daily(long, LONG_KEYS, TIME, ["value"])
    # Prefix totals make every rainfall window a difference of two rows.
    w = ordered(LONG_KEYS, TIME)
    rain = F.when(F.col("variable") == RAIN, F.col("value"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    totals = filled.withColumns({"_t": F.sum(F.coalesce(rain, F.lit(0.0))).over(upto), "_n": F.count(rain).over(upto)})

    def window_sum(days: int) -> Column:
        before, n_before = F.lag("_t", days, 0.0).over(w), F.lag("_n", days, 0).over(w)
        return F.when(F.col("_n") - n_before > 0, F.col("_t") - before)

    windows = totals.select(*LONG_KEYS, TIME, "value", *[window_sum(n).alias(name) for name, (_, n) in RAIN_SUMS.items()])
    own = F.struct("variable", "value")
    derived = [F.struct(F.lit(name).alias("variable"), F.col(name).alias("value")) for name in RAIN_SUMS]
    rows = F.when(F.col("variable") == RAIN, F.array(own, *derived)).otherwise(F.array(own))
    return windows.select(*KEYS, TIME, F.inline(rows)).select(*LONG_KEYS, TIME, "value")


def variables_of(sources: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = SOURCES) -> list[str]:
    """The variables the given sources hold, in standard order."""
    have = {n: set(df.columns) for n, df in sources.items()}
    return [c for n, cols in columns.items() if n in have for c in cols if c in have[n]]


def with_rain(variables: Sequence[str]) -> list[str]:
    extra = list(RAIN_SUMS) if RAIN in variables else []
    return [*variables, *[c for c in extra if c not in variables]]


def daily_coverage(filled: DataFrame) -> DataFrame:
    """Rows (variable, ratio): non-null share of each variable over its own days."""
    return filled.groupBy("variable").agg(F.avg(F.col("value").isNotNull().cast("double")).alias("ratio"))


def weekly_long(filled: DataFrame, hows: Sequence[str]) -> DataFrame:
    """Weekly statistics, one row per series, variable and week."""
    stats = [h for h in hows if h not in ("p95", "p05")]
    pct = [h for h in hows if h in ("p95", "p05")]
    aggs = [AGGREGATES[h](F.col("value")).alias(h) for h in stats]
    if pct:
        at = F.array(*[F.lit({"p95": 0.95, "p05": 0.05}[h]) for h in pct])
        aggs.append(F.percentile("value", at).alias("_pct"))
    weekly = filled.groupBy(*LONG_KEYS, week_end(TIME).alias(TIME)).agg(*aggs)
    return weekly.select(*LONG_KEYS, TIME, *stats, *[F.col("_pct")[i].alias(h) for i, h in enumerate(pct)])


def weekly_margin(filled: DataFrame, variables: Sequence[str]) -> DataFrame | None:
    """Weekly sum and minimum of the daily margin between its first and last known day."""
    plus = [c for c in (*GENERATION, "import_mwh") if c in variables]
    minus = [c for c in ("export_mwh",) if c in variables]
    if not plus and not minus:
        return None
    value = F.when(F.col("variable").isin(*minus), -F.col("value")).otherwise(F.col("value"))
    daily = filled.filter(F.col("variable").isin(*plus, *minus)).groupBy(*KEYS, TIME).agg(F.sum(value).alias("_m"))
    known = densify(daily.filter(F.col("_m").isNotNull()), KEYS, TIME, ["_m"])
    return known.groupBy(*KEYS, week_end(TIME).alias(TIME)).agg(
        F.coalesce(F.sum("_m"), F.lit(0.0)).alias("_margin_sum"), F.min("_m").alias("_margin_min"))


def base_week(filled: DataFrame, variables: Sequence[str], hows: Sequence[str] = tuple(AGGREGATES)) -> DataFrame:
    """One wide row per series and week: weekly statistics and the derived margins, before lags."""
    stats = weekly_long(filled, hows).filter(F.col("variable").isin(*variables))
    # One entry per variable, so a week's map is bounded by the number of variables.
    packed = stats.groupBy(*KEYS, TIME).agg(
        F.map_from_entries(F.collect_list(F.struct("variable", F.struct(*hows)))).alias("m"))
    wide = packed.selectExpr(
        *KEYS, TIME, *[f"m['{c}'].{h} AS `{weekly_name(c, h)}`" for c in variables for h in hows])
    margin = weekly_margin(filled, variables)
    if margin is None:
        return add_margins(wide, KEYS, TIME)
    return add_margins(wide.join(margin, [*KEYS, TIME], "left"), KEYS, TIME, "_margin_sum", "_margin_min")


def feature_columns(base: DataFrame) -> list[str]:
    return [c for c in base.columns if c not in (*KEYS, TIME)]


def extend_week(base: DataFrame, cols: Sequence[str], settings: FeatureSettings) -> DataFrame:
    """Add lags and rolling windows to the given columns, then carry the last known value forward.

    The windows run on one row per week and column, so eight window columns
    serve any number of features. The wide table is put together at the end.
    """
    w = ordered([*KEYS, "i"], TIME)
    tags, values = [""], [F.col("v")]
    for n in settings.lags:
        tags.append(f"_lag{n}w")
        values.append(F.lag("v", n).over(w))
    for n in settings.rolls:
        frame = trailing([*KEYS, "i"], TIME, n)
        tags += [f"_r{n}w_mean", f"_r{n}w_std"]
        values += [F.avg("v").over(frame), F.stddev_samp("v").over(frame)]
    names = [f"x{k}" for k in range(len(tags))]
    long = base.select(*KEYS, TIME, F.posexplode(F.array(*cols)).alias("i", "v"))
    spread = long.select(*KEYS, TIME, "i", *[v.alias(x) for v, x in zip(values, names)])
    filled = forward_fill(spread, [*KEYS, "i"], TIME, names)
    # One entry per feature, so the list of a week is bounded by the number of columns.
    weeks = filled.groupBy(*KEYS, TIME).agg(
        F.array_sort(F.collect_list(F.struct("i", F.struct(*names).alias("s")))).alias("f"))
    groups = [[f"f[{i}].s.{x} AS `{c}{t}`" for x, t in zip(names, tags)] for i, c in enumerate(cols)]
    # Plain columns first, then the added ones of each column.
    plain = [g[0] for g in groups]
    added = [e for g in groups for e in g[1:]]
    return weeks.selectExpr(*KEYS, TIME, *plain, *added)


def base_store(long: DataFrame, variables: Sequence[str], settings: FeatureSettings | None = None) -> DataFrame:
    """The pre-lag store with the columns that pass both coverage limits, from unfilled long daily rows.

    The filled daily table is written once: several later steps read it, and
    the feeds behind it should be read only once.
    """
    settings = settings or FeatureSettings()
    variables = with_rain(variables)
    filled = stage(filled_daily(long), "daily")
    if settings.min_daily_coverage is not None:
        ratios = {r["variable"]: r["ratio"] for r in daily_coverage(filled).collect()}  # one row per variable
        gone = [c for c in variables if ratios.get(c, 0.0) < settings.min_daily_coverage]
        if gone:
            warnings.warn(f"daily coverage too low, dropped: {gone}", stacklevel=2)
        variables = [c for c in variables if c not in gone]
    base = base_week(filled, variables, settings.daily_aggs)
    if settings.min_weekly_coverage is not None:
        base = stage(base, "base-week")
        cols = feature_columns(base)
        kept = covered_columns(base, cols, settings.min_weekly_coverage)
        gone = sorted(set(cols) - set(kept))
        if gone:
            warnings.warn(f"weekly coverage too low, dropped: {gone[:20]}", stacklevel=2)
        base = base.select(*KEYS, TIME, *kept)
    return base


def weekly_store(long: DataFrame, variables: Sequence[str], settings: FeatureSettings | None = None,
                 features: Sequence[str] | None = None) -> DataFrame:
    """The weekly feature store: statistics, margins, lags, rolling windows, fill.

    ``features`` limits the columns that are kept and extended.
    """
    settings = settings or FeatureSettings()
    base = base_store(long, variables, settings)
    cols = feature_columns(base)
    return extend_week(base, cols if features is None else [c for c in cols if c in features], settings)


def build_features(sources: Mapping[str, DataFrame], settings: FeatureSettings | None = None,
                   columns: Mapping[str, Sequence[str]] = SOURCES) -> DataFrame:
    """The weekly store from one daily table per source, as ``load_sources`` returns them."""
    return weekly_store(long_daily(sources, columns), variables_of(sources, columns), settings)
