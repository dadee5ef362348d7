"""Every operator as a query over the given tables, each with its check in SQL.

``@query`` registers a function (spark, sf_dir) -> DataFrame; ``sql`` is the
same result for an independent engine. Results are rounded in both, because
floating-point sums depend on their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.config import FeatureSettings, LabelRules, SelectionSettings, Settings, TrainSettings
from weekloom.functions import dates, scalars, text
from weekloom.models import design, trees
from weekloom.operators import (
    align, catalog, coverage, energy, hot, labels, margins, metrics, profile, resample, sampling, selection, windows,
)
from weekloom.plans import marts, tables, training, weekly
from weekloom.plans import sqltext as q
from weekloom.plans.tables import table
from weekloom.session import stage, staging_root
from weekloom.sources import delimited, feeds, json_feeds, roles, stores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
K, T = ["series_key"], "data"


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Days and hours are UTC throughout.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    wanted = set(cols)
    return df.select(*[F.round(c, digits).alias(c) if c in wanted else F.col(c) for c in df.columns])


def load_day(spark, d):
    return resample.daily_sum(tables.load_rows(spark, d), K, "ts", ["carga_mwh"], continuous=False)


def load_dense(spark, d):
    return windows.densify(load_day(spark, d), K, T)


def load_filled(spark, d):
    return windows.forward_fill(load_dense(spark, d), K, T, ["carga_mwh"], 7)


def load_week(spark, d, hows=("mean", "sum", "std")):
    return resample.weekly_aggregate(load_filled(spark, d), K, T, ["carga_mwh"], hows)


_LOAD = q.with_(q.PLACES, q.LOAD)
_DENSE = q.with_(q.PLACES, q.LOAD, q.dense("dense", "load_day", ["carga_mwh"]))
_FILL = _DENSE + "," + q.filled("fill", "dense", ["carga_mwh"])
_WEEK = _FILL + "," + q.weekly("wk", "fill", ["carga_mwh"], ("mean", "sum", "std"))


# ---- cadence changes -------------------------------------------------------

@query("daily_sum", _DENSE + " SELECT * FROM dense")
def daily_sum(spark, d):
    return resample.daily_sum(tables.load_rows(spark, d), K, "ts", ["carga_mwh"])


@query("daily_mean", q.with_(q.PLACES, q.LOAD, """
load_mean AS (SELECT series_key, data, avg(carga_mwh) AS carga_mwh FROM load_raw GROUP BY ALL)""",
       q.dense("dense", "load_mean", ["carga_mwh"])) + " SELECT series_key, data, round(carga_mwh, 4) AS carga_mwh FROM dense")
def daily_mean(spark, d):
    return rounded(resample.daily_mean(tables.load_rows(spark, d), K, "ts", ["carga_mwh"]), ["carga_mwh"])


@query("densify_daily", _DENSE + " SELECT series_key, count(*) AS n_days, count(carga_mwh) AS n_values,"
       " min(data) AS first_day, max(data) AS last_day FROM dense GROUP BY series_key")
def densify_daily(spark, d):
    return load_dense(spark, d).groupBy(*K).agg(
        F.count(F.lit(1)).alias("n_days"), F.count("carga_mwh").alias("n_values"),
        F.min(T).alias("first_day"), F.max(T).alias("last_day"))


@query("ffill_limit7", _FILL + " SELECT * FROM fill")
def ffill_limit7(spark, d):
    return load_filled(spark, d)


@query("ffill_all", _DENSE + "," + q.filled("fill", "dense", ["carga_mwh"], None) + " SELECT * FROM fill")
def ffill_all(spark, d):
    return windows.forward_fill(load_dense(spark, d), K, T, ["carga_mwh"])


@query("weekly_multi_agg", _FILL + "," + q.weekly("wk", "fill", ["carga_mwh"]) +
       f" SELECT series_key, data, {q.rounded(q.weekly_names(['carga_mwh']))} FROM wk")
def weekly_multi_agg(spark, d):
    out = resample.weekly_aggregate(load_filled(spark, d), K, T, ["carga_mwh"])
    return rounded(out, [c for c in out.columns if c not in (*K, T)])


_LAG = ["carga_mwh_mean_w_lag1w", "carga_mwh_mean_w_lag2w", "carga_mwh_mean_w_lag4w", "carga_mwh_mean_w_r2w_mean",
        "carga_mwh_mean_w_r2w_std", "carga_mwh_mean_w_r4w_mean", "carga_mwh_mean_w_r4w_std"]


@query("lags_rolls", _WEEK + """, x AS (SELECT series_key, data, carga_mwh_mean_w,
       lag(carga_mwh_mean_w, 1) OVER w AS carga_mwh_mean_w_lag1w, lag(carga_mwh_mean_w, 2) OVER w AS carga_mwh_mean_w_lag2w,
       lag(carga_mwh_mean_w, 4) OVER w AS carga_mwh_mean_w_lag4w,
       avg(carga_mwh_mean_w) OVER (w ROWS 1 PRECEDING) AS carga_mwh_mean_w_r2w_mean,
       stddev_samp(carga_mwh_mean_w) OVER (w ROWS 1 PRECEDING) AS carga_mwh_mean_w_r2w_std,
       avg(carga_mwh_mean_w) OVER (w ROWS 3 PRECEDING) AS carga_mwh_mean_w_r4w_mean,
       stddev_samp(carga_mwh_mean_w) OVER (w ROWS 3 PRECEDING) AS carga_mwh_mean_w_r4w_std
       FROM wk WINDOW w AS (PARTITION BY series_key ORDER BY data))
       SELECT series_key, data, """ + q.rounded(["carga_mwh_mean_w", *_LAG]) + " FROM x")
def lags_rolls(spark, d):
    out = windows.add_lags_rolls(load_week(spark, d, ("mean",)), K, T, ["carga_mwh_mean_w"])
    return rounded(out, ["carga_mwh_mean_w", *_LAG])


@query("rolling_days", _FILL + " SELECT series_key, data, " + ", ".join(
    f"sum(carga_mwh) OVER (PARTITION BY series_key ORDER BY data ROWS {n - 1} PRECEDING) AS sum_{n}d" for n in (14, 30, 90, 180)
) + " FROM fill")
def rolling_days(spark, d):
    return windows.rolling_sums(load_filled(spark, d), K, T, {
        f"sum_{n}d": ("carga_mwh", n) for n in (14, 30, 90, 180)}).drop("carga_mwh")


@query("consecutive_low", _WEEK + """, low AS (SELECT series_key, quantile_cont(carga_mwh_sum_w, 0.4::DOUBLE) AS t FROM wk GROUP BY 1)
       SELECT series_key, data, coalesce(sum(CASE WHEN carga_mwh_sum_w <= t THEN 1 ELSE 0 END)
       OVER (PARTITION BY series_key ORDER BY data ROWS 1 PRECEDING) = 2, FALSE) AS low_twice
       FROM wk JOIN low USING (series_key)""")
def consecutive_low(spark, d):
    week = load_week(spark, d, ("sum",))
    limit = week.groupBy(*K).agg(F.percentile("carga_mwh_sum_w", F.lit(0.4)).alias("t"))
    flag = windows.run_of(F.col("carga_mwh_sum_w") <= F.col("t"), K, T, 2)
    return week.join(limit, K).select(*K, T, flag.alias("low_twice"))


@query("lead_target", _WEEK + """ SELECT * FROM (SELECT series_key, data, carga_mwh_sum_w,
       lead(carga_mwh_sum_w, 1) OVER (PARTITION BY series_key ORDER BY data) AS target FROM wk) WHERE target IS NOT NULL""")
def lead_target(spark, d):
    return windows.lead_target(load_week(spark, d, ("sum",)), K, T, "carga_mwh_sum_w", 1)


# Instants of all series together: folds and hold-out are cut at the same dates for all.
_SHARED = """, t AS (SELECT data, row_number() OVER (ORDER BY data) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT data FROM {}))"""
_SPLIT = _SHARED.format("wk") + """ SELECT series_key, data, CASE WHEN rn > n - greatest(1, floor(n * 0.2::DOUBLE)) THEN 'holdout'
       ELSE 'train' END AS split FROM wk JOIN t USING (data)"""


@query("tail_split", _WEEK + _SPLIT)
def tail_split(spark, d):
    return windows.tail_split(load_week(spark, d, ("sum",)), T, 0.2).drop("carga_mwh_sum_w")


@query("cv_folds", _WEEK + _SHARED.format("wk") + """,
       f AS (SELECT series_key, data, n - rn AS e, n // 6 AS s FROM wk JOIN t USING (data))
       SELECT series_key, data, CAST(CASE WHEN e // s < 5 THEN 5 - e // s ELSE 0 END AS INTEGER) AS fold FROM f""")
def cv_folds(spark, d):
    return windows.expanding_folds(load_week(spark, d, ("sum",)), T, 5).drop("carga_mwh_sum_w")


# ---- months ------------------------------------------------------------------

@query("monthly_sum", _LOAD + " SELECT series_key, CAST(date_trunc('month', data) AS DATE) AS data,"
       " coalesce(sum(carga_mwh), 0) AS carga_mwh FROM load_raw GROUP BY 1, 2")
def monthly_sum(spark, d):
    return resample.monthly_sum(tables.load_rows(spark, d), K, "ts", ["carga_mwh"])


_SPREAD = """ SELECT series_key, CAST(unnest(generate_series(CAST(m AS TIMESTAMP), CAST(last_day(m) AS TIMESTAMP),
       INTERVAL 1 DAY)) AS DATE) AS data, round(v / day(last_day(m)), 4) AS {c} FROM mon"""


@query("month_spread", q.with_(q.PLACES, q.LOAD, """
mon AS (SELECT series_key, CAST(date_trunc('month', data) AS DATE) AS m, coalesce(sum(carga_mwh), 0) AS v
        FROM load_raw GROUP BY 1, 2)""") + _SPREAD.format(c="carga_mwh"))
def month_spread(spark, d):
    return rounded(resample.spread_month(tables.load_rows(spark, d), K, "ts", "carga_mwh"), ["carga_mwh"])


@query("est_minus_ver", q.with_(q.PLACES, q.UNITS, """
mon AS (SELECT series_key, CAST(date_trunc('month', data) AS DATE) AS m,
        coalesce(sum(greatest(ghi - ena_mwmed, 0)), 0) * 24 * any_value(day(last_day(data))) AS v
        FROM unit_raw GROUP BY 1, 2)""") + _SPREAD.format(c="corte_mwh"))
def est_minus_ver(spark, d):
    monthly = resample.shortfall_month_energy(
        tables.unit_rows(spark, d), K, "ts", "ghi", "ena_mwmed", "corte_mwh")
    return rounded(resample.spread_month(monthly, K, T, "corte_mwh"), ["corte_mwh"])


@query("date_windows", q.with_(q.PLACES, q.LOAD, """
b AS (SELECT series_key, min(data) AS a, max(data) AS z FROM load_raw GROUP BY 1),
w AS (SELECT series_key, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 90 DAY)) AS DATE)
      AS window_start, z FROM b)""") + " SELECT series_key, window_start, least(window_start + 89, z) AS window_end FROM w")
def date_windows(spark, d):
    bounds = tables.load_rows(spark, d).groupBy(*K).agg(
        F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("z"))
    return catalog.request_windows(bounds, "a", "z")


# ---- generation, exchanges, alignment --------------------------------------

def gen_day(spark, d):
    metrics = tables.unit_metrics()
    wanted = {n: metrics[n] for n in tables.UNITS}
    return resample.daily_metrics(tables.unit_rows(spark, d), K, "ts", wanted)


_GEN = list(tables.UNITS)
_GENSQL = q.with_(q.PLACES, q.UNITS, q.GEN_DAY)


@query("source_pivot", _GENSQL + f""" SELECT series_key, data, {', '.join(_GEN)},
       CASE WHEN coalesce({', '.join(_GEN)}) IS NOT NULL THEN {' + '.join(f'coalesce({c}, 0)' for c in _GEN)} END AS total,
       coalesce(ger_eolica_mwh, 0) + coalesce(ger_fv_mwh, 0) AS renewable FROM gen_day""")
def source_pivot(spark, d):
    return gen_day(spark, d).withColumns({
        "total": scalars.row_sum(_GEN, need_one=True), "renewable": scalars.row_sum(margins.RENEWABLE)})


_FLOWSQL = q.with_(q.PLACES, q.EXCHANGE, q.FLOW_DAY, q.dense("f", "flow_day", ["import_mwh", "export_mwh"]))


@query("import_export", _FLOWSQL + """ SELECT series_key, data, coalesce(import_mwh, 0) AS import_mwh,
       coalesce(export_mwh, 0) AS export_mwh FROM f""")
def import_export(spark, d):
    return align.flows_by_key(tables.exchange_rows(spark, d), "origin", "destination", "ts", "mwh")


@query("net_import", _FLOWSQL + " SELECT series_key, sum(import_mwh) - sum(export_mwh) AS net_import_mwh FROM f GROUP BY 1")
def net_import(spark, d):
    flows = align.flows_by_key(tables.exchange_rows(spark, d), "origin", "destination", "ts", "mwh")
    return flows.groupBy(*K).agg(F.sum(margins.net_import("import_mwh", "export_mwh")).alias("net_import_mwh"))


@query("outer_align", q.with_(q.PLACES, q.LOAD, q.UNITS, q.GEN_DAY) + f""" SELECT series_key, data, carga_mwh, {', '.join(_GEN)}
       FROM load_day FULL JOIN gen_day USING (series_key, data)""")
def outer_align(spark, d):
    return align.outer_align([load_day(spark, d), gen_day(spark, d)], [*K, T])


@query("union_days", q.with_(q.PLACES, q.LOAD, q.UNITS) +
       " SELECT series_key, data FROM load_raw UNION SELECT series_key, data FROM unit_raw")
def union_days(spark, d):
    return align.union_keys([load_day(spark, d), gen_day(spark, d)], [*K, T])


@query("left_align", q.with_(q.PLACES, q.LOAD, q.UNITS, q.GEN_DAY) + """ SELECT series_key, data, carga_mwh, ger_fv_mwh
       FROM load_day LEFT JOIN (SELECT series_key, data, ger_fv_mwh FROM gen_day) USING (series_key, data)""")
def left_align(spark, d):
    return align.attach_left(load_day(spark, d), gen_day(spark, d).select(*K, T, "ger_fv_mwh"), [*K, T])


@query("spatial_mean", """SELECT CAST(ts AS DATE) AS data, round(avg(value), 4) AS value, count(*) AS n_points
       FROM events GROUP BY 1""")
def spatial_mean(spark, d):
    points = table(spark, d, "events").select(F.col("ts").cast("date").alias(T), "value")
    return rounded(resample.spatial_mean(points, [], T, ["value"]), ["value"])


# ---- intraday energy ---------------------------------------------------------

def power_rows(spark, d):
    """Readings per user: reference from the properties, output from the value."""
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select(
        F.col("user_id").alias("plant"), "ts", "event_id", scalars.to_number(k).alias("ref"), F.col("value").alias("gen"))


_STEP = """WITH e AS (SELECT user_id AS plant, ts, event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ref, value AS gen
       FROM events),
       last_of AS (SELECT plant, ts, arg_max(ref, event_id) AS ref, arg_max(gen, event_id) AS gen, count(*) AS n FROM e GROUP BY plant, ts),
       s AS (SELECT *, (epoch_us(lead(ts) OVER (PARTITION BY plant ORDER BY ts)) - epoch_us(ts)) / 3.6e9 AS step FROM last_of)"""


@query("cadence", _STEP + """ SELECT plant, CAST(sum(n) AS BIGINT) AS n_rows, round(median(step), 6) AS median_hours,
       coalesce(sum(n) >= 10 AND median(step) < 6, FALSE) AS is_intraday FROM s GROUP BY plant""")
def cadence(spark, d):
    return rounded(energy.cadence(power_rows(spark, d), ["plant"], "ts"), ["median_hours"], 6)


@query("energy_integral", _STEP + """, t AS (SELECT plant, median(step) AS m FROM s GROUP BY plant)
       SELECT plant, CAST(ts AS DATE) AS data,
       round(sum(greatest(ref - gen, 0) * coalesce(step, CASE WHEN m > 0 THEN m ELSE 0.5 END)), 4) AS corte_mwh
       FROM s JOIN t USING (plant) GROUP BY 1, 2""")
def energy_integral(spark, d):
    power = energy.curtailed_power("ref", "gen")
    return rounded(energy.integrate_energy(power_rows(spark, d), ["plant"], "ts", power, "event_id", "corte_mwh"), ["corte_mwh"])


@query("successive_step", _LOAD + """ SELECT series_key, data, (data - lag(data) OVER (PARTITION BY series_key ORDER BY data))
       * 24.0::DOUBLE AS step_hours FROM load_day""")
def successive_step(spark, d):
    return windows.successive_step(load_day(spark, d), K, T).drop("carga_mwh")


@query("dup_ts_bump", """SELECT event_id, event_type, epoch_us(date_trunc('hour', ts)) + row_number() OVER
       (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) - 1 AS micros FROM events""")
def dup_ts_bump(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", F.date_trunc("hour", "ts").alias("ts"))
    out = hot.bump_duplicates(rows, ["event_type"], "ts", "event_id")
    return out.select("event_id", "event_type", F.unix_micros("ts_unique").alias("micros"))


@query("dedupe_last", """SELECT event_type, CAST(ts AS DATE) AS data, arg_max(value, event_id) AS value,
       max(event_id) AS event_id FROM events GROUP BY 1, 2""")
def dedupe_last(spark, d):
    rows = table(spark, d, "events").select("event_type", F.col("ts").cast("date").alias(T), "value", "event_id")
    return hot.last_per_key(rows, ["event_type", T], ["event_id"])


@query("exact_quantiles", """SELECT event_type, round(quantile_cont(value, 0.05::DOUBLE), 6) AS q05, round(median(value), 6) AS q50,
       round(quantile_cont(value, 0.95::DOUBLE), 6) AS q95 FROM events GROUP BY 1""")
def exact_quantiles(spark, d):
    out = hot.exact_quantiles(table(spark, d, "events"), ["event_type"], ["value"], (0.05, 0.5, 0.95))
    return out.groupBy("event_type").agg(*[
        F.round(F.max(F.when(F.col("prob") == p, F.col("value"))), 6).alias(n)
        for p, n in ((0.05, "q05"), (0.5, "q50"), (0.95, "q95"))])


# ---- weekly store ------------------------------------------------------------

FULL = FeatureSettings(min_daily_coverage=None, min_weekly_coverage=None)
# The label rules need sums and means only.
LEAN = FeatureSettings(("mean", "sum"), min_daily_coverage=None, min_weekly_coverage=None)

_BASE_PARTS, BASE_COLS = q.base_parts()
_LEAN_PARTS, LEAN_COLS = q.base_parts(("mean", "sum"))
_BASE, _LEAN = q.with_(*_BASE_PARTS), q.with_(*_LEAN_PARTS)


def _lean_base(spark, d):
    return weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, LEAN)


_STD_DIGITS = 4


def _extended_sql(cols):
    w = "(PARTITION BY series_key ORDER BY data"
    exprs, names = [], list(cols)
    for c in cols:
        for n in (1, 2, 4):
            exprs.append(f"lag({c}, {n}) OVER {w}) AS {c}_lag{n}w")
        for n in (2, 4):
            exprs.append(f"avg({c}) OVER {w} ROWS {n - 1} PRECEDING) AS {c}_r{n}w_mean")
            exprs.append(f"stddev_samp({c}) OVER {w} ROWS {n - 1} PRECEDING) AS {c}_r{n}w_std")
        names += [f"{c}_lag{n}w" for n in (1, 2, 4)] + [f"{c}_r{n}w_{s}" for n in (2, 4) for s in ("mean", "std")]
    last = ", ".join(
        f"round(last_value({c} IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS {c}"
        for c in names)
    return f", wide AS (SELECT series_key, data, {', '.join([*cols, *exprs])} FROM base) SELECT series_key, data, {last} FROM wide"


@query("weekly_features", _BASE + _extended_sql(BASE_COLS))
def weekly_features(spark, d):
    """The flagship: every statistic, margin, lag and rolling window of every source."""
    store = weekly.weekly_store(tables.daily_long(spark, d), tables.VARIABLES, FULL)
    return store.selectExpr(*K, T, *[f"round(`{c}`, 4) AS `{c}`" for c in store.columns if c not in (*K, T)])


@query("base_week", _BASE + f" SELECT series_key, data, {q.rounded(BASE_COLS)} FROM base")
def base_week(spark, d):
    base = weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FULL)
    return rounded(base, weekly.feature_columns(base))


_MARGIN_COLS = ["geracao_total_mwh_sum_w", "import_total_mwh_sum_w", "export_total_mwh_sum_w", "margem_suprimento_w",
                "margem_suprimento_min_w", "saldo_importador_mwh_sum_w", "margem_vs_carga_w"]


@query("supply_margin", _LEAN + f" SELECT series_key, data, {q.rounded(_MARGIN_COLS)} FROM base")
def supply_margin(spark, d):
    return rounded(_lean_base(spark, d).select(*K, T, *_MARGIN_COLS), _MARGIN_COLS)


_ADEQUACY = ["margem_vs_carga_w", "reserve_margin_ratio_w", "ens_week_mwh", "ens_week_ratio"]


@query("reserve_ens", _LEAN + f" SELECT series_key, data, {q.rounded(_ADEQUACY, 6)} FROM base")
def reserve_ens(spark, d):
    return rounded(_lean_base(spark, d).select(*K, T, *_ADEQUACY), _ADEQUACY, 6)


@query("lolp", _LEAN + " SELECT series_key, data, round(lolp_52w, 6) AS lolp_52w FROM base")
def lolp(spark, d):
    return rounded(_lean_base(spark, d).select(*K, T, "lolp_52w"), ["lolp_52w"], 6)


_CUT = ["corte_renovavel_mwh_sum_w", "ger_renovavel_mwh_sum_w", "ratio_corte_renovavel_w"]


@query("curtail_ratio", _LEAN + f" SELECT series_key, data, {q.rounded(_CUT, 6)} FROM base")
def curtail_ratio(spark, d):
    return rounded(_lean_base(spark, d).select(*K, T, *_CUT), _CUT, 6)


_DAILY_COLS = [c for _, cols in q.SOURCES.values() for c in cols] + q.RAIN_COLS


def _filled_union():
    parts = []
    for name, (_, cols) in q.SOURCES.items():
        src = "clima_rain" if name == "clima" else f"{name}_fill"
        parts += [f"SELECT '{c}' AS variable, {c} AS value FROM {src}"
                  for c in (cols + q.RAIN_COLS if name == "clima" else cols)]
    return " UNION ALL ".join(parts)


@query("coverage_daily", _LEAN + f""" SELECT variable, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS ratio,
       avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END) >= 0.8 AS keep FROM ({_filled_union()}) GROUP BY 1""")
def coverage_daily(spark, d):
    filled = weekly.filled_daily(tables.daily_long(spark, d))
    return weekly.daily_coverage(filled).select(
        "variable", F.round("ratio", 6).alias("ratio"), (F.col("ratio") >= 0.8).alias("keep"))


def _unpivot_sql(cols, src, agg, out):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, {agg.format(c=c)} AS {out} FROM {src}" for c in cols)


@query("coverage_weekly", _BASE + " " + _unpivot_sql(
    BASE_COLS, "base", "round(avg(CASE WHEN {c} IS NULL THEN 0.0 ELSE 1.0 END), 6)", "ratio"))
def coverage_weekly(spark, d):
    base = weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FULL)
    return rounded(coverage.coverage(base, weekly.feature_columns(base)), ["ratio"], 6)


@query("pruned_features", _LEAN + _extended_sql(_MARGIN_COLS))
def pruned_features(spark, d):
    """The store with both coverage limits on, extended for its margin columns."""
    settings = FeatureSettings(("mean", "sum"))
    store = weekly.weekly_store(tables.daily_long(spark, d), tables.VARIABLES, settings, features=tuple(_MARGIN_COLS))
    return rounded(store, weekly.feature_columns(store))


@query("pruned_store", _BASE + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n_values, round(min({c}), 4) AS lowest, round(max({c}), 4) AS highest, count(*) AS n_weeks FROM base"
    for c in BASE_COLS) + f") WHERE n_values >= {FeatureSettings().min_weekly_coverage}::DOUBLE * n_weeks")
def pruned_store(spark, d):
    """Every statistic of every source with the weekly coverage limit on (``coverage_daily`` has the daily one): the columns left, with their range."""
    store = stage(weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FeatureSettings(min_daily_coverage=None)), "pruned")
    cols = weekly.feature_columns(store)
    found = F.array(*[F.struct(F.lit(c).alias("variable"), F.count(c).alias("n_values"), F.min(c).cast("double").alias("lowest"),
                               F.max(c).cast("double").alias("highest"), F.count(F.lit(1)).alias("n_weeks")) for c in cols])
    return rounded(store.agg(found.alias("found")).select(F.inline("found")), ["lowest", "highest"])


# ---- text, coercion, JSON -----------------------------------------------------

_NORM_KEY = """regexp_replace(replace(strip_accents(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))), '/', ''), '[- _]+', '_', 'g')"""


@query("norm_text", f"""SELECT doc_id, md5({_NORM_KEY.format(c='text')}) AS key_md5,
       md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS words_md5 FROM documents""")
def norm_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(text.norm_key("text").cast("binary")).alias("key_md5"),
        F.md5(text.norm_words("text").cast("binary")).alias("words_md5"))


_SPELLINGS = ("SE/CO", "Sudeste/Centro-Oeste", "SE", "Nordeste", "NÓRDESTE", " nordeste ")


@query("alias_filter", """SELECT p_partkey, CASE WHEN p_partkey % 7 < 3 THEN 'seco' WHEN p_partkey % 7 < 6 THEN 'nordeste' ELSE lower(p_type) END AS series_key,
       p_partkey % 7 < 3 AS is_southeast FROM part""")
def alias_filter(spark, d):
    """Spellings with accents, slashes, blanks and aliases, dealt over the parts, and names that have none."""
    spelled = F.coalesce(F.get(F.array(*[F.lit(s) for s in _SPELLINGS]), F.col("p_partkey") % 7), "p_type")
    return table(spark, d, "part").select(
        "p_partkey", text.series_key(spelled).alias("series_key"), text.is_alias_of(spelled, "SE/CO").alias("is_southeast"))


@query("alias_series", """SELECT CASE WHEN lower(n_name) IN ('nation_0', 'nation_5') THEN 'north' ELSE lower(n_name) END AS series_key,
       count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def alias_series(spark, d):
    key = text.series_key("n_name", {"north": ("nation_0", "nation_5")})
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n")).join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).groupBy(key.alias("series_key")).agg(F.sum("_n").alias("n_customers"))


@query("coerce", """SELECT page_id, try_cast(regexp_extract(url, '/([^/]*)$', 1) AS DOUBLE) AS tail_number FROM pages
       WHERE try_cast(regexp_extract(url, '/([^/]*)$', 1) AS DOUBLE) IS NOT NULL""")
def coerce(spark, d):
    tail = F.regexp_extract("url", "/([^/]*)$", 1)
    return table(spark, d, "pages").select("page_id", scalars.to_number(tail).alias("tail_number")).dropna(subset=["tail_number"])


@query("json_map_explode", """SELECT event_id, 'k' AS parameter, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events""")
def json_map_explode(spark, d):
    return json_feeds.explode_map(table(spark, d, "events").select("event_id", "props"), "props", ["event_id"])


@query("weather_points", """WITH e AS (SELECT CAST(ts AS DATE) AS data, user_id, avg(value) AS v, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k
       FROM events GROUP BY ALL) SELECT data, round(avg(v), 4) AS ghi, round(avg(k), 4) AS temp2m_c, count(*) AS n_points FROM e GROUP BY data""")
def weather_points(spark, d):
    """Daily maps per point, packed as the weather service delivers them and unpacked again."""
    readings = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").alias(T)).agg(
        F.avg("value").alias("ALLSKY_SFC_SW_DWN"),
        F.avg(scalars.to_number(F.get_json_object("props", "$.k"))).alias("T2M"))
    payload = json_feeds.pack_daily(readings, ["user_id"], T, ["ALLSKY_SFC_SW_DWN", "T2M"])
    rows = json_feeds.weather_rows(payload, "payload", ["user_id"], {"ALLSKY_SFC_SW_DWN": "ghi", "T2M": "temp2m_c"})
    return rounded(resample.spatial_mean(rows, [], T, ["ghi", "temp2m_c"]), ["ghi", "temp2m_c"])


@query("calendar_parts", """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS week_end,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, day(last_day(o_orderdate)) AS days_in_month,
       epoch_us(timezone('UTC', timezone('America/Sao_Paulo', o_orderdate))) AS utc_micros FROM orders""")
def calendar_parts(spark, d):
    day = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", dates.week_end(day).alias("week_end"), dates.month_start(day).alias("month_start"),
        dates.days_in_month(day).cast("bigint").alias("days_in_month"),
        F.unix_micros(scalars.local_to_utc(day.cast("timestamp"), "America/Sao_Paulo")).alias("utc_micros"))


# ---- labels --------------------------------------------------------------------


RULES = LabelRules()
_LABEL_COLS = [
    "margem_vs_carga_w", "margem_suprimento_w", "margem_suprimento_min_w", "ratio_corte_renovavel_w",
    "reserve_margin_ratio_w", "ens_week_ratio", "lolp_52w", "ear_pct_mean_w", "ena_mwmed_mean_w", "saldo_importador_mwh_sum_w"]


def label_base(spark, d):
    """The columns the label rules read, rounded so that both engines compare the same numbers."""
    # Thresholds and labels both read it, so it is kept in a table.
    return stage(rounded(_lean_base(spark, d).select(*K, T, *_LABEL_COLS), _LABEL_COLS, 6), "label-base")


_LB = _LEAN + f", lb AS (SELECT series_key, data, {q.rounded(_LABEL_COLS, 6)} FROM base)"
_THR = _LB + """, thr AS (SELECT series_key, quantile_cont(margem_vs_carga_w, 0.05::DOUBLE) AS t_low,
       quantile_cont(margem_vs_carga_w, 0.2::DOUBLE) AS t_med, quantile_cont(ear_pct_mean_w, 0.2::DOUBLE) AS ear_threshold,
       quantile_cont(ena_mwmed_mean_w, 0.2::DOUBLE) AS ena_threshold FROM lb GROUP BY 1)"""
_STEPS = _THR + """, s1 AS (SELECT *, CASE WHEN margem_vs_carga_w <= t_low THEN 2 WHEN margem_vs_carga_w <= t_med THEN 1
       WHEN margem_vs_carga_w > t_med THEN 0 END AS code_base,
       coalesce(ear_pct_mean_w <= ear_threshold, FALSE) OR coalesce(sum(CASE WHEN ena_mwmed_mean_w <= ena_threshold THEN 1 ELSE 0 END)
         OVER (PARTITION BY series_key ORDER BY data ROWS 1 PRECEDING) = 2, FALSE) AS hydro_hit,
       coalesce(reserve_margin_ratio_w < 0.05::DOUBLE, FALSE) OR coalesce(ens_week_ratio >= 0.05::DOUBLE, FALSE)
         OR coalesce(lolp_52w >= 0.05::DOUBLE, FALSE) AS hard_hit
       FROM lb JOIN thr USING (series_key)),
       s2 AS (SELECT *, coalesce(ratio_corte_renovavel_w >= 0.05::DOUBLE AND saldo_importador_mwh_sum_w <= 0, FALSE)
         AND code_base IS NOT NULL AS cut_hit FROM s1),
       s3 AS (SELECT *, CASE WHEN cut_hit THEN greatest(code_base - 1, 0) ELSE code_base END AS code_cut,
         CASE WHEN hard_hit AND code_base IS NOT NULL THEN 2 ELSE code_base END AS code_hard FROM s2),
       s4 AS (SELECT *, CASE WHEN hydro_hit AND code_cut IS NOT NULL THEN 2 ELSE code_cut END AS code_final FROM s3),
       lab AS (SELECT *, CASE code_base WHEN 0 THEN 'baixo' WHEN 1 THEN 'medio' WHEN 2 THEN 'alto' END AS l_base,
         CASE code_cut WHEN 0 THEN 'baixo' WHEN 1 THEN 'medio' WHEN 2 THEN 'alto' END AS l_cut,
         CASE code_final WHEN 0 THEN 'baixo' WHEN 1 THEN 'medio' WHEN 2 THEN 'alto' END AS classe_risco FROM s4)"""


def _steps(spark, d):
    base = label_base(spark, d)
    return labels.label_steps(base, labels.label_thresholds(base, K, RULES), K, T, RULES)


def labelled(spark, d):
    base = label_base(spark, d)
    return labels.label_weeks(base, labels.label_thresholds(base, K, RULES), K, T, RULES)


@query("thresholds", _THR + " SELECT series_key, " + q.rounded(["t_low", "t_med", "ear_threshold", "ena_threshold"]) + " FROM thr")
def thresholds(spark, d):
    out = labels.label_thresholds(label_base(spark, d), K, RULES)
    flat = out.select(*K, "t_low", "t_med", "hydro.ear_threshold", "hydro.ena_threshold")
    return rounded(flat, ["t_low", "t_med", "ear_threshold", "ena_threshold"])


@query("label_base", _STEPS + " SELECT series_key, data, l_base AS label FROM lab")
def label_base_query(spark, d):
    return _steps(spark, d).select(*K, T, scalars.decode_label("code_base").alias("label"))


@query("label_curtail", _STEPS + " SELECT series_key, data, cut_hit, l_cut AS label FROM lab")
def label_curtail(spark, d):
    return _steps(spark, d).select(*K, T, "cut_hit", scalars.decode_label("code_cut").alias("label"))


@query("label_hydro", _STEPS + " SELECT series_key, data, hydro_hit, classe_risco AS label FROM lab")
def label_hydro(spark, d):
    return _steps(spark, d).select(*K, T, "hydro_hit", scalars.decode_label("code_final").alias("label"))


@query("label_hard", _STEPS + """ SELECT series_key, data, hard_hit, CASE code_hard WHEN 0 THEN 'baixo' WHEN 1 THEN 'medio'
       WHEN 2 THEN 'alto' END AS label FROM lab""")
def label_hard(spark, d):
    return _steps(spark, d).select(*K, T, "hard_hit", scalars.decode_label("code_hard").alias("label"))


_AUDIT_ROUND = [c for c in _LABEL_COLS if c != "saldo_importador_mwh_sum_w"]


@query("label_audit", _STEPS + f""" SELECT series_key, data, l_base AS label_sem_regras, l_cut AS label_pos_cortes,
       classe_risco AS label_final_calc, classe_risco AS label_pipeline, cut_hit AS downgrade_cortes,
       coalesce(code_cut <> code_final, FALSE) AS override_hidro, coalesce(code_base <> code_hard, FALSE) AS hard_rules,
       'margem_vs_carga_w' AS thr_margin_col, round(t_low, 4) AS thr_t_low, round(t_med, 4) AS thr_t_med,
       0.05::DOUBLE AS thr_q_baixo, 0.2::DOUBLE AS thr_q_medio, round(ear_threshold, 4) AS thr_ear_threshold,
       round(ena_threshold, 4) AS thr_ena_threshold, 2 AS thr_ena_janelas, 0.05::DOUBLE AS thr_corte_ratio,
       TRUE AS thr_corte_requires_import, FALSE AS thr_corte_only_medium, 0.05::DOUBLE AS rule_reserva_operativa_frac,
       0.05::DOUBLE AS rule_ens_ratio_thr, 0.05::DOUBLE AS rule_lolp_thr, {', '.join(_AUDIT_ROUND)} FROM lab""")
def label_audit(spark, d):
    base = label_base(spark, d)
    out = labels.label_audit(base, labels.label_thresholds(base, K, RULES), K, T, RULES)
    return rounded(out, ["thr_t_low", "thr_t_med", "thr_ear_threshold", "thr_ena_threshold"])


@query("hard_rules_on_predictions", _STEPS + """ SELECT series_key, data, CASE WHEN hard_hit AND pred IS NOT NULL THEN 'alto' ELSE pred END AS pred
       FROM (SELECT *, lag(classe_risco) OVER (PARTITION BY series_key ORDER BY data) AS pred FROM lab)""")
def hard_rules_on_predictions(spark, d):
    pred = labelled(spark, d).withColumn("pred", F.lag("classe_risco").over(windows.ordered(K, T)))
    return labels.relabel_with_hard_rules(pred, "pred", RULES).select(*K, T, "pred")


@query("label_next_week", _STEPS + """ SELECT * FROM (SELECT series_key, data, lead(classe_risco, 1) OVER
       (PARTITION BY series_key ORDER BY data) AS target FROM lab) WHERE target IS NOT NULL""")
def label_next_week(spark, d):
    return windows.lead_target(labelled(spark, d), K, T, "classe_risco", 1).select(*K, T, "target")


# ---- class counts, metrics of a persistence forecast ---------------------------

_PAIR = _STEPS + _SHARED.format("lab") + """, pair AS (SELECT *, CAST(CASE WHEN e // s < 5 THEN 5 - e // s ELSE 0 END AS INTEGER) AS fold FROM (
       SELECT series_key, data, classe_risco AS truth, lag(classe_risco) OVER (PARTITION BY series_key ORDER BY data) AS pred,
       n - rn AS e, n // 6 AS s FROM lab JOIN t USING (data)) WHERE truth IS NOT NULL AND pred IS NOT NULL)"""


@query("same_label", _STEPS + """ SELECT series_key, data, classe_risco IS NOT DISTINCT FROM
       lag(classe_risco) OVER (PARTITION BY series_key ORDER BY data) AS same FROM lab""")
def same_label(spark, d):
    """Whether a week has the label of the week before; weeks without one are alike."""
    out = labelled(spark, d).withColumn("before", F.lag("classe_risco").over(windows.ordered(K, T)))
    return out.select(*K, T, scalars.same_value("classe_risco", "before").alias("same"))


def pairs(spark, d):
    """This week's label against last week's as its forecast."""
    out = windows.expanding_folds(labelled(spark, d), T, 5)
    out = out.withColumn("pred", F.lag("classe_risco").over(windows.ordered(K, T)))
    return out.select(*K, T, "fold", F.col("classe_risco").alias("truth"), "pred").dropna(subset=["truth", "pred"])


_CLASSES = ("baixo", "medio", "alto")


@query("class_dist", _STEPS + """, c AS (SELECT unnest(['baixo', 'medio', 'alto']) AS label),
       n AS (SELECT classe_risco AS label, count(*) AS n FROM lab WHERE classe_risco IS NOT NULL GROUP BY 1)
       SELECT label, coalesce(n, 0) AS count, round(coalesce(n, 0) * 100.0::DOUBLE / (SELECT sum(n) FROM n), 2) AS percent
       FROM c LEFT JOIN n USING (label)""")
def class_dist(spark, d):
    return metrics.class_distribution(labelled(spark, d), "classe_risco")


@query("confusion", _PAIR + """, c AS (SELECT unnest(['baixo', 'medio', 'alto']) AS truth)
       SELECT c.truth, count(*) FILTER (pred = 'baixo') AS baixo, count(*) FILTER (pred = 'medio') AS medio,
       count(*) FILTER (pred = 'alto') AS alto FROM c LEFT JOIN pair USING (truth) GROUP BY 1""")
def confusion(spark, d):
    return metrics.confusion_matrix(pairs(spark, d), "truth", "pred")


_PER = """, c AS (SELECT unnest(['baixo', 'medio', 'alto']) AS c{grp}),
       per AS (SELECT c.c{sel}, count(*) FILTER (truth = c AND pred = c) AS tp, count(*) FILTER (truth = c) AS sup,
       count(*) FILTER (pred = c) AS prd FROM c {join} GROUP BY ALL),
       sc AS (SELECT *, CASE WHEN prd > 0 THEN tp / prd ELSE 0 END AS p, CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS r,
       CASE WHEN sup + prd > 0 THEN 2.0::DOUBLE * tp / (sup + prd) ELSE 0 END AS f FROM per)"""
_REPORT = _PAIR + _PER.format(grp="", sel="", join="CROSS JOIN pair")
_FOLDS = _PAIR + _PER.format(grp="", sel=", fold", join="CROSS JOIN pair")
_FOLD_SCORES = _FOLDS + """, fs AS (SELECT fold, sum(f) / count(*) FILTER (sup + prd > 0) AS f1_macro,
       sum(r) / count(*) FILTER (sup > 0) AS balanced_acc, CAST(sum(sup) AS BIGINT) AS n_rows FROM sc GROUP BY fold)"""


@query("class_report", _REPORT + """ SELECT c AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, sup AS support FROM sc
       UNION ALL SELECT 'accuracy', round(sum(tp) / sum(sup), 6), round(sum(tp) / sum(sup), 6), round(sum(tp) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM sc
       UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(sup) AS BIGINT) FROM sc
       UNION ALL SELECT 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6),
       round(sum(f * sup) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM sc""")
def class_report(spark, d):
    return rounded(metrics.class_report(pairs(spark, d), "truth", "pred"), ["precision", "recall", "f1"], 6)


@query("macro_f1", _FOLD_SCORES + " SELECT fold, round(f1_macro, 6) AS f1_macro, n_rows FROM fs")
def macro_f1(spark, d):
    return rounded(metrics.macro_scores(pairs(spark, d), "truth", "pred", ["fold"]), ["f1_macro"], 6).drop("balanced_acc")


@query("balanced_acc", _FOLD_SCORES + " SELECT fold, round(balanced_acc, 6) AS balanced_acc, n_rows FROM fs")
def balanced_acc(spark, d):
    return rounded(metrics.macro_scores(pairs(spark, d), "truth", "pred", ["fold"]), ["balanced_acc"], 6).drop("f1_macro")


@query("cv_mean", _FOLD_SCORES + " SELECT round(avg(f1_macro), 6) AS f1_macro, round(avg(balanced_acc), 6) AS balanced_acc FROM fs WHERE fold > 0")
def cv_mean(spark, d):
    scores = metrics.macro_scores(pairs(spark, d).filter("fold > 0"), "truth", "pred", ["fold"])
    return rounded(metrics.mean_scores(scores), ["f1_macro", "balanced_acc"], 6)


@query("class_weights", _STEPS + """, n AS (SELECT classe_risco, count(*) AS count FROM lab WHERE classe_risco IS NOT NULL GROUP BY 1)
       SELECT classe_risco, count, round(CAST((SELECT sum(count) FROM n) AS DOUBLE) / ((SELECT count(*) FROM n) * count), 6) AS weight FROM n""")
def class_weights(spark, d):
    return rounded(metrics.class_weights(labelled(spark, d), "classe_risco"), ["weight"], 6)


@query("oversample", _STEPS + """, n0 AS (SELECT count(*) FILTER (classe_risco = 'baixo') AS b, count(*) FILTER (classe_risco = 'medio') AS m,
       count(*) FILTER (classe_risco = 'alto') AS a FROM lab),
       n1 AS (SELECT *, CASE WHEN b > 0 AND b < 0.33::DOUBLE * (b + m + a) THEN CAST(ceil((0.33::DOUBLE * (b + m + a) - b) / (1 - 0.33::DOUBLE)) AS BIGINT) ELSE 0 END AS kb FROM n0),
       n2 AS (SELECT *, b + m + a + kb AS t FROM n1),
       n3 AS (SELECT *, CASE WHEN m > 0 AND m < 0.33::DOUBLE * t THEN CAST(ceil((0.33::DOUBLE * t - m) / (1 - 0.33::DOUBLE)) AS BIGINT) ELSE 0 END AS km FROM n2),
       n4 AS (SELECT *, t + km AS u FROM n3),
       n5 AS (SELECT *, CASE WHEN a > 0 AND a < 0.33::DOUBLE * u THEN CAST(ceil((0.33::DOUBLE * u - a) / (1 - 0.33::DOUBLE)) AS BIGINT) ELSE 0 END AS ka FROM n4)
       SELECT 'baixo' AS classe_risco, b AS originals, b + kb AS n_rows FROM n5 UNION ALL
       SELECT 'medio', m, m + km FROM n5 UNION ALL SELECT 'alto', a, a + ka FROM n5""")
def oversample(spark, d):
    # Counted first and repeated afterwards, so the labels are kept in a table.
    rows = stage(labelled(spark, d).filter(F.col("classe_risco").isNotNull()).select(*K, T, "classe_risco"), "labels")
    out = sampling.oversample_minority(rows, "classe_risco", [*K, T], 0.33)
    return out.groupBy("classe_risco").agg(
        F.count(F.when(F.col("copy_no") == 0, 1)).alias("originals"), F.count(F.lit(1)).alias("n_rows"))


@query("oversample_draws", ORACLE["oversample"])
def oversample_draws(spark, d):
    """The same numbers of rows by draws with replacement."""
    rows = stage(labelled(spark, d).filter(F.col("classe_risco").isNotNull()).select(*K, T, "classe_risco"), "labels")
    out = sampling.oversample_minority(rows, "classe_risco", [*K, T], 0.33, replacement=True)
    return out.groupBy("classe_risco").agg(
        F.count(F.when(F.col("copy_no") == 0, 1)).alias("originals"), F.count(F.lit(1)).alias("n_rows"))


@query("score_history", _FOLD_SCORES + """ SELECT 'fold ' || fold AS run_key, round(f1_macro, 6) AS f1_macro,
       round(balanced_acc, 6) AS balanced_acc, n_rows FROM fs""")
def score_history(spark, d):
    """Scores of each fold recorded as a run; all runs are repeated with other scores, then with the right ones."""
    path = _scratch(spark, "history")
    scores = stage(metrics.macro_scores(pairs(spark, d), "truth", "pred", ["fold"]), "scores")
    runs = rounded(scores, ["f1_macro", "balanced_acc"], 6).select(
        F.concat(F.lit("fold "), F.col("fold").cast("string")).alias("run_key"), "f1_macro", "balanced_acc", "n_rows")
    stores.record_runs(runs.withColumn("f1_macro", F.lit(-1.0)), path)
    stores.record_runs(runs.filter("run_key = 'fold 0'"), path)
    return stores.record_runs(runs.filter("run_key <> 'fold 0'"), path)


@query("report_text", _REPORT + """, m AS (SELECT c AS truth, count(*) FILTER (truth = c AND pred = 'baixo') AS b,
       count(*) FILTER (truth = c AND pred = 'medio') AS m, count(*) FILTER (truth = c AND pred = 'alto') AS a FROM c CROSS JOIN pair GROUP BY 1),
       r AS (SELECT c AS row, p, r, f, sup FROM sc
       UNION ALL SELECT 'accuracy', sum(tp) / sum(sup), sum(tp) / sum(sup), sum(tp) / sum(sup), CAST(sum(sup) AS BIGINT) FROM sc
       UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(sup) AS BIGINT) FROM sc
       UNION ALL SELECT 'weighted avg', sum(p * sup) / sum(sup), sum(r * sup) / sum(sup), sum(f * sup) / sum(sup), CAST(sum(sup) AS BIGINT) FROM sc)
       SELECT concat_ws(chr(9), row, printf('%.3f', p), printf('%.3f', r), printf('%.3f', f), CAST(sup AS VARCHAR)) AS line FROM r
       UNION ALL SELECT concat_ws(chr(9), truth, CAST(b AS VARCHAR), CAST(m AS VARCHAR), CAST(a AS VARCHAR)) FROM m""")
def report_text(spark, d):
    """Report and confusion matrix as lines of text, read back."""
    path = _scratch(spark, "report")
    seen = stage(pairs(spark, d), "pairs")
    stores.write_report(metrics.class_report(seen, "truth", "pred"), metrics.confusion_matrix(seen, "truth", "pred"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---- importances and selection -------------------------------------------------

_IMP_COLS = [c for c in _LABEL_COLS if c not in ("margem_suprimento_w",)]


def importances(spark, d):
    """Importance of a feature: its absolute correlation with the label code."""
    rows = labelled(spark, d).withColumn("code", scalars.encode_label("classe_risco").cast("double"))
    return stage(profile.correlations_with(rows, _IMP_COLS, "code").select(
        F.col("variable").alias("feature"), F.round(F.abs("corr"), 6).alias("importance")), "importances")


_IMP = _STEPS + ", impo AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr({c}, code_final)), 6) AS importance FROM lab" for c in _IMP_COLS) + ")"


@query("topk_importance", _IMP + " SELECT * FROM impo ORDER BY importance DESC, feature LIMIT 4")
def topk_importance(spark, d):
    return selection.top_importances(importances(spark, d), 4)


@query("feature_select", _IMP + """, ranked AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rn FROM impo)
       SELECT feature, importance, CASE WHEN feature IN ('lolp_52w') THEN 'keep_list' WHEN rn <= 3 THEN 'top_k'
       WHEN importance >= 0.2::DOUBLE THEN 'min_importance' END AS reason FROM ranked
       WHERE feature = 'lolp_52w' OR rn <= 3 OR importance >= 0.2::DOUBLE""")
def feature_select(spark, d):
    settings = SelectionSettings(keep=("lolp_52w",), top_k=3, min_importance=0.2)
    return selection.selected_features(importances(spark, d), settings, _IMP_COLS)


@query("importances_json", _IMP + " SELECT * FROM impo")
def importances_json(spark, d):
    """The importances written as a report text and read back."""
    report = importances(spark, d).agg(
        F.to_json(F.struct(F.collect_list(F.struct("feature", "importance")).alias("feature_importances"))).alias("value"))
    return selection.importances_from_text(report, "value")


# ---- catalogue ------------------------------------------------------------------


_RES = """WITH r0 AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, left(o_orderpriority, 1) AS p, o_orderdate,
       CASE o_orderstatus WHEN 'F' THEN 'Serie ' || strftime(o_orderdate, '%Y-%m') WHEN 'O' THEN 'Serie ' || strftime(o_orderdate, '%Y')
       ELSE 'Serie' END AS name FROM orders),
       r AS (SELECT id, name, CASE WHEN p = '4' THEN 'Dicionario de dados' END AS description,
       CASE WHEN p = '5' THEN 'http://data.example/file.CSV' ELSE 'http://data.example/file' END AS url,
       CASE p WHEN '1' THEN 'csv' WHEN '2' THEN 'XLSX' WHEN '3' THEN 'ZIP' WHEN '4' THEN 'CSV' END AS format,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS last_modified FROM r0),
       k AS (SELECT *, name || ' ' || coalesce(description, '') || ' ' || url AS t FROM r),
       per AS (SELECT *, CASE WHEN regexp_matches(t, '(20\\d{2})[-_/.]?(0[1-9]|1[0-2])') THEN
         regexp_extract(t, '(20\\d{2})[-_/.]?(0[1-9]|1[0-2])', 1) || '-' || regexp_extract(t, '(20\\d{2})[-_/.]?(0[1-9]|1[0-2])', 2)
         WHEN regexp_matches(t, '(19\\d{2}|20\\d{2})') THEN regexp_extract(t, '(19\\d{2}|20\\d{2})', 1)
         ELSE left(last_modified, 7) END AS period FROM k)"""


@query("is_data_file", _RES + """ SELECT id, description IS NULL AND (coalesce(upper(format) IN ('CSV', 'XLSX', 'XLS', 'ZIP'), FALSE)
       OR lower(url) LIKE '%.csv') AS is_data FROM r""")
def is_data_file(spark, d):
    df = tables.resources(spark, d)
    return df.select("id", catalog.is_data_file(df).alias("is_data"))


@query("period_key", _RES + " SELECT id, period FROM per")
def period_key(spark, d):
    df = tables.resources(spark, d)
    return df.select("id", catalog.period_key(df).alias("period"))


@query("in_period", _RES + """ SELECT id FROM (SELECT id, CAST(left(period, 4) AS INTEGER) AS y,
       try_cast(nullif(substr(period, 6, 2), '') AS INTEGER) AS m FROM per)
       WHERE (y > 1997 OR (y = 1997 AND coalesce(m >= 6, FALSE))) AND y <= 2000""")
def in_period(spark, d):
    df = tables.resources(spark, d)
    return catalog.in_period(df, "1997-06", "2000").select("id")


@query("best_per_period", _RES + """ SELECT period, id, format FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY
       CASE upper(format) WHEN 'CSV' THEN 0 WHEN 'XLSX' THEN 1 WHEN 'ZIP' THEN 2 ELSE 3 END, last_modified, id) AS rn FROM per) WHERE rn = 1""")
def best_per_period(spark, d):
    return catalog.best_per_period(tables.resources(spark, d)).select("period", "id", "format")


@query("best_overall", _RES + """ SELECT id, name FROM r ORDER BY CASE upper(format) WHEN 'CSV' THEN 0 WHEN 'XLSX' THEN 1 WHEN 'ZIP' THEN 2
       ELSE 3 END, last_modified, id LIMIT 1""")
def best_overall(spark, d):
    return catalog.best_overall(tables.resources(spark, d)).select("id", "name")


@query("filter_names", _RES + """ SELECT 'hit' AS kind, id FROM r WHERE regexp_matches(name || ' ' || coalesce(description, ''), '199[67]')
       UNION ALL SELECT 'fallback', id FROM r""")
def filter_names(spark, d):
    df = tables.resources(spark, d)
    hit = catalog.filter_names(df, "199[67]").select(F.lit("hit").alias("kind"), "id")
    return hit.unionByName(catalog.filter_names(df, "no such name").select(F.lit("fallback").alias("kind"), "id"))


_PKG = """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, lower(p_brand || '-' || p_type) AS name, p_name AS title, p_size FROM part),
       s AS (SELECT *, CASE WHEN contains(title, 'red widget') OR contains('red widget', title) THEN 10 ELSE 0 END
         + CASE WHEN contains(name, 'brand#17-promo') THEN 500 ELSE 0 END AS score FROM p)"""


@query("catalog_score", _PKG + " SELECT id, score FROM s")
def catalog_score(spark, d):
    df = tables.packages(spark, d)
    return df.select("id", catalog.package_score(df, "Réd  Widget!", "brand#17-promo").alias("score"))


@query("catalog_best_package", _PKG + " SELECT id, name, score FROM s ORDER BY contains(name, 'brand#17-promo') DESC, score DESC, p_size DESC, id LIMIT 1")
def catalog_best_package(spark, d):
    return catalog.best_package(tables.packages(spark, d), "red widget", "brand#17-promo").select("id", "name", "score")


# ---- profiling --------------------------------------------------------------------

_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("overview", """SELECT 'orders' AS dataset, count(*) AS n_rows, 6::BIGINT AS n_columns, CAST(min(o_orderdate) AS DATE) AS first_day,
       CAST(max(o_orderdate) AS DATE) AS last_day FROM orders UNION ALL
       SELECT 'units', count(*), 11, CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem""")
def overview(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderdate", "t")
    lines = table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "t")
    return profile.overview({"orders": orders, "units": lines}, "t")


@query("missing_ratio", _LOAD + """ SELECT 'carga_mwh' AS variable, round(avg(CASE WHEN carga_mwh IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS percent_null FROM load_raw
       UNION ALL SELECT 'series_key', round(avg(CASE WHEN series_key IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) FROM load_raw""")
def missing_ratio(spark, d):
    return rounded(profile.missing_ratio(tables.load_rows(spark, d), ["carga_mwh", "series_key"]), ["percent_null"], 6)


@query("top_missing", _GENSQL + """, m AS (""" + _unpivot_sql(
    _GEN, "gen_day", "round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)", "percent_null")
       + ") SELECT * FROM m ORDER BY percent_null DESC, variable LIMIT 2")
def top_missing(spark, d):
    return rounded(profile.top_missing(gen_day(spark, d), _GEN, 2), ["percent_null"], 6)


@query("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min,
    round(quantile_cont({c}, 0.25::DOUBLE), 4) AS q25, round(median({c}), 4) AS q50, round(quantile_cont({c}, 0.75::DOUBLE), 4) AS q75,
    max({c}) AS max FROM lineitem""" for c in ("l_quantity", "l_extendedprice")))
def describe(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return rounded(out, ["mean", "std", "q25", "q50", "q75"])


@query("box_stats", """SELECT event_type, 'value' AS variable, round(quantile_cont(value, 0.25::DOUBLE), 4) AS q25, round(median(value), 4) AS q50,
       round(quantile_cont(value, 0.75::DOUBLE), 4) AS q75 FROM events GROUP BY 1""")
def box_stats(spark, d):
    return rounded(profile.box_stats(table(spark, d, "events"), "event_type", ["value"]), ["q25", "q50", "q75"])


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _LI for b in _LI))
def corr_matrix(spark, d):
    return rounded(profile.correlation_matrix(table(spark, d, "lineitem"), _LI), ["corr"], 6)


@query("corr_store", _BASE + """, w AS (SELECT series_key, data, variable, value FROM (UNPIVOT (SELECT series_key, data, """ + ", ".join(f'"{c}"' for c in BASE_COLS) + """ FROM base)
             ON COLUMNS(* EXCLUDE (series_key, data)) INTO NAME variable VALUE value)),
       p AS (SELECT a.variable AS var_a, b.variable AS var_b, corr(a.value, b.value) AS c, least(stddev_pop(a.value) / nullif(max(abs(a.value)), 0),
             stddev_pop(b.value) / nullif(max(abs(b.value)), 0)) AS varies FROM w a JOIN w b USING (series_key, data) GROUP BY 1, 2)
       SELECT var_a, var_b, CASE WHEN varies > 1e-8 THEN round(c, 4) + 0.0 END AS corr FROM p""")
def corr_store(spark, d):
    """Correlations of all columns of the weekly base store."""
    base = weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FULL)
    found = profile.correlation_matrix(base, [c for c in base.columns if c not in (*K, T)])
    return found.withColumn("corr", F.round("corr", 4) + 0.0)


@query("dup_keys", """SELECT l_orderkey, l_linenumber, count(*) - 1 AS surplus FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dup_keys(spark, d):
    return profile.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem"
    for c in ("l_suppkey", "l_quantity")))
def distinct_counts(spark, d):
    return profile.value_counts(table(spark, d, "lineitem"), ["l_suppkey", "l_quantity"])


@query("unpivot", """SELECT l_orderkey, l_linenumber, l_partkey, variable, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey,
       l_quantity, l_extendedprice FROM lineitem) ON l_quantity, l_extendedprice INTO NAME variable VALUE value)""")
def unpivot(spark, d):
    return profile.melt(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_extendedprice"])


@query("head_tail", _DENSE + """ SELECT * FROM (SELECT data, series_key, carga_mwh, 'head' AS part FROM dense ORDER BY data, series_key LIMIT 5)
       UNION ALL SELECT * FROM (SELECT data, series_key, carga_mwh, 'tail' AS part FROM dense ORDER BY data DESC, series_key DESC LIMIT 5)""")
def head_tail(spark, d):
    return profile.head_tail(load_dense(spark, d), [T, "series_key"], 5)


@query("high_risk_weeks", _STEPS + " SELECT series_key, data FROM lab WHERE classe_risco = 'alto'")
def high_risk_weeks(spark, d):
    return labelled(spark, d).filter(F.col("classe_risco") == "alto").select(*K, T)


@query("median_scale_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(median({c}), 6) AS median, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem"
    for c in ("l_quantity", "l_discount")))
def median_scale_stats(spark, d):
    return rounded(training.column_statistics(table(spark, d, "lineitem"), ["l_quantity", "l_discount"]), ["median", "mean", "std"], 6)


@query("data_tests", """SELECT 'orders' AS "table", 'unique(o_orderkey)' AS test, count(*) - count(DISTINCT o_orderkey) AS violations FROM orders
       UNION ALL SELECT 'orders', 'not_null(o_custkey)', count(*) - count(o_custkey) FROM orders
       UNION ALL SELECT 'orders', 'range(o_totalprice)', count(*) FILTER (o_totalprice < 0 OR o_totalprice > 400000) FROM orders""")
def data_tests(spark, d):
    return profile.data_tests(table(spark, d, "orders"), "orders", [["o_orderkey"]], ["o_custkey"], {"o_totalprice": (0, 400000)})


# ---- marts --------------------------------------------------------------------------

_MONTHS = "CASE month(data) " + " ".join(f"WHEN {m} THEN '{n}'" for m, n in dates.MONTH_NAMES_PT.items()) + " END"


@query("dim_calendar", f"""WITH b AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders),
       d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS data FROM b)
       SELECT data, CAST(day(data) AS INTEGER) AS dia_do_mes, {_MONTHS} AS nome_mes_pt, CAST(month(data) AS INTEGER) AS numero_mes,
       CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre,
       CASE WHEN month(data) <= 6 THEN 1 ELSE 2 END AS semestre,
       CASE WHEN month(data) <= 4 THEN 1 WHEN month(data) <= 8 THEN 2 ELSE 3 END AS quadrimestre,
       CAST(date_trunc('month', data) AS DATE) AS primeiro_dia_mes FROM d""")
def dim_calendar(spark, d):
    return marts.dim_calendar(table(spark, d, "orders"), "o_orderdate")


@query("fact_weekly", _BASE + " SELECT series_key, data, " + ", ".join(
    f"round({c}, 4) AS {n}" for c, n in marts.fact_columns().items()) + " FROM base")
def fact_weekly(spark, d):
    fact = marts.fact_weekly(weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FULL))
    return rounded(fact, list(marts.fact_columns().values()))


# ---- raw feeds ----------------------------------------------------------------------

def lower_key(sql: str) -> str:
    return f"SELECT lower(replace(series_key, ' ', '_')) AS series_key, * EXCLUDE (series_key) FROM ({sql})"


@query("etl_generation", lower_key(q.with_(q.PLACES, q.UNITS, q.GEN_DAY, q.dense("g", "gen_day", _GEN)) + " SELECT * FROM g"))
def etl_generation(spark, d):
    return feeds.generation(tables.raw_balance(spark, d))


@query("etl_exchange", lower_key(_FLOWSQL + """ SELECT series_key, data, coalesce(import_mwh, 0) AS import_mwh,
       coalesce(export_mwh, 0) AS export_mwh FROM f"""))
def etl_exchange(spark, d):
    return feeds.exchange(tables.raw_exchange(spark, d))


@query("etl_load", lower_key(_DENSE + " SELECT * FROM dense"))
def etl_load(spark, d):
    return feeds.load(tables.raw_load(spark, d))


@query("etl_load_half_hour", lower_key(_DENSE + " SELECT series_key, data, carga_mwh * 0.5 AS carga_mwh FROM dense"))
def etl_load_half_hour(spark, d):
    return feeds.load(tables.raw_load(spark, d), step_hours=0.5)


@query("etl_inflow", lower_key(q.with_(q.PLACES, q.UNITS) + " SELECT series_key, data, sum(ena_mwmed) AS ena_sum, count(*) AS n_rows FROM unit_raw GROUP BY ALL"))
def etl_inflow(spark, d):
    return feeds.inflow(tables.raw_inflow(spark, d)).groupBy(*K, T).agg(
        F.sum("ena_mwmed").alias("ena_sum"), F.count(F.lit(1)).alias("n_rows"))


@query("etl_storage", lower_key(q.with_(q.PLACES, q.UNITS) + " SELECT series_key, data, sum(ear_pct) AS ear_sum, count(*) AS n_rows FROM unit_raw GROUP BY ALL"))
def etl_storage(spark, d):
    return feeds.storage(tables.raw_storage(spark, d)).groupBy(*K, T).agg(
        F.sum("ear_pct").alias("ear_sum"), F.count(F.lit(1)).alias("n_rows"))


@query("etl_curtailment", """WITH e AS (SELECT event_type AS series_key, user_id AS plant, ts, event_id,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ref, value AS gen FROM events),
       last_of AS (SELECT series_key, plant, ts, arg_max(ref, event_id) AS ref, arg_max(gen, event_id) AS gen FROM e GROUP BY ALL),
       s AS (SELECT *, (epoch_us(lead(ts) OVER (PARTITION BY series_key, plant ORDER BY ts)) - epoch_us(ts)) / 3.6e9 AS step FROM last_of),
       t AS (SELECT series_key, plant, median(step) AS m FROM s GROUP BY ALL)
       SELECT series_key, CAST(ts AS DATE) AS data, round(sum(greatest(ref - gen, 0) * coalesce(step, CASE WHEN m > 0 THEN m ELSE 0.5 END)), 3) AS corte_eolica_mwh
       FROM s JOIN t USING (series_key, plant) GROUP BY 1, 2""")
def etl_curtailment(spark, d):
    out = feeds.curtailment(tables.raw_curtailment(spark, d), "eolica", order="event_id")
    return rounded(out, ["corte_eolica_mwh"], 3)


@query("etl_monthly_cuts", lower_key(q.with_(q.PLACES, q.UNITS, """
mon AS (SELECT series_key, CAST(date_trunc('month', data) AS DATE) AS m, coalesce(sum(cut_mwh), 0) AS v FROM unit_raw GROUP BY 1, 2)""")
       + _SPREAD.format(c="corte_fv_mwh")))
def etl_monthly_cuts(spark, d):
    return rounded(feeds.curtailment(tables.raw_monthly_cuts(spark, d), "fv"), ["corte_fv_mwh"])


_ROLES = {
    "ger_hidreletrica_mwh": "val_gerhidraulica", "ger_termica_mwh": "val_gertermica", "ger_eolica_mwh": "val_gereolica",
    "ger_fv_mwh": "val_gersolar", "origin": "id_subsistema_origem", "destination": "id_subsistema_destino",
    "flow": "val_intercambiomwmed", "load": "val_cargaglobal", "inflow": "ena_bruta_regiao_mwmed",
    "storage": "ear_verif_subsistema_percentual"}


# Per role the value in SQL and the table it is read from.
_ROLE_VALUES = {
    "ger_hidreletrica_mwh": ("CASE WHEN unit IN (1, 2) THEN mwh END", "unit_raw"), "ger_eolica_mwh": ("CASE WHEN unit IN (3, 4) THEN mwh END", "unit_raw"),
    "ger_fv_mwh": ("CASE WHEN unit = 5 THEN mwh END", "unit_raw"), "ger_termica_mwh": ("CASE WHEN unit IN (6, 7) THEN mwh END", "unit_raw"),
    "origin": ("origin", "exch_raw"), "destination": ("destination", "exch_raw"), "flow": ("mwh", "exch_raw"),
    "load": ("carga_mwh", "load_raw"), "inflow": ("ena_mwmed", "unit_raw"), "storage": ("ear_pct", "unit_raw")}


@query("role_resolution", q.with_(q.PLACES, q.LOAD, q.UNITS, q.EXCHANGE) + " " + " UNION ALL ".join(
    f"""SELECT '{r}' AS role, '{_ROLES[r]}' AS "column", count(*) AS n_rows, count({v}) AS n_values,
    CAST(sum(TRY_CAST({v} AS DOUBLE)) AS DOUBLE) AS total FROM {src}""" for r, (v, src) in _ROLE_VALUES.items()))
def role_resolution(spark, d):
    """The columns each raw feed's roles resolve to, with the rows, values and sum of numbers found in them."""
    balance, flows, load = tables.raw_balance(spark, d), tables.raw_exchange(spark, d), tables.raw_load(spark, d)
    inflow, storage = tables.raw_inflow(spark, d), tables.raw_storage(spark, d)
    origin, dest, value = roles.flow_columns(flows.columns)
    out = None
    for raw, found in (
        (balance, roles.generation_columns(balance.columns)), (flows, {"origin": origin, "destination": dest, "flow": value}),
        (load, {"load": roles.load_column(load)}), (inflow, {"inflow": roles.inflow_column(inflow.columns)}),
        (storage, {"storage": roles.storage_column(storage.columns)}),
    ):
        aggs = [F.struct(F.lit(r).alias("role"), F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"),
                         F.count(F.when(F.trim(c) != "", 1)).alias("n_values"), F.sum(scalars.to_number(c)).alias("total")) for r, c in found.items()]
        part = raw.agg(F.array(*aggs).alias("found")).select(F.inline("found"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- files ---------------------------------------------------------------------------

def _scratch(spark, name):
    return f"{staging_root(spark)}/weekloom/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal, c_mktsegment,
       (SELECT count(*) FROM customer) AS n_rows FROM customer""")
def csv_roundtrip(spark, d):
    """Customers written into one folder with two separators, two encodings and two orders of columns, read by detection."""
    path = _scratch(spark, "customer-csv")
    names = {"c_custkey": "C_CustKey", "c_name": "C Name", "c_acctbal": "Ç_Acctbal", "c_mktsegment": "c_mktsegment"}
    kinds = ((";", "ISO-8859-1", list(names)), (",", "UTF-8", list(names)), (",", "UTF-8", ["c_mktsegment", "c_acctbal", "c_name", "c_custkey"]))
    for i, (sep, encoding, cols) in enumerate(kinds):
        part = table(spark, d, "customer").filter(F.col("c_custkey") % 3 == i).select(*[F.col(c).alias(names[c]) for c in cols])
        part.write.mode("append").option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    raw = delimited.read_raw(spark, path)
    return raw.withColumn("c_acctbal", scalars.to_number("c_acctbal")).withColumn("n_rows", F.lit(raw.count()))


@query("csv_line_breaks", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(10) || 'says "yes", twice' || chr(10) ELSE c_name END AS note,
       c_mktsegment FROM customer""")
def csv_line_breaks(spark, d):
    """Customers in files whose quoted notes hold line breaks, separators and quotes, read in blocks much smaller than a file."""
    path = _scratch(spark, "customer-notes")
    note = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit('\nsays "yes", twice\n'))).otherwise(F.col("c_name"))
    rows = table(spark, d, "customer").select("c_custkey", note.alias("note"), "c_mktsegment")
    rows.coalesce(2).write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(16 * 1024))
    try:
        return stage(delimited.read_raw(spark, path), "customer-notes")
    finally:
        spark.conf.set(name, before)


@query("union_by_name", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def union_by_name(spark, d):
    """Files of one folder with different columns in different order, consolidated by name."""
    layouts = {"F": ["o_orderkey", "o_totalprice"], "O": ["o_totalprice", "o_orderkey", "o_orderpriority"], "P": ["o_orderkey", "o_orderpriority"]}
    path = _scratch(spark, "orders")
    for status, cols in layouts.items():
        delimited.write_canonical(table(spark, d, "orders").filter(F.col("o_orderstatus") == status).select(*cols), path, "append")
    out = delimited.consolidate(spark, [path])
    return out.withColumn("o_totalprice", scalars.to_number("o_totalprice"))


@query("json_records", "SELECT event_id, value, NULL::BIGINT AS page FROM events")
def json_records(spark, d):
    """Events as payloads whose first list has one of two names, the other list after it, read back."""
    path = _scratch(spark, "payload")
    records, other = F.array(F.struct("event_id", "value")), F.array(F.struct(F.lit(7).cast("bigint").alias("page")))
    events = table(spark, d, "events")
    for i, (first, second) in enumerate((("result", "items"), ("items", "result"))):
        events.filter(F.col("event_id") % 2 == i).select(
            F.lit("ok").alias("status"), records.alias(first), other.alias(second)).write.mode("append").json(path)
    return json_feeds.read_records(spark, path, one_per_line=True).select("event_id", "value", "page")


@query("load_sources", _FILL + " SELECT * FROM fill")
def load_sources(spark, d):
    """Daily load saved under its standard name and loaded again, gaps filled."""
    path = _scratch(spark, "raw")
    stores.save_sources({"carga": load_day(spark, d)}, path)
    return stores.load_sources(spark, path)["carga"].withColumn(T, F.col(T).cast("date"))


@query("parquet_store", _WEEK + " SELECT * FROM (SELECT series_key, data, carga_mwh_sum_w FROM wk)")
def parquet_store(spark, d):
    """The weekly load written once, kept on the second attempt, and read back."""
    path = _scratch(spark, "store")
    week = load_week(spark, d, ("sum",))
    stores.write_table(week, path)
    stores.write_table(week.limit(0), path)
    return spark.read.parquet(path)


@query("warehouse_view", _WEEK + " SELECT series_key, count(*) AS n_weeks FROM wk GROUP BY 1")
def warehouse_view(spark, d):
    view = marts.publish(load_week(spark, d, ("sum",)), "weekloom_load_week", as_view=True)
    return view.groupBy(*K).agg(F.count(F.lit(1)).alias("n_weeks"))


@query("warehouse_table", ORACLE["warehouse_view"])
def warehouse_table(spark, d):
    """The weekly load as a managed table."""
    kept = marts.publish(load_week(spark, d, ("sum",)), f"weekloom_load_week_{uuid.uuid4().hex}")
    return kept.groupBy(*K).agg(F.count(F.lit(1)).alias("n_weeks"))


_GEN_COLS = [f"{c}_sum_w" for c in _GEN]


@query("reindex", _BASE + f" SELECT series_key, data, {', '.join(_GEN_COLS)}, CAST(NULL AS DOUBLE) AS not_there FROM base")
def reindex(spark, d):
    base = weekly.base_store(tables.daily_long(spark, d), tables.VARIABLES, FULL)
    return coverage.reindex_columns(base, [*_GEN_COLS, "not_there"], [*K, T])


_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n_values, round(CAST(max({c}) AS DOUBLE), 4) AS highest FROM lineitem" for c in _NUMBERS))
def numeric_columns(spark, d):
    """The columns of numbers among all columns of the lines, with their values."""
    line = table(spark, d, "lineitem")
    found = F.array(*[F.struct(F.lit(c).alias("variable"), F.count(c).alias("n_values"), F.max(c).cast("double").alias("highest"))
                      for c in coverage.numeric_columns(line)])
    return rounded(line.agg(found.alias("found")).select(F.inline("found")), ["highest"])


@query("drop_empty", "SELECT event_id, value FROM events")
def drop_empty(spark, d):
    rows = table(spark, d, "events").select("event_id", "value", F.get_json_object("props", "$.missing").alias("gone"))
    return coverage.drop_empty_columns(rows, ["event_id"])


# ---- models ----------------------------------------------------------------------------


# Scores show the model itself, so the hard rules stay out of them.
_MODEL_RULES = LabelRules(hard_on=False)
_MODEL_SETTINGS = Settings(features=LEAN, labels=_MODEL_RULES, training=TrainSettings(n_splits=2, tuning_splits=2))


def _training_data(spark, d):
    store = weekly.extend_week(label_base(spark, d), _LABEL_COLS, FeatureSettings(lags=(1,), rolls=(4,)))
    return training.prepare_training(store, _MODEL_SETTINGS)


def _scored(spark, d, family, params):
    """Fit on the training weeks and report on the held-out ones."""
    data = _training_data(spark, d)
    model = training.fit_model(data.train, data.features, training.ModelSpec(family, family, params))
    return training.evaluate(model, data.holdout, _MODEL_RULES, 1).report


@query("logreg_score")
def logreg_score(spark, d):
    return _scored(spark, d, "logreg", {"max_iter": 50})


@query("rf_score")
def rf_score(spark, d):
    return _scored(spark, d, "rf", {"n_estimators": 20, "max_depth": 6, "class_weight": "balanced"})


@query("gbt_score")
def gbt_score(spark, d):
    return _scored(spark, d, "gbt", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1})


@query("cross_validation")
def cross_validation(spark, d):
    data = _training_data(spark, d)
    return training.cross_validate(
        data.train, data.features, training.ModelSpec("logreg", "logreg", {"max_iter": 30}), _MODEL_SETTINGS.training, _MODEL_RULES)


@query("grid_search")
def grid_search(spark, d):
    data = _training_data(spark, d)
    spec = training.ModelSpec("logreg", "logreg", {"max_iter": 20}, grid={"C": [0.1, 1.0]})
    return training.tune(data.train, data.features, spec, _MODEL_SETTINGS.training)[1]


@query("score_requests")
def score_requests(spark, d):
    """Every week's features sent as JSON requests and scored in one batch."""
    data = _training_data(spark, d)
    model = training.fit_model(data.train, data.features, training.ModelSpec("rf", "rf", {"n_estimators": 10, "max_depth": 4}))
    requests = data.holdout.select(*K, T, F.to_json(F.struct(F.struct(*data.features).alias("features"))).alias("body"))
    return training.score_requests(model, requests, "body", [*K, T])


@query("fold_rows", _STEPS + _SHARED.format("lab") + """, f AS (SELECT CASE WHEN (n - rn) // (n // 6) < 5 THEN 5 - (n - rn) // (n // 6) ELSE 0 END AS fold
       FROM lab JOIN t USING (data) WHERE classe_risco IS NOT NULL)
       SELECT CAST(k AS INTEGER) AS fold, (SELECT count(*) FROM f WHERE fold < k) AS n_train, (SELECT count(*) FROM f WHERE fold = k) AS n_test
       FROM unnest([1, 2, 3, 4, 5]) AS g(k)""")
def fold_rows(spark, d):
    """Rows that each fold of the configured validation trains and tests on."""
    folds = windows.expanding_folds(labelled(spark, d), T, 5)
    return training.fold_sizes(folds, 5)


_FAMILIES = {"logreg": {"max_iter": 100}, "rf": {"n_estimators": 1, "max_depth": 1, "max_features": "all"}, "gbt": {"n_estimators": 2, "max_depth": 1, "subsample": 1.0, "colsample_bytree": "all"}}


@query("threshold_models", """SELECT family, CAST(l_linenumber AS DOUBLE) AS line, CASE WHEN l_linenumber >= 4 THEN 'alto' ELSE 'baixo' END AS previsto, count(*) AS n
       FROM lineitem, unnest(['logreg', 'rf', 'gbt']) AS g(family) GROUP BY ALL""")
def threshold_models(spark, d):
    """Each family fitted on all lines where the class is a threshold of one column, which it has to reproduce."""
    rows = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("line")).withColumn(
        "classe_risco", F.when(F.col("line") >= 4, "alto").otherwise("baixo"))
    counts = rows.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    out = None
    for family, params in _FAMILIES.items():
        model = training.fit_model(rows, ["line"], training.ModelSpec(family, family, params))
        part = model.predict(counts).select(F.lit(family).alias("family"), "line", "previsto", "n")
        out = part if out is None else out.unionByName(part)
    return out


def _stored(spark, d, thresholds=None):
    """A forest on all lines, saved with its thresholds and loaded again; the table it was fitted on."""
    rows = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("line")).withColumn(
        "classe_risco", F.when(F.col("line") >= 4, "alto").otherwise("baixo"))
    model = training.fit_model(rows, ["line"], training.ModelSpec("rf", "rf", _FAMILIES["rf"]))
    model.thresholds = thresholds
    path = _scratch(spark, "model")
    training.save_model(model, spark, path)
    return training.load_model(spark, [f"{path}-none", path]), rows


@query("stored_model", """SELECT CAST(l_linenumber AS DOUBLE) AS line, CASE WHEN l_linenumber >= 4 THEN 'alto' ELSE 'baixo' END AS previsto, count(*) AS n
       FROM lineitem GROUP BY ALL""")
def stored_model(spark, d):
    """Answers of a model that was saved and loaded by the first path that exists."""
    model, rows = _stored(spark, d)
    return model.predict(rows.groupBy("line").agg(F.count(F.lit(1)).alias("n"))).select("line", "previsto", "n")


@query("stored_thresholds", ORACLE["thresholds"])
def stored_thresholds(spark, d):
    """Thresholds of the labels as they come back with a stored model."""
    return _stored(spark, d, thresholds(spark, d))[0].thresholds


@query("linear_grid", """WITH t AS (SELECT CAST(l_shipdate AS DATE) AS data, count(*) AS n, count(*) FILTER (l_linenumber >= 4) AS high FROM lineitem GROUP BY 1),
       r AS (SELECT *, row_number() OVER (ORDER BY data) AS rn, count(*) OVER () AS all_dates FROM t),
       f AS (SELECT CASE WHEN (all_dates - rn) // (all_dates // 4) < 3 THEN 3 - (all_dates - rn) // (all_dates // 4) ELSE 0 END AS fold, sum(n) AS n, sum(high) AS high
             FROM r GROUP BY 1),
       s AS (SELECT k, sum(n) FILTER (fold = k) AS n, sum(high) FILTER (fold = k) AS high,
                    2 * sum(high) FILTER (fold < k) > sum(n) FILTER (fold < k) AS says_high FROM f, unnest([1, 2, 3]) AS g(k) GROUP BY k),
       m AS (SELECT avg(CASE WHEN says_high THEN 2.0 * high / (n + high) ELSE 2.0 * (n - high) / (2 * n - high) END / 2) AS f1 FROM s)
       SELECT CAST(1e-9 AS DOUBLE) AS c, round(f1, 6) AS f1_macro, CAST(0.5 AS DOUBLE) AS balanced_acc, FALSE AS best FROM m UNION ALL SELECT 1e4, 1.0, 1.0, TRUE""")
def linear_grid(spark, d):
    """A search grid over all lines by ship date: with all weight on the penalty the larger class is answered, without it the class is a threshold."""
    rows = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias(T), F.col("l_linenumber").cast("double").alias("line"),
                                              F.when(F.col("l_linenumber") >= 4, "alto").otherwise("baixo").alias("classe_risco"))
    spec = training.ModelSpec("logreg", "logreg", {"class_weight": None, "max_iter": 40}, grid={"C": [1e-9, 1e4]})
    best, scores = training.tune(rows, ["line"], spec, TrainSettings(tuning_splits=3))
    c = F.regexp_extract("params", r"([0-9.e+-]+)\}", 1).cast("double")
    return scores.select(c.alias("c"), F.round("f1_macro", 6).alias("f1_macro"), F.round("balanced_acc", 6).alias("balanced_acc"),
                         (c == float(best.params["C"])).alias("best"))


_TREE_X = ["l_quantity", "l_linenumber", "cents"]
_TREE_ROWS = """base AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS code,
       [CAST(l_quantity AS DOUBLE), CAST(l_linenumber AS DOUBLE), round(l_discount * 100)] AS x, count(*) AS n FROM lineitem GROUP BY ALL)"""


def _tree_sql(levels: int, rows: str, sums: dict[str, str], gain: str, allowed: str, splits: str, value: str) -> str:
    """Trees grown by plain grouping: every cut of every node is scored and the best one taken, level by level.

    ``sums`` are the columns summed per node; the other texts are over {s}l (left), {s}r (right) and {s}t (node).
    """
    names, parts = list(sums), [_TREE_ROWS, f"r0 AS ({rows})"]
    for i in range(levels):
        parts.append(f"""c{i} AS (SELECT k, path, f, x[f + 1] AS v, {', '.join(f'sum({e}) AS {s}' for s, e in sums.items())} FROM r{i}, unnest([0, 1, 2]) AS u(f) GROUP BY ALL),
          s{i} AS (SELECT k, path, f, v, {', '.join(f'sum({s}) OVER w AS {s}l, sum({s}) OVER a AS {s}t, sum({s}) OVER a - sum({s}) OVER w AS {s}r' for s in names)},
                   max(v) OVER a AS top FROM c{i} WINDOW w AS (PARTITION BY k, path, f ORDER BY v), a AS (PARTITION BY k, path, f)),
          q{i} AS (SELECT *, row_number() OVER (PARTITION BY k, path ORDER BY gain DESC, f, v) AS rn
                   FROM (SELECT *, {gain} AS gain FROM s{i} WHERE v < top) WHERE {allowed}),
          b{i} AS (SELECT k, path, f, v, gain FROM q{i} WHERE rn = 1 AND gain > 0 AND {splits}),
          r{i + 1} AS (SELECT r{i}.* REPLACE (path || CASE WHEN x[f + 1] > v THEN 'R' ELSE 'L' END AS path) FROM r{i} JOIN b{i} USING (k, path))""")
    inner = [f"SELECT k, path, f, v, gain FROM b{i}" for i in range(levels)]
    nodes = " UNION ALL ".join(f"SELECT k, path, {', '.join(f'sum({e}) AS {s}t' for s, e in sums.items())} FROM r{i} GROUP BY ALL" for i in range(levels + 1))
    return "WITH " + ",\n".join(parts) + f""" SELECT CAST(k AS INTEGER) AS cls, path, {_TREE_X!r}[f + 1] AS feature, v AS threshold, round(gain, 6) AS gain, {value}
       FROM ({nodes}) LEFT JOIN ({' UNION ALL '.join(inner)}) USING (k, path)"""


def _tree_table(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", F.col("l_linenumber").cast("double").alias("l_linenumber"), F.round(F.col("l_discount") * 100).alias("cents"),
                                              F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("code"))
    return design.design_rows(rows, _TREE_X, F.col("code"))


def _soft(s: str) -> str:
    return f"pow(greatest(abs(g{s}) - 20, 0), 2) / (h{s} + 5)"


@query("boosting_round", _tree_sql(
    2, "SELECT k, '' AS path, x, n * (1 / 3.0 - (code = k)::INT) AS g, n * 4 / 9.0 AS h FROM base, unnest([0, 1, 2]) AS u(k)", {"g": "g", "h": "h"},
    f"{_soft('l')} + {_soft('r')} - {_soft('t')}", "hl >= 50 AND hr >= 50", "TRUE", "round(-sign(gt) * greatest(abs(gt) - 20, 0) / (ht + 5) * 0.3, 8) AS value"))
def boosting_round(spark, d):
    """One round of softmax boosting: the trees of all three classes, two levels deep, with both penalties."""
    params = {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.3, "reg_lambda": 5, "reg_alpha": 20, "min_child_weight": 50}
    model = trees.boost(_tree_table(spark, d), 3, 3, 0, [(params, 0)])[0]
    return model.table(spark, _TREE_X).select("cls", "path", "feature", "threshold", F.round("gain", 6).alias("gain"), F.round("value", 8).alias("value"))


def _gini(s: str) -> str:
    return f"(n{s} - (pow(c0{s}, 2) + pow(c1{s}, 2) + pow(c2{s}, 2)) / n{s})"


@query("forest_nodes", _tree_sql(
    4, "SELECT -1 AS k, '' AS path, x, n, n * (code = 0)::INT AS c0, n * (code = 1)::INT AS c1, n * (code = 2)::INT AS c2 FROM base",
    {"n": "n", "c0": "c0", "c1": "c1", "c2": "c2"}, f"({_gini('t')} - {_gini('l')} - {_gini('r')}) / nt", "nl >= 100 AND nr >= 100", "nt >= 6000",
    "CAST(nt AS BIGINT) AS n_rows, round(c0t / nt, 8) AS share_0, round(c1t / nt, 8) AS share_1, round(c2t / nt, 8) AS share_2").replace(
        "gain > 0 AND nt", "gain > 1e-12 AND nt"))
def forest_nodes(spark, d):
    """A tree over all lines, four levels deep, whose nodes of less than 6,000 rows are leaves."""
    params = {"n_estimators": 1, "max_depth": 4, "min_samples_split": 6000, "min_samples_leaf": 100, "max_features": "all", "bootstrap": False}
    model = trees.forest(_tree_table(spark, d), 3, 3, 0, [(params, 0)])[0]
    nodes = model.table(spark, _TREE_X)
    shares = [F.round(F.col("stats")[i] / F.col("stats")[3], 8).alias(f"share_{i}") for i in range(3)]
    return nodes.select("cls", "path", "feature", "threshold", F.round("gain", 6).alias("gain"), F.col("stats")[3].cast("long").alias("n_rows"), *shares)


@query("class_probabilities", """WITH s AS (SELECT CAST(l_linenumber AS DOUBLE) AS line, avg((l_returnflag = 'R')::INT) AS baixo FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1)
       SELECT line, round(baixo, 4) AS prob_baixo, CAST(0 AS DOUBLE) AS prob_medio, round(1 - baixo, 4) AS prob_alto FROM s""")
def class_probabilities(spark, d):
    """Probabilities of all three classes from a forest that saw two of them; a leaf for each value answers its shares."""
    rows = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("line"), F.when(F.col("l_returnflag") == "R", "baixo").when(
        F.col("l_returnflag") == "A", "alto").alias("classe_risco")).filter("classe_risco IS NOT NULL")
    params = {"n_estimators": 1, "max_depth": None, "max_features": "all", "bootstrap": False}
    model = training.fit_model(rows, ["line"], training.ModelSpec("rf", "rf", params))
    found = model.probabilities(rows.select("line").distinct())
    return found.select("line", *[F.round(f"prob_{c}", 4).alias(f"prob_{c}") for c in scalars.LABELS])


@query("request_status", """SELECT c_custkey, CASE WHEN c_custkey % 5 IN (1, 2) THEN 400 ELSE 200 END AS status,
       CASE WHEN c_custkey % 5 IN (1, 2) THEN NULL ELSE 'baixo' END AS classe_risco,
       CASE c_custkey % 5 WHEN 1 THEN 'payload must be a JSON object' WHEN 2 THEN 'features must be a JSON object' END AS error FROM customer""")
def request_status(spark, d):
    """A request per customer, some malformed and some with the request as text under ``body``, answered by a model of one class."""
    rows = table(spark, d, "customer")
    model = training.fit_model(rows.select("c_acctbal", F.lit("baixo").alias("classe_risco")), ["c_acctbal"], training.ModelSpec("rf", "rf"))
    whole = F.to_json(F.struct(F.struct("c_acctbal").alias("features")))
    sent = F.when(F.col("c_custkey") % 5 == 1, F.lit("[1, 2]")).when(F.col("c_custkey") % 5 == 2, F.lit('{"features": 3}')).when(
        F.col("c_custkey") % 5 == 3, F.to_json(F.struct(whole.alias("body")))).otherwise(whole)
    return training.score_requests(model, rows.withColumn("request", sent), "request", ["c_custkey"])


# ---- documented indicators ---------------------------------------------------------------

@query("days_of_supply", q.with_(q.PLACES, q.LOAD, q.UNITS, q.GEN_DAY) + """ SELECT series_key, data,
       ger_hidreletrica_mwh * 24 * day(last_day(data)) AS stock_mwh,
       round(ger_hidreletrica_mwh * 24 * day(last_day(data)) / nullif(carga_mwh, 0), 4) AS days
       FROM gen_day JOIN load_day USING (series_key, data)""")
def days_of_supply(spark, d):
    """Days of load that the hydro output, read as MW-months in store, would last."""
    both = gen_day(spark, d).select(*K, T, "ger_hidreletrica_mwh").join(load_day(spark, d), [*K, T])
    stock = both.withColumn("stock_mwh", margins.stored_energy_mwh("ger_hidreletrica_mwh", T))
    return stock.select(*K, T, "stock_mwh", F.round(margins.days_of_supply("stock_mwh", "carga_mwh"), 4).alias("days"))


@query("local_days", """SELECT CAST(timezone('America/Sao_Paulo', timezone('UTC', ts)) AS DATE) AS data, count(*) AS n_rows,
       sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k_sum FROM events GROUP BY 1""")
def local_days(spark, d):
    """Readings by local day, for instants given in UTC."""
    local = scalars.utc_to_local(F.col("ts").cast("timestamp"), "America/Sao_Paulo").cast("date")
    return table(spark, d, "events").groupBy(local.alias(T)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(scalars.to_number(F.get_json_object("props", "$.k"))).alias("k_sum"))


@query("feature_ranking")
def feature_ranking(spark, d):
    """Importances of a random forest over the weekly features, largest first."""
    data = _training_data(spark, d)
    model = training.fit_model(data.train, data.features, training.ModelSpec("rf", "rf", {"n_estimators": 10, "max_depth": 4}))
    return training.feature_importances(model, spark)
