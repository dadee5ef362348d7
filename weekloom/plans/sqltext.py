"""Pieces of the check queries: the same results in plain SQL, written independently.

Each function returns the text of one or more common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

PLACES = """
cust AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey),
supp AS (SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey)"""

LOAD = """
load_raw AS (SELECT r_name AS series_key, CAST(o_orderdate AS DATE) AS data,
             CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 2500) END AS carga_mwh
             FROM orders JOIN cust ON o_custkey = c_custkey),
load_day AS (SELECT series_key, data, sum(carga_mwh) AS carga_mwh FROM load_raw GROUP BY series_key, data)"""

_READINGS = """l_linenumber AS unit, l_quantity AS mwh,
             floor(l_quantity * round(l_discount * 100) / 100) AS cut_mwh,
             floor(l_extendedprice / 1000) AS ena_mwmed, 100 - 10 * round(l_discount * 100) AS ear_pct,
             l_quantity AS ghi, round(l_tax * 100) * 4 AS temp2m_c, round(l_discount * 100) AS precipitacao_mm"""

# Unit rows at the supplier's region.
UNITS = f"""
unit_raw AS (SELECT supp.r_name AS series_key, CAST(l_shipdate AS DATE) AS data, {_READINGS}
             FROM lineitem JOIN supp ON l_suppkey = s_suppkey)"""

# Exchanges need the order's customer as well.
EXCHANGE = f"""
exch_raw AS (SELECT supp.r_name AS origin, cust.r_name AS destination, CAST(l_shipdate AS DATE) AS data, {_READINGS}
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supp ON l_suppkey = s_suppkey
             JOIN cust ON o_custkey = c_custkey)"""

GEN_DAY = """
gen_day AS (SELECT series_key, data,
            sum(mwh) FILTER (unit IN (1, 2)) AS ger_hidreletrica_mwh, sum(mwh) FILTER (unit IN (3, 4)) AS ger_eolica_mwh,
            sum(mwh) FILTER (unit = 5) AS ger_fv_mwh, sum(mwh) FILTER (unit IN (6, 7)) AS ger_termica_mwh,
            sum(cut_mwh) FILTER (unit IN (3, 4)) AS corte_eolica_mwh, sum(cut_mwh) FILTER (unit = 5) AS corte_fv_mwh,
            round(avg(ena_mwmed)) AS ena_mwmed, round(avg(ear_pct)) AS ear_pct, round(avg(ghi)) AS ghi, round(avg(temp2m_c)) AS temp2m_c,
            round(avg(precipitacao_mm)) AS precipitacao_mm
            FROM unit_raw GROUP BY series_key, data)"""

FLOW_DAY = """
imp AS (SELECT destination AS series_key, data, sum(mwh) AS v FROM exch_raw GROUP BY ALL),
exp AS (SELECT origin AS series_key, data, sum(mwh) AS v FROM exch_raw GROUP BY ALL),
flow_day AS (SELECT series_key, data, coalesce(imp.v, 0) AS import_mwh, coalesce(exp.v, 0) AS export_mwh
             FROM imp FULL JOIN exp USING (series_key, data))"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts)


def dense(name: str, src: str, cols: Sequence[str]) -> str:
    values = ", ".join(f"s.{c} AS {c}" for c in cols)
    return f"""
{name}_cal AS (SELECT series_key, CAST(unnest(generate_series(CAST(min(data) AS TIMESTAMP), CAST(max(data) AS TIMESTAMP),
               INTERVAL 1 DAY)) AS DATE) AS data FROM {src} GROUP BY series_key),
{name} AS (SELECT c.series_key, c.data, {values} FROM {name}_cal c
           LEFT JOIN {src} s ON s.series_key = c.series_key AND s.data = c.data)"""


def filled(name: str, src: str, cols: Sequence[str], limit: int | None = 7) -> str:
    start = "UNBOUNDED" if limit is None else str(limit)
    values = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY data ROWS BETWEEN {start} PRECEDING"
        f" AND CURRENT ROW) AS {c}" for c in cols)
    return f"\n{name} AS (SELECT series_key, data, {values} FROM {src})"


_AGG = {
    "mean": ("mean", "avg({c})"), "sum": ("sum", "coalesce(sum({c}), 0)"), "max": ("max", "max({c})"),
    "min": ("min", "min({c})"), "std": ("std", "stddev_samp({c})"),
    "p95": ("_p95", "quantile_cont({c}, 0.95)"), "p05": ("_p05", "quantile_cont({c}, 0.05)"),
}
ALL_AGGS = tuple(_AGG)


def weekly(name: str, src: str, cols: Sequence[str], hows: Sequence[str] = ALL_AGGS) -> str:
    values = ", ".join(f"{_AGG[h][1].format(c=c)} AS {c}_{_AGG[h][0]}_w" for c in cols for h in hows)
    return (f"\n{name} AS (SELECT series_key, CAST(date_trunc('week', data) AS DATE) + 6 AS data, {values}"
            f" FROM {src} GROUP BY 1, 2)")


def weekly_names(cols: Sequence[str], hows: Sequence[str] = ALL_AGGS) -> list[str]:
    return [f"{c}_{_AGG[h][0]}_w" for c in cols for h in hows]


def rounded(cols: Sequence[str], digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


SOURCES = {
    "carga": ("load_day", ["carga_mwh"]),
    "ger": ("gen_day", ["ger_hidreletrica_mwh", "ger_eolica_mwh", "ger_fv_mwh", "ger_termica_mwh"]),
    "flow": ("flow_day", ["import_mwh", "export_mwh"]),
    "ena": ("gen_day", ["ena_mwmed"]),
    "ear": ("gen_day", ["ear_pct"]),
    "cut_wind": ("cut_wind_day", ["corte_eolica_mwh"]),
    "cut_solar": ("cut_solar_day", ["corte_fv_mwh"]),
    "clima": ("gen_day", ["ghi", "temp2m_c", "precipitacao_mm"]),
}
RAIN_COLS = [f"precip_{n}d_mm" for n in (14, 30, 90, 180)]
DERIVED = ["geracao_total_mwh_sum_w", "import_total_mwh_sum_w", "export_total_mwh_sum_w", "margem_suprimento_w",
           "margem_suprimento_min_w", "saldo_importador_mwh_sum_w", "margem_vs_carga_w", "ens_week_mwh",
           "reserve_margin_ratio_w", "ens_week_ratio", "lolp_52w", "corte_renovavel_mwh_sum_w",
           "ger_renovavel_mwh_sum_w", "ratio_corte_renovavel_w"]


def base_parts(hows: Sequence[str] = ALL_AGGS) -> tuple[list[str], list[str]]:
    """The weekly store before lags: source by source, aligned by full joins, then margins."""
    parts = [PLACES, LOAD, UNITS, EXCHANGE, GEN_DAY, FLOW_DAY, """
cut_wind_day AS (SELECT series_key, data, corte_eolica_mwh FROM gen_day WHERE corte_eolica_mwh IS NOT NULL),
cut_solar_day AS (SELECT series_key, data, corte_fv_mwh FROM gen_day WHERE corte_fv_mwh IS NOT NULL)"""]
    cols, weeks = [], []
    for name, (src, values) in SOURCES.items():
        parts += [dense(f"{name}_dense", src, values), filled(f"{name}_fill", f"{name}_dense", values)]
        daily = f"{name}_fill"
        if name == "clima":
            sums = ", ".join(
                f"sum(precipitacao_mm) OVER (PARTITION BY series_key ORDER BY data ROWS BETWEEN {n - 1} PRECEDING"
                f" AND CURRENT ROW) AS precip_{n}d_mm" for n in (14, 30, 90, 180))
            parts.append(f"\nclima_rain AS (SELECT *, {sums} FROM clima_fill)")
            daily, values = "clima_rain", values + RAIN_COLS
        parts.append(weekly(f"{name}_week", daily, values, hows))
        weeks.append(f"{name}_week")
        cols += weekly_names(values, hows)
    joins = " ".join(f"FULL JOIN {w} USING (series_key, data)" for w in weeks[1:])
    gen = SOURCES["ger"][1]
    total = " + ".join(f"coalesce({c}, 0)" for c in gen)
    known = "coalesce(" + ", ".join(gen) + ", import_mwh, export_mwh)"
    parts.append(f"""
aligned AS (SELECT * FROM {weeks[0]} {joins}),
margin_day AS (SELECT series_key, data, CASE WHEN {known} IS NOT NULL
               THEN {total} + coalesce(import_mwh, 0) - coalesce(export_mwh, 0) END AS m
               FROM ger_fill FULL JOIN flow_fill USING (series_key, data)),
margin_known AS (SELECT * FROM margin_day WHERE m IS NOT NULL),
{dense('margin_dense', 'margin_known', ['m']).strip()},
margin_week AS (SELECT series_key, CAST(date_trunc('week', data) AS DATE) + 6 AS data, coalesce(sum(m), 0) AS m_sum,
                min(m) AS m_min FROM margin_dense GROUP BY 1, 2),
totals AS (SELECT aligned.*, m_sum, m_min,
           {' + '.join(f'coalesce({c}_sum_w, 0)' for c in gen)} AS geracao_total_mwh_sum_w,
           coalesce(import_mwh_sum_w, 0) AS import_total_mwh_sum_w, coalesce(export_mwh_sum_w, 0) AS export_total_mwh_sum_w,
           coalesce(corte_eolica_mwh_sum_w, 0) + coalesce(corte_fv_mwh_sum_w, 0) AS corte_renovavel_mwh_sum_w,
           coalesce(ger_eolica_mwh_sum_w, 0) + coalesce(ger_fv_mwh_sum_w, 0) AS ger_renovavel_mwh_sum_w
           FROM aligned LEFT JOIN margin_week USING (series_key, data)),
margins AS (SELECT *, coalesce(m_sum, geracao_total_mwh_sum_w + import_total_mwh_sum_w - export_total_mwh_sum_w) AS margem_suprimento_w,
            coalesce(m_min, m_sum, geracao_total_mwh_sum_w + import_total_mwh_sum_w - export_total_mwh_sum_w) AS margem_suprimento_min_w,
            import_total_mwh_sum_w - export_total_mwh_sum_w AS saldo_importador_mwh_sum_w,
            corte_renovavel_mwh_sum_w / nullif(corte_renovavel_mwh_sum_w + ger_renovavel_mwh_sum_w, 0) AS ratio_corte_renovavel_w
            FROM totals),
gap AS (SELECT *, margem_suprimento_w - carga_mwh_sum_w AS margem_vs_carga_w FROM margins),
ens AS (SELECT *, CASE WHEN margem_vs_carga_w IS NOT NULL THEN greatest(-margem_vs_carga_w, 0) END AS ens_week_mwh,
        margem_vs_carga_w / nullif(carga_mwh_sum_w, 0) AS reserve_margin_ratio_w,
        CASE WHEN count(*) OVER w >= 12 THEN avg(CASE WHEN margem_vs_carga_w < 0 THEN 1.0 ELSE 0.0 END) OVER w END AS lolp_52w
        FROM gap WINDOW w AS (PARTITION BY series_key ORDER BY data ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)),
base AS (SELECT *, ens_week_mwh / nullif(carga_mwh_sum_w, 0) AS ens_week_ratio FROM ens)""")
    return parts, cols + DERIVED
