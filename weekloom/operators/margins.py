"""Weekly supply margins, adequacy proxies and curtailment ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.dates import week_end
from weekloom.functions.scalars import clip_low, net_sum, row_sum, safe_ratio
from weekloom.operators.windows import negative_share

# Names of the daily generation columns.
GENERATION = ("ger_hidreletrica_mwh", "ger_eolica_mwh", "ger_fv_mwh", "ger_termica_mwh")
RENEWABLE = ("ger_eolica_mwh", "ger_fv_mwh")
CURTAILED = ("corte_eolica_mwh", "corte_fv_mwh")


def daily_margin(generation: Sequence, inflow: Sequence = (), outflow: Sequence = ()) -> Column:
    """generation + inflow − outflow with nulls as 0; null when nothing is known that day."""
    return net_sum([*generation, *inflow], list(outflow))


def margin_by_week(df: DataFrame, keys: Sequence[str], day: str, margin: str, week: str = "data") -> DataFrame:
    """Weekly sum and minimum of a daily margin on a continuous calendar.

    A week of nulls between known days has sum 0 and null minimum; weeks
    outside the known range are absent.
    """
    known = F.when(F.col(margin).isNotNull(), week_end(day))
    whole = Window.partitionBy(*keys)
    wk = F.col(week)
    return (
        df.groupBy(*keys, week_end(day).alias(week))
        .agg(F.coalesce(F.sum(margin), F.lit(0.0)).alias("margin_sum"), F.min(margin).alias("margin_min"),
             F.max(known).alias("_known"))
        .withColumn("_first", F.min("_known").over(whole)).withColumn("_last", F.max("_known").over(whole))
        .filter(wk.between(F.col("_first"), F.col("_last")))
        .drop("_known", "_first", "_last")
    )


def _sums(have: set[str], stems: Sequence[str]) -> list[str]:
    return [f"{s}_sum_w" for s in stems if f"{s}_sum_w" in have]


def add_margins(df: DataFrame, keys: Sequence[str], time: str = "data",
                margin_sum: str | None = None, margin_min: str | None = None) -> DataFrame:
    """Append the derived weekly columns that the available inputs allow.

    ``margin_sum`` and ``margin_min`` name weekly aggregates of the daily
    margin; where they are null (or not given) the weekly totals stand in.
    """
    have = set(df.columns)
    any_of = lambda stems: [c for c in df.columns if any(c.startswith(f"{s}_") for s in stems)]
    out = df
    totals = {}
    for name, stems in (("geracao_total", GENERATION), ("import_total", ("import_mwh",)),
                        ("export_total", ("export_mwh",))):
        if any_of(stems):
            totals[name] = f"{name}_mwh_sum_w"
            out = out.withColumn(totals[name], row_sum(_sums(have, stems)))
    has_margin = len(totals) == 3
    if has_margin:
        gen, imp, exp = (F.col(totals[n]) for n in ("geracao_total", "import_total", "export_total"))
        spare = gen + imp - exp
        out = out.withColumn("margem_suprimento_w", F.coalesce(F.col(margin_sum), spare) if margin_sum else spare)
        out = out.withColumns({
            "margem_suprimento_min_w": F.coalesce(F.col(margin_min), F.col("margem_suprimento_w"))
            if margin_min else F.col("margem_suprimento_w"),
            "saldo_importador_mwh_sum_w": imp - exp,
        })
    load = "carga_mwh_sum_w"
    known = has_margin and load in have
    unknown = F.lit(None).cast("double")
    out = out.withColumn("margem_vs_carga_w", F.col("margem_suprimento_w") - F.col(load) if known else unknown)
    out = out.withColumn("ens_week_mwh", clip_low(-F.col("margem_vs_carga_w")))
    out = out.withColumns({
        "reserve_margin_ratio_w": safe_ratio("margem_vs_carga_w", load) if known else unknown,
        "ens_week_ratio": safe_ratio("ens_week_mwh", load) if known else unknown,
        "lolp_52w": negative_share("margem_vs_carga_w", keys, time, 52, 12),
    })
    cut, ren = _sums(have, CURTAILED), _sums(have, RENEWABLE)
    if cut:
        out = out.withColumn("corte_renovavel_mwh_sum_w", row_sum(cut))
    if ren:
        out = out.withColumn("ger_renovavel_mwh_sum_w", row_sum(ren))
    if cut and ren:
        out = out.withColumn("ratio_corte_renovavel_w", curtailment_ratio(
            F.col("corte_renovavel_mwh_sum_w"), F.col("ger_renovavel_mwh_sum_w")))
    helper = [c for c in (margin_sum, margin_min) if c]
    return out.drop(*helper) if helper else out


def curtailment_ratio(curtailed: Column, generated: Column) -> Column:
    """curtailed / (curtailed + generated), null where both are 0."""
    return safe_ratio(curtailed, curtailed + generated)


# Documented indicators of the raw feeds.

def net_import(inflow, outflow) -> Column:
    return row_sum([inflow]) - row_sum([outflow])


def stored_energy_mwh(mw_month, day) -> Column:
    """Energy in MWh of a stock given in MW-months."""
    mw_month = F.col(mw_month) if isinstance(mw_month, str) else mw_month
    day = F.col(day) if isinstance(day, str) else day
    return mw_month * 24 * F.dayofmonth(F.last_day(day))


def days_of_supply(stock_mwh, daily_demand_mwh) -> Column:
    return safe_ratio(stock_mwh, daily_demand_mwh)
