"""Risk labels: quantile thresholds, label rules and the label audit.

Thresholds are a small table with one row per series key and are joined on the
key, so all series are labelled in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.config import LabelRules
from weekloom.functions.scalars import decode_label
from weekloom.operators.windows import run_of

HIGH, MID, LOW = 2, 1, 0
RATIO, BALANCE = "ratio_corte_renovavel_w", "saldo_importador_mwh_sum_w"


def label_thresholds(ref: DataFrame, keys: Sequence[str], rules: LabelRules) -> DataFrame:
    """One row per key: margin and hydrology quantiles of the reference weeks.

    A key's weeks are bounded by the calendar, so the exact percentile is too.
    """
    if rules.margin_col not in ref.columns:
        raise KeyError(f"margin column {rules.margin_col!r} is not in the features")
    def quantile(col: str, q: float) -> Column:
        return F.percentile(F.col(col).cast("double"), F.lit(q))

    aggs = [quantile(rules.margin_col, rules.q_low).alias("_a"), quantile(rules.margin_col, rules.q_mid).alias("_b")]
    for name, col, q in (("ear_threshold", rules.ear_col, rules.ear_q), ("ena_threshold", rules.ena_col, rules.ena_q)):
        usable = rules.hydro_on and col and col in ref.columns
        aggs.append((quantile(col, q) if usable else F.first(F.lit(None).cast("double"))).alias(name))
    hydro = F.struct(
        F.lit(rules.hydro_on).alias("usar_override_hidro"),
        F.lit(rules.ena_run).alias("janelas_consecutivas_ena"),
        F.lit(rules.ear_col).cast("string").alias("ear_col"), F.lit(float(rules.ear_q)).alias("ear_q_baixo"),
        "ear_threshold",
        F.lit(rules.ena_col).cast("string").alias("ena_col"), F.lit(float(rules.ena_q)).alias("ena_q_baixo"),
        "ena_threshold",
    )
    return ref.groupBy(*keys).agg(*aggs).select(
        *keys,
        F.least("_a", "_b").alias("t_low"), F.greatest("_a", "_b").alias("t_med"),
        F.lit(rules.margin_col).alias("col"),
        F.lit(float(rules.q_low)).alias("q_baixo"), F.lit(float(rules.q_mid)).alias("q_medio"),
        hydro.alias("hydro"),
    )


def check_thresholds(thresholds: DataFrame) -> None:
    """Raise where a key had no margin value to take quantiles from."""
    if not thresholds.filter(F.col("t_low").isNull()).isEmpty():
        raise ValueError("a series has no margin values; quantiles cannot be computed")


def base_code(margin, t_low, t_med) -> Column:
    margin = F.col(margin) if isinstance(margin, str) else margin
    return F.when(margin <= t_low, HIGH).when(margin <= t_med, MID).when(margin > t_med, LOW)


def curtail_mask(code: Column, columns: Sequence[str], rules: LabelRules) -> Column:
    """Where curtailment lowers the risk class."""
    if not rules.curtail_on or RATIO not in columns:
        return F.lit(False)
    if rules.curtail_needs_no_import and BALANCE not in columns:
        return F.lit(False)
    hit = F.col(RATIO) >= rules.curtail_ratio
    if rules.curtail_needs_no_import:
        hit = hit & (F.col(BALANCE) <= 0)
    if rules.curtail_only_mid:
        hit = hit & (code == MID)
    return F.coalesce(hit & code.isNotNull(), F.lit(False))


def hydro_mask(columns: Sequence[str], keys: Sequence[str], time: str, rules: LabelRules) -> Column:
    """Where low storage, or a run of low inflow, forces the high class."""
    hit = F.lit(False)
    if not rules.hydro_on:
        return hit
    if rules.ear_col and rules.ear_col in columns:
        hit = hit | F.coalesce(F.col(rules.ear_col) <= F.col("hydro.ear_threshold"), F.lit(False))
    if rules.ena_col and rules.ena_col in columns:
        hit = hit | run_of(F.col(rules.ena_col) <= F.col("hydro.ena_threshold"), keys, time, rules.ena_run)
    return hit


def hard_mask(columns: Sequence[str], rules: LabelRules) -> Column:
    """Where reserve, unserved energy or loss-of-load limits force the high class."""
    hit = F.lit(False)
    if not rules.hard_on:
        return hit
    if rules.reserve_frac is not None and "reserve_margin_ratio_w" in columns:
        hit = hit | F.coalesce(F.col("reserve_margin_ratio_w") < rules.reserve_frac, F.lit(False))
    if rules.ens_ratio is not None and "ens_week_ratio" in columns:
        hit = hit | F.coalesce(F.col("ens_week_ratio") >= rules.ens_ratio, F.lit(False))
    if rules.lolp is not None and "lolp_52w" in columns:
        hit = hit | F.coalesce(F.col("lolp_52w") >= rules.lolp, F.lit(False))
    return hit


def lower_one(code: Column, mask: Column) -> Column:
    return F.when(mask, F.greatest(code - 1, F.lit(LOW))).otherwise(code)


def raise_to_high(code: Column, mask: Column) -> Column:
    """Force the high class where the mask holds and there is a label at all."""
    return F.when(mask & code.isNotNull(), HIGH).otherwise(code)


def label_steps(store: DataFrame, thresholds: DataFrame, keys: Sequence[str], time: str, rules: LabelRules,
                window_keys: Sequence[str] | None = None, hard_in_label: bool = False) -> DataFrame:
    """The store with the label code after every rule, and the rule flags.

    ``window_keys`` adds columns (a fold, a split) at which runs of low inflow
    restart; by default they run over the whole series.
    """
    cols = store.columns
    scope = list(window_keys or keys)
    # One threshold row per key: Spark broadcasts it while it is small.
    step = store.join(thresholds, list(keys), "left")
    step = step.withColumns({
        "code_base": base_code(F.col(rules.margin_col), F.col("t_low"), F.col("t_med")),
        "hydro_hit": hydro_mask(cols, scope, time, rules),
        "hard_hit": hard_mask(cols, rules),
    })
    step = step.withColumn("cut_hit", curtail_mask(F.col("code_base"), cols, rules))
    step = step.withColumn("code_cut", lower_one(F.col("code_base"), F.col("cut_hit")))
    step = step.withColumn("code_final", raise_to_high(F.col("code_cut"), F.col("hydro_hit")))
    if hard_in_label:
        step = step.withColumn("code_final", raise_to_high(F.col("code_final"), F.col("hard_hit")))
    return step.withColumn("code_hard", raise_to_high(F.col("code_base"), F.col("hard_hit")))


_STEP_COLS = ("t_low", "t_med", "col", "q_baixo", "q_medio", "hydro", "code_base", "hydro_hit", "hard_hit",
              "cut_hit", "code_cut", "code_hard")


def label_weeks(store: DataFrame, thresholds: DataFrame, keys: Sequence[str], time: str, rules: LabelRules,
                out: str = "classe_risco", **options) -> DataFrame:
    """The store with its final label as text."""
    steps = label_steps(store, thresholds, keys, time, rules, **options)
    return steps.withColumn(out, decode_label("code_final")).drop(*_STEP_COLS, "code_final")


def relabel_with_hard_rules(predicted: DataFrame, label: str, rules: LabelRules) -> DataFrame:
    """Predictions raised to the high class where a hard limit is broken on the same row."""
    forced = hard_mask(predicted.columns, rules) & F.col(label).isNotNull()
    return predicted.withColumn(label, F.when(forced, F.lit("alto")).otherwise(F.col(label)))


AUDIT_FEATURES = (
    "margem_vs_carga_w", "margem_suprimento_w", "margem_suprimento_min_w", "ratio_corte_renovavel_w",
    "reserve_margin_ratio_w", "ens_week_ratio", "lolp_52w", "ear_pct_mean_w", "ena_mwmed_mean_w",
)


def label_audit(store: DataFrame, thresholds: DataFrame, keys: Sequence[str], time: str, rules: LabelRules,
                final_labels: DataFrame | None = None, final_col: str = "classe_risco") -> DataFrame:
    """Labels per stage, rule flags, thresholds and the features behind them.

    ``final_labels`` (keys, time, label) are the labels in use; without it the
    labels are the ones computed here.
    """
    steps = label_steps(store, thresholds, keys, time, rules)
    in_use = decode_label("code_final")
    if final_labels is not None:
        used = final_labels.select(*keys, time, F.col(final_col).alias("_in_use"))
        steps, in_use = steps.join(used, [*keys, time], "left"), F.col("_in_use")
    def changed(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) != F.col(b), F.lit(False))

    fixed = {
        "thr_corte_ratio": rules.curtail_ratio, "thr_corte_requires_import": rules.curtail_needs_no_import,
        "thr_corte_only_medium": rules.curtail_only_mid, "rule_reserva_operativa_frac": rules.reserve_frac,
        "rule_ens_ratio_thr": rules.ens_ratio, "rule_lolp_thr": rules.lolp,
    }
    return steps.select(
        *keys, time,
        decode_label("code_base").alias("label_sem_regras"),
        decode_label("code_cut").alias("label_pos_cortes"),
        decode_label("code_final").alias("label_final_calc"),
        in_use.alias("label_pipeline"),
        F.col("cut_hit").alias("downgrade_cortes"),
        changed("code_cut", "code_final").alias("override_hidro"),
        changed("code_base", "code_hard").alias("hard_rules"),
        F.col("col").alias("thr_margin_col"), F.col("t_low").alias("thr_t_low"), F.col("t_med").alias("thr_t_med"),
        F.col("q_baixo").alias("thr_q_baixo"), F.col("q_medio").alias("thr_q_medio"),
        F.col("hydro.ear_threshold").alias("thr_ear_threshold"),
        F.col("hydro.ena_threshold").alias("thr_ena_threshold"),
        F.col("hydro.janelas_consecutivas_ena").alias("thr_ena_janelas"),
        *[F.lit(v).alias(name) for name, v in fixed.items()],
        *[F.col(c).cast("double").alias(c) for c in AUDIT_FEATURES if c in store.columns],
    )
