"""Settings of the weekly store, the label rules and the models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class FeatureSettings:
    """Weekly feature store. ``None`` for a ratio switches that pruning off."""

    daily_aggs: tuple[str, ...] = ("mean", "sum", "max", "min", "std", "p95", "p05")
    lags: tuple[int, ...] = (1, 2, 4)
    rolls: tuple[int, ...] = (2, 4)
    min_daily_coverage: float | None = 0.80
    min_weekly_coverage: float | None = 0.80


@dataclass(frozen=True)
class LabelRules:
    """Quantile labels and the rules applied on top of them."""

    margin_col: str = "margem_vs_carga_w"
    q_low: float = 0.05
    q_mid: float = 0.20
    curtail_on: bool = True
    curtail_ratio: float = 0.05
    curtail_only_mid: bool = False
    curtail_needs_no_import: bool = True
    hydro_on: bool = True
    ear_col: str | None = "ear_pct_mean_w"
    ear_q: float = 0.2
    ena_col: str | None = "ena_mwmed_mean_w"
    ena_q: float = 0.2
    ena_run: int = 2
    hard_on: bool = True
    reserve_frac: float | None = 0.05
    ens_ratio: float | None = 0.05
    lolp: float | None = 0.05


@dataclass(frozen=True)
class SelectionSettings:
    keep: tuple[str, ...] = ()
    top_k: int | None = None
    min_importance: float | None = None

    def __post_init__(self):
        if self.top_k is not None and (not isinstance(self.top_k, int) or self.top_k <= 0):
            raise ValueError("top_k must be a positive integer")
        if self.min_importance is not None and not isinstance(self.min_importance, (int, float)):
            raise ValueError("min_importance must be a number")


@dataclass(frozen=True)
class TrainSettings:
    holdout_fraction: float = 0.20
    n_splits: int = 5
    oversample: bool = True
    oversample_in_cv: bool = True
    min_fraction: float = 0.33
    seed: int = 42
    train_horizon: int = 0
    eval_horizon: int = 1
    tuning_splits: int = 3


@dataclass(frozen=True)
class Settings:
    features: FeatureSettings = field(default_factory=FeatureSettings)
    labels: LabelRules = field(default_factory=LabelRules)
    training: TrainSettings = field(default_factory=TrainSettings)
    selection: SelectionSettings | None = None


def _number(value: Any) -> float | None:
    try:
        return None if value is None else float(value)
    except (TypeError, ValueError):
        return None


def settings_from(raw: Mapping[str, Any]) -> Settings:
    """Settings from a nested mapping (a parsed YAML file) with the established key names.

    Keys that are absent take the defaults the pipeline has for absent keys,
    which switch the optional rules off.
    """
    feats = raw.get("aggregation", {}).get("features", {})
    rules = raw.get("problem", {}).get("label_rules", {}) or {}
    cut = rules.get("curtail_downgrade", {}) or {}
    model = raw.get("modeling", {}) or {}
    over = model.get("oversample", {}) or {}
    chosen = model.get("feature_selection", {}) or {}
    base = FeatureSettings()
    keep = chosen.get("keep_list") or ()
    return Settings(
        features=FeatureSettings(
            daily_aggs=tuple(feats.get("daily_aggs", base.daily_aggs)),
            lags=tuple(feats.get("lags_weeks", base.lags)),
            rolls=tuple(feats.get("rolling_weeks", base.rolls)),
            min_daily_coverage=float(feats.get("min_nonnull_ratio", 0.5)),
            min_weekly_coverage=_number(feats.get("min_nonnull_ratio_weekly")),
        ),
        labels=LabelRules(
            margin_col=rules.get("coluna_margem") or rules.get("coluna_margem_semana") or "margem_suprimento_min_w",
            q_low=float(rules.get("q_baixo", 0.10)),
            q_mid=float(rules.get("q_medio", 0.40)),
            curtail_on=bool(cut.get("usar_downgrade_cortes", False)),
            curtail_ratio=float(cut.get("corte_ratio_thr", 0.05)),
            curtail_only_mid=bool(cut.get("rebaixar_apenas_de_medio_para_baixo", False)),
            curtail_needs_no_import=bool(cut.get("requer_saldo_importador_nao_positivo", False)),
            hydro_on=bool(rules.get("usar_override_hidro", False)),
            ear_col=rules.get("coluna_ear"),
            ear_q=float(rules.get("ear_q_baixo", 0.2)),
            ena_col=rules.get("coluna_ena"),
            ena_q=float(rules.get("ena_q_baixo", 0.2)),
            ena_run=max(1, int(rules.get("janelas_consecutivas_ena", 1))),
            hard_on=bool(rules.get("usar_regras_duras", False)),
            reserve_frac=_number(rules.get("reserva_operativa_frac")),
            ens_ratio=_number(rules.get("ens_ratio_thr")),
            lolp=_number(rules.get("lolp_thr")),
        ),
        training=TrainSettings(
            holdout_fraction=float(model.get("holdout_fraction", 0.2)),
            n_splits=int((model.get("cv") or {}).get("n_splits", 5)),
            oversample=bool(over.get("use", False)),
            oversample_in_cv=bool(over.get("in_cv", True)),
            min_fraction=float(over.get("min_fraction", 0.25)),
            seed=int(over.get("random_state", 42)),
            eval_horizon=int(raw.get("problem", {}).get("forecast_horizon_weeks", 1)),
        ),
        selection=SelectionSettings(
            keep=(keep,) if isinstance(keep, str) else tuple(keep),
            top_k=chosen.get("keep_top_k"),
            min_importance=chosen.get("min_importance"),
        ) if chosen.get("use") else None,
    )
