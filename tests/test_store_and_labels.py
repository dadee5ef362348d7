"""Weekly store, margins, labels, metrics and sampling on small tables."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import as_dict
from weekloom.config import FeatureSettings, LabelRules, SelectionSettings, settings_from
from weekloom.operators import coverage, labels, margins, metrics, sampling, selection
from weekloom.plans import marts, weekly

K = ["series_key"]
RULES = LabelRules(ear_col="ear", ena_col="ena", margin_col="m")


def weeks(n):
    return [(dt.date(2024, 1, 7) + dt.timedelta(7 * i)).isoformat() for i in range(n)]


def week_frame(frame, **cols):
    n = len(next(iter(cols.values())))
    schema = "series_key string, data string, " + ", ".join(f"{c} double" for c in cols)
    return frame([("a", w, *[v[i] for v in cols.values()]) for i, w in enumerate(weeks(n))], schema)


def test_margins_and_ratios(frame):
    df = week_frame(
        frame, ger_eolica_mwh_sum_w=[10.0, 10.0, None], ger_fv_mwh_sum_w=[0.0, None, None], import_mwh_sum_w=[5.0, 0.0, 0.0],
        export_mwh_sum_w=[1.0, 4.0, 0.0], carga_mwh_sum_w=[20.0, 0.0, None], corte_eolica_mwh_sum_w=[10.0, None, 0.0],
        corte_fv_mwh_sum_w=[None, None, None])
    rows = margins.add_margins(df, K).orderBy("data").collect()
    a, b, c = rows
    assert (a["geracao_total_mwh_sum_w"], a["margem_suprimento_w"], a["margem_vs_carga_w"]) == (10.0, 14.0, -6.0)
    assert (a["ens_week_mwh"], a["ens_week_ratio"], a["reserve_margin_ratio_w"]) == (6.0, 0.3, -0.3)
    assert a["ratio_corte_renovavel_w"] == 0.5 and a["saldo_importador_mwh_sum_w"] == 4.0
    assert b["margem_vs_carga_w"] == 6.0 and b["ens_week_mwh"] == 0.0 and b["reserve_margin_ratio_w"] is None
    assert c["margem_vs_carga_w"] is None and c["ens_week_mwh"] is None and c["ratio_corte_renovavel_w"] is None
    assert all(r["ens_week_mwh"] is None or r["ens_week_mwh"] * r["margem_vs_carga_w"] <= 0 for r in rows)


def test_margins_without_load(frame):
    df = week_frame(frame, ger_fv_mwh_sum_w=[1.0] * 12, import_mwh_sum_w=[0.0] * 12, export_mwh_sum_w=[2.0] * 12)
    last = margins.add_margins(df, K).orderBy(F.desc("data")).first()
    assert last["margem_suprimento_w"] == -1.0 and last["margem_vs_carga_w"] is None
    assert last["ens_week_ratio"] is None and last["lolp_52w"] == 0.0


def daily(frame, values, start="2024-01-01", names=("carga_mwh",)):
    first = dt.date.fromisoformat(start)
    rows = [("a", (first + dt.timedelta(i)).isoformat(), *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    return frame(rows, "series_key string, data string, " + ", ".join(f"{n} double" for n in names))


OPEN = FeatureSettings(("mean", "sum"), (1,), (2,), None, None)


def test_store_aligns_sources_with_different_ranges(frame):
    sources = {
        "carga": daily(frame, [1.0] * 21),
        "intercambio": daily(frame, [(3.0, 1.0)] * 7, "2024-01-08", ("import_mwh", "export_mwh")),
        "ger_fontes": daily(frame, [(2.0,)] * 14, "2024-01-01", ("ger_fv_mwh",)),
    }
    rows = weekly.build_features(sources, OPEN).orderBy("data").collect()
    assert [r["data"].isoformat() for r in rows] == ["2024-01-07", "2024-01-14", "2024-01-21"]
    assert [r["carga_mwh_sum_w"] for r in rows] == [7.0, 7.0, 7.0]
    # Outside its range a source has no sum; the final fill carries the last one on.
    assert [r["import_mwh_sum_w"] for r in rows] == [None, 21.0, 21.0]
    # Unknown imports count as nothing, and after the last known day the weekly totals (0) stand in.
    assert [r["margem_suprimento_w"] for r in rows] == [14.0, 28.0, 0.0]
    assert rows[2]["ger_fv_mwh_sum_w_lag1w"] == 14.0
    assert rows[1]["carga_mwh_sum_w_r2w_mean"] == 7.0 and rows[1]["carga_mwh_sum_w_r2w_std"] == 0.0


def test_store_sums_all_null_weeks_to_zero(frame):
    values = [5.0] * 7 + [None] * 14 + [5.0] * 7
    rows = weekly.build_features({"carga": daily(frame, values)}, OPEN).orderBy("data").collect()
    # Seven days are filled forward, the second empty week is beyond the fill.
    assert [r["carga_mwh_sum_w"] for r in rows] == [35.0, 35.0, 0.0, 35.0]


def test_rain_sums_match_plain_windows(frame):
    values = [(float(i % 5), None if i % 4 == 0 else float(i % 7)) for i in range(40)]
    df = daily(frame, values, names=("ghi", "precipitacao_mm"))
    long = weekly.filled_daily(weekly.long_daily({"clima": df}))
    got = as_dict(long.filter("variable like 'precip_%'"), "variable", "data")
    wide = weekly.rain_sums(weekly.continuous_daily(df, K, "data", ["precipitacao_mm"]))
    for r in wide.collect():
        for n in weekly.RAIN_DAYS:
            assert got[f"precip_{n}d_mm", r["data"].isoformat()]["value"] == r[f"precip_{n}d_mm"]


def test_coverage_limits_drop_columns(frame):
    sparse = [1.0] + [None] * 60 + [1.0]
    settings = dataclasses.replace(OPEN, min_daily_coverage=0.8, min_weekly_coverage=0.8)
    sources = {"carga": daily(frame, [1.0] * 62), "ena": daily(frame, sparse, names=("ena_mwmed",))}
    with pytest.warns(UserWarning, match="ena_mwmed"):
        cols = weekly.build_features(sources, settings).columns
    assert "carga_mwh_mean_w" in cols and not any(c.startswith("ena") for c in cols)
    assert "margem_vs_carga_w" not in cols
    df = daily(frame, [1.0, None], names=("v",))
    assert coverage.covered_columns(df, ["v", "absent"], 0.5) == ["v"]
    assert coverage.covered_columns(df, ["v"], 0.6) == []
    assert weekly.build_features({"carga": daily(frame, [1.0])}, OPEN).count() == 1


def thresholds(spark, t_low=1.0, t_med=3.0, ear=10.0, ena=5.0):
    return spark.sql(f"""select 'a' series_key, {t_low}D t_low, {t_med}D t_med, 'm' col, .05D q_baixo, .2D q_medio,
        named_struct('janelas_consecutivas_ena', 2, 'ear_threshold', {ear}D, 'ena_threshold', {ena}D) hydro""")


def test_label_bounds_are_inclusive(spark, frame):
    df = week_frame(frame, m=[1.0, 1.1, 3.0, 3.1, None])
    out = labels.label_weeks(df, thresholds(spark), K, "data", dataclasses.replace(RULES, hydro_on=False))
    assert [r["classe_risco"] for r in out.orderBy("data").collect()] == ["alto", "medio", "medio", "baixo", None]


def test_curtailment_lowers_one_class(spark, frame):
    df = week_frame(frame, m=[1.0, 2.0, 9.0, 1.0, 1.0, None], ratio_corte_renovavel_w=[0.05, 0.2, 0.2, 0.049, 0.2, 0.2],
                    saldo_importador_mwh_sum_w=[0.0, -1.0, 0.0, 0.0, 1.0, 0.0])
    rules = dataclasses.replace(RULES, hydro_on=False)
    codes = lambda r: [x["code_cut"] for x in labels.label_steps(df, thresholds(spark), K, "data", r).orderBy("data").collect()]
    assert codes(rules) == [1, 0, 0, 2, 2, None]
    assert codes(dataclasses.replace(rules, curtail_only_mid=True)) == [2, 0, 0, 2, 2, None]
    assert codes(dataclasses.replace(rules, curtail_needs_no_import=False)) == [1, 0, 0, 2, 1, None]
    bare = labels.label_steps(df.drop("saldo_importador_mwh_sum_w"), thresholds(spark), K, "data", rules)
    assert not bare.filter("cut_hit").count()


def test_hydrology_forces_high_after_a_run(spark, frame):
    df = week_frame(frame, m=[9.0, 9.0, 9.0, 9.0, 9.0, None], ear=[50.0, 50.0, 50.0, 50.0, 10.0, 1.0], ena=[5.0, None, 5.0, 4.0, 9.0, 1.0])
    out = labels.label_weeks(df, thresholds(spark), K, "data", dataclasses.replace(RULES, curtail_on=False))
    assert [r["classe_risco"] for r in out.orderBy("data").collect()] == ["baixo", "baixo", "baixo", "alto", "alto", None]


def test_hard_rules(spark, frame):
    df = week_frame(frame, m=[9.0, 9.0, 9.0, 9.0, None], reserve_margin_ratio_w=[0.05, 0.04, 1.0, 1.0, 0.0],
                    ens_week_ratio=[0.0, 0.0, 0.05, 0.0, 0.0], lolp_52w=[0.0, None, 0.0, 0.05, 0.0])
    out = labels.label_audit(df, thresholds(spark), K, "data", RULES).orderBy("data").collect()
    assert [r["hard_rules"] for r in out] == [False, True, True, True, False]
    assert [r["label_final_calc"] for r in out] == ["baixo"] * 4 + [None]
    pred = df.withColumn("p", F.when(F.col("m").isNotNull(), "baixo"))
    got = [r["p"] for r in labels.relabel_with_hard_rules(pred, "p", RULES).orderBy("data").collect()]
    assert got == ["baixo", "alto", "alto", "alto", None]


def test_thresholds(frame):
    df = week_frame(frame, m=[1.0, 2.0, 3.0, 4.0, 5.0], ear=[5.0, 4.0, 3.0, 2.0, 1.0])
    row = labels.label_thresholds(df, K, dataclasses.replace(RULES, q_low=0.25, q_mid=0.6)).first()
    assert (row["t_low"], row["t_med"]) == (2.0, pytest.approx(3.4))
    assert row["hydro"]["ear_threshold"] == pytest.approx(1.8) and row["hydro"]["ena_threshold"] is None
    swapped = labels.label_thresholds(df, K, dataclasses.replace(RULES, q_low=0.6, q_mid=0.25)).first()
    assert swapped["t_low"] < swapped["t_med"]
    with pytest.raises(KeyError):
        labels.label_thresholds(df, K, LabelRules(margin_col="absent"))
    empty = labels.label_thresholds(week_frame(frame, m=[None, None]), K, RULES)
    with pytest.raises(ValueError):
        labels.check_thresholds(empty)


def test_metrics_by_hand(spark):
    rows = [("baixo", "baixo")] * 3 + [("baixo", "medio")] + [("medio", "medio")] * 2 + [("medio", "baixo")] * 2
    df = spark.createDataFrame(rows, "t string, p string")
    matrix = as_dict(metrics.confusion_matrix(df, "t", "p"), "truth")
    assert matrix["baixo"] == {"baixo": 3, "medio": 1, "alto": 0} and matrix["alto"] == {"baixo": 0, "medio": 0, "alto": 0}
    s = metrics.macro_scores(df, "t", "p").first()
    # Only the two classes that occur count.
    assert s["f1_macro"] == pytest.approx((6 / 9 + 4 / 7) / 2) and s["balanced_acc"] == pytest.approx((0.75 + 0.5) / 2)
    report = as_dict(metrics.class_report(df, "t", "p"), "row")
    assert report["macro avg"]["f1"] == pytest.approx((6 / 9 + 4 / 7) / 3) and report["accuracy"]["f1"] == pytest.approx(5 / 8)
    dist = as_dict(metrics.class_distribution(df, "t"), "label")
    assert dist["alto"] == {"count": 0, "percent": 0.0} and dist["medio"]["percent"] == 50.0
    weights = as_dict(metrics.class_weights(df, "t"), "t")
    assert weights["baixo"]["weight"] == 1.0


def test_oversampling(spark):
    rows = [(i, "baixo") for i in range(80)] + [(100 + i, "medio") for i in range(15)] + [(200 + i, "alto") for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, y string")
    out = sampling.oversample_minority(df, "y", ["id"], 0.33, seed=7)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    # Class after class: 27 more for medio on 100 rows, then 56 more for alto on 127.
    assert counts == {"baixo": 80, "medio": 42, "alto": 61}
    assert out.filter("copy_no = 0").count() == 100
    per_row = [r["count"] for r in out.filter("y = 'alto'").groupBy("id").count().collect()]
    assert max(per_row) - min(per_row) <= 1
    again = sampling.oversample_minority(df.repartition(7), "y", ["id"], 0.33, seed=7)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))
    assert sampling.oversample_minority(df, "y", ["id"], 1.0).count() == 100


def test_draws_with_replacement(spark):
    rows = [(i, "baixo" if i < 30000 else "alto" if i < 39000 else "medio") for i in range(49000)]
    df = spark.createDataFrame(rows, "id bigint, y string")
    out = sampling.oversample_minority(df, "y", ["id"], 0.4, seed=3, replacement=True)
    counts = {"baixo": 30000, "medio": 10000, "alto": 9000}
    extra = sampling.extra_draws(counts, 0.4)
    per_row = {(r["y"], r["id"]): r["count"] - 1 for r in out.groupBy("y", "id").count().collect()}
    assert len(per_row) == 49000
    for c, k in extra.items():
        drawn = [n for (y, _), n in per_row.items() if y == c]
        assert sum(drawn) == k and min(drawn) == 0
        # Chi-square of equal chances: n - 1 degrees of freedom, five standard deviations.
        each = k / len(drawn)
        assert abs(sum((n - each) ** 2 for n in drawn) / each - (len(drawn) - 1)) < 5 * (2 * len(drawn)) ** 0.5
    again = sampling.oversample_minority(df.repartition(7), "y", ["id"], 0.4, seed=3, replacement=True)
    assert {(r["y"], r["id"]): r["count"] - 1 for r in again.groupBy("y", "id").count().collect()} == per_row
    other = sampling.oversample_minority(df, "y", ["id"], 0.4, seed=4, replacement=True)
    assert {(r["y"], r["id"]): r["count"] - 1 for r in other.groupBy("y", "id").count().collect()} != per_row


def test_selection(spark):
    imp = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.1), ("gone", 0.9)], "feature string, importance double")
    avail = ["a", "b", "c", "d"]
    assert selection.selected_columns(imp, SelectionSettings(keep=("d", "c"), top_k=2), avail) == ["c", "d", "a"]
    assert selection.selected_columns(imp, SelectionSettings(min_importance=0.3), avail) == ["a", "b"]
    assert selection.selected_columns(imp, SelectionSettings(), avail) == ["a", "b", "c"]
    assert selection.selected_columns(imp, None, avail) is None
    with pytest.warns(UserWarning):
        assert selection.selected_columns(None, SelectionSettings(top_k=2), avail) is None
    with pytest.warns(UserWarning), pytest.raises(ValueError):
        selection.selected_columns(None, SelectionSettings(keep=("zz",)), avail)
    with pytest.raises(ValueError):
        SelectionSettings(top_k=0)


def test_settings_from_mapping():
    s = settings_from({
        "problem": {"label_rules": {"coluna_margem": "margem_vs_carga_w", "q_baixo": 0.05, "usar_regras_duras": True, "ens_ratio_thr": "x",
                                    "curtail_downgrade": {"usar_downgrade_cortes": True}}},
        "modeling": {"feature_selection": {"use": True, "keep_list": "a", "keep_top_k": 3}, "oversample": {"use": True}},
        "aggregation": {"features": {"lags_weeks": [1], "min_nonnull_ratio": 0.8}}})
    assert s.labels.q_low == 0.05 and s.labels.q_mid == 0.4 and s.labels.curtail_on and not s.labels.hydro_on
    assert s.labels.ens_ratio is None and s.features.lags == (1,) and s.features.min_weekly_coverage is None
    assert s.selection == SelectionSettings(("a",), 3, None) and s.training.oversample


def test_fact_and_calendar(spark, frame):
    cols = marts.fact_columns()
    assert len(cols) == 61 and cols["ghi_std_w"] == "irradiancia_desvio_padrao" and cols["carga_mwh__p95_w"] == "carga_p95_mwh"
    cal = as_dict(marts.dim_calendar(frame([("2023-12-30",), ("2024-03-01",)], "data string")), "data")
    assert len(cal) == 63
    assert cal["2024-03-01"] == {"dia_do_mes": 1, "nome_mes_pt": "Março", "numero_mes": 3, "ano": 2024, "trimestre": 1, "semestre": 1,
                                 "quadrimestre": 1, "primeiro_dia_mes": "2024-03-01"}
    view = marts.publish(frame([("2024-01-01",)], "data string"), "weekloom_test_days")
    assert marts.table_scan(spark, "weekloom_test_days").count() == view.count() == 1
