"""Calendar, cadence changes, windows and exact ordered operators on small tables."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window

from conftest import as_dict
from weekloom.functions import dates, scalars
from weekloom.operators import align, energy, hot, resample, windows

K = ["series_key"]


def days(start, n):
    first = dt.date.fromisoformat(start)
    return [(first + dt.timedelta(d)).isoformat() for d in range(n)]


def test_week_ends_on_sunday(frame):
    df = frame([(d,) for d in ("2023-12-31", "2024-01-01", "2024-01-07", "2024-01-08")], "data string")
    got = [r[0].isoformat() for r in df.select(dates.week_end("data")).collect()]
    assert got == ["2023-12-31", "2024-01-07", "2024-01-07", "2024-01-14"]


def test_fill_stops_after_seven_days(frame):
    df = frame([("a", "2024-01-01", 1.0), ("a", "2024-01-10", 2.0), ("b", "2024-01-03", 5.0)], "series_key string, data string, v double")
    out = as_dict(windows.forward_fill(windows.densify(df, K, "data"), K, "data", ["v"], 7), "series_key", "data")
    assert len(out) == 11
    assert out["a", "2024-01-08"]["v"] == 1.0
    assert out["a", "2024-01-09"]["v"] is None
    assert out["a", "2024-01-10"]["v"] == 2.0
    assert ("b", "2024-01-04") not in out


def test_daily_sum_is_null_without_values(frame):
    df = frame([("a", "2024-01-01", None), ("a", "2024-01-01", None), ("a", "2024-01-03", 2.0), ("a", "2024-01-03", 3.0)],
               "series_key string, data string, v double")
    out = as_dict(resample.daily_sum(df, K, "data", ["v"]), "data")
    assert [out[d]["v"] for d in days("2024-01-01", 3)] == [None, None, 5.0]
    half = as_dict(resample.daily_sum(df, K, "data", ["v"], step_hours=0.5), "data")
    assert half["2024-01-03"]["v"] == 2.5


def test_week_of_nulls_has_sum_zero_and_no_mean(frame):
    rows = [("a", d, None) for d in days("2024-01-01", 7)] + [("a", "2024-01-08", 4.0)]
    out = as_dict(resample.weekly_aggregate(frame(rows, "series_key string, data string, v double"), K, "data", ["v"]), "data")
    assert out["2024-01-07"]["v_sum_w"] == 0.0 and out["2024-01-07"]["v_mean_w"] is None
    assert out["2024-01-14"]["v_std_w"] is None and out["2024-01-14"]["v__p95_w"] == 4.0
    with pytest.raises(ValueError):
        resample.weekly_aggregate(frame(rows, "series_key string, data string, v double"), K, "data", ["v"], ["mode"])


def test_month_spread_keeps_the_total(frame):
    df = frame([("a", "2024-02-10", 29.0), ("a", "2024-02-20", 58.0), ("a", "2024-03-01", None)], "series_key string, data string, v double")
    out = resample.spread_month(df, K, "data", "v")
    by_day = as_dict(out, "data")
    assert len(by_day) == 29 + 31
    assert by_day["2024-02-29"]["v"] == pytest.approx(3.0) and by_day["2024-03-15"]["v"] == 0.0
    assert out.agg(F.sum("v")).first()[0] == pytest.approx(87.0)


def test_shortfall_energy_of_a_month(frame):
    df = frame([("a", "2024-02-01", 5.0, 3.0), ("a", "2024-02-02", 1.0, 3.0), ("a", "2024-02-03", None, 3.0)],
               "series_key string, data string, est double, ver double")
    row = resample.shortfall_month_energy(df, K, "data", "est", "ver", "e").first()
    assert row["e"] == 2.0 * 24 * 29


def test_flows_count_both_ends(frame):
    df = frame([("a", "b", "2024-01-01", 2.0), ("a", "a", "2024-01-02", 3.0), ("b", "a", "2024-01-04", 5.0)],
               "o string, d string, data string, v double")
    out = as_dict(align.flows_by_key(df, "o", "d", "data", "v"), "series_key", "data")
    assert out["a", "2024-01-02"] == {"import_mwh": 3.0, "export_mwh": 3.0}
    assert out["a", "2024-01-03"] == {"import_mwh": 0.0, "export_mwh": 0.0}
    assert out["a", "2024-01-04"] == {"import_mwh": 5.0, "export_mwh": 0.0}
    total_in = sum(v["import_mwh"] for v in out.values())
    assert total_in == sum(v["export_mwh"] for v in out.values()) == 10.0
    # b imports only on the first day and exports only on the last: the days between belong to neither.
    assert ("b", "2024-01-02") not in out


def test_outer_align_and_union(frame):
    a = frame([("k", "2024-01-01", 1.0)], "series_key string, data string, x double")
    b = frame([("k", "2024-01-02", 2.0)], "series_key string, data string, y double")
    out = as_dict(align.outer_align([a, b], ["series_key", "data"]), "data")
    assert out["2024-01-01"] == {"series_key": "k", "x": 1.0, "y": None}
    assert align.union_keys([a, b], ["series_key", "data"]).count() == 2
    with pytest.raises(ValueError):
        align.union_all([])


def energy_rows(spark, rows):
    df = spark.createDataFrame(rows, "plant string, ts string, row bigint, ref double, lim double")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def test_energy_per_plant(spark):
    rows = [("p", "2024-01-01 00:00:00", 1, 10.0, 4.0), ("p", "2024-01-01 01:00:00", 2, 10.0, 12.0), ("p", "2024-01-01 02:00:00", 3, None, 1.0),
            ("p", "2024-01-01 03:00:00", 4, 9.0, 4.0), ("q", "2024-01-01 00:00:00", 5, 3.0, 1.0), ("q", "2024-01-01 00:00:00", 6, 8.0, 1.0)]
    out = as_dict(energy.integrate_energy(energy_rows(spark, rows), ["plant"], "ts", energy.curtailed_power("ref", "lim"), "row", "e"), "plant")
    # p: 6 MW for an hour, then nothing, then 5 MW for its usual hour. q: the later row, for half an hour.
    assert out["p"]["e"] == pytest.approx(6.0 + 5.0)
    assert out["q"]["e"] == pytest.approx(7.0 * 0.5)
    with pytest.raises(ValueError):
        energy.curtailed_power("ref", "lim", method="other")


def test_cadence_needs_ten_rows(spark):
    rows = [("p", f"2024-01-01 {h:02d}:00:00", h, 1.0, 1.0) for h in range(10)] + [("q", f"2024-01-01 {h:02d}:00:00", h, 1.0, 1.0) for h in range(9)]
    out = as_dict(energy.cadence(energy_rows(spark, rows), ["plant"], "ts"), "plant")
    assert out["p"]["is_intraday"] and out["p"]["median_hours"] == 1.0
    assert not out["q"]["is_intraday"]


def test_lags_and_rolls(frame):
    df = frame([("a", d, float(v)) for d, v in zip(days("2024-01-07", 4), (1, 3, 8, 2))], "series_key string, data string, v double")
    rows = windows.add_lags_rolls(df, K, "data", ["v"], [1], [2]).orderBy("data").collect()
    assert [r["v_lag1w"] for r in rows] == [None, 1.0, 3.0, 8.0]
    assert [r["v_r2w_mean"] for r in rows] == [1.0, 2.0, 5.5, 5.0]
    assert rows[0]["v_r2w_std"] is None and rows[1]["v_r2w_std"] == pytest.approx(2 ** 0.5)


def test_negative_share_counts_null_as_not_negative(frame):
    values = [-1.0, None] * 6
    df = frame([("a", d, v) for d, v in zip(days("2024-01-01", 12), values)], "series_key string, data string, m double")
    got = [r[0] for r in df.select(windows.negative_share("m", K, "data").alias("l"), "data").orderBy("data").collect()]
    assert got[:11] == [None] * 11 and got[11] == 0.5


def test_runs_are_broken_by_null(frame):
    df = frame([("a", d, v) for d, v in zip(days("2024-01-01", 5), (1.0, None, 1.0, 1.0, 9.0))], "series_key string, data string, v double")
    got = [r[0] for r in df.select(windows.run_of(F.col("v") <= 1, K, "data", 2), "data").orderBy("data").collect()]
    assert got == [False, False, False, True, False]


@pytest.mark.parametrize("n,splits", [(20, 5), (23, 3), (7, 5)])
def test_folds_match_their_definition(frame, n, splits):
    every = days("2024-01-01", n)
    df = frame([("a", d) for d in every] + [("b", d) for d in every[n // 2:]], "series_key string, data string")
    rows = windows.expanding_folds(df, "data", splits).filter("series_key = 'a'").orderBy("data").collect()
    size = n // (splits + 1)
    want = [0] * n
    for f in range(1, splits + 1):
        start = n - (splits - f + 1) * size
        for i in range(start, start + size):
            want[i] = f
    assert [r["fold"] for r in rows] == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 40)), min_size=1, max_size=4), st.integers(1, 4))
def test_training_is_never_later_than_the_test(frame, spans, splits):
    rows = [(f"s{k}", d) for k, (start, n) in enumerate(spans) for d in days("2024-01-01", start + n)[start:]]
    df = frame(rows, "series_key string, data string")
    got = [(r["fold"], r["data"]) for r in windows.expanding_folds(df, "data", splits).collect()]
    for f in range(1, splits + 1):
        train, test = [d for g, d in got if g < f], [d for g, d in got if g == f]
        assert not train or not test or max(train) < min(test)
    cut = [(r["split"], r["data"]) for r in windows.tail_split(df, "data", 0.2).collect()]
    train, hold = [d for g, d in cut if g == "train"], [d for g, d in cut if g == "holdout"]
    assert len(cut) == len(rows) and hold and (not train or max(train) < min(hold))


def test_tail_split(frame):
    df = frame([("a", d) for d in days("2024-01-01", 11)] + [("b", "2024-01-01"), ("b", "2024-01-11")], "series_key string, data string")
    out = as_dict(windows.tail_split(df, "data", 0.2).groupBy("series_key", "split").count(), "series_key", "split")
    assert out["a", "holdout"]["count"] == 2 and out["b", "holdout"]["count"] == 1
    assert windows.tail_split(df, "data", 0.9).filter("split = 'holdout'").count() == 0


def test_repeated_days_add_no_rows(frame):
    df = frame([("a", d, 1.0) for d in ("2024-01-01", "2024-01-03", "2024-01-03", "2024-01-05")], "series_key string, data string, v double")
    got = sorted(str(r["data"]) for r in windows.densify(df, K, "data").collect())
    assert got == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03", "2024-01-04", "2024-01-05"]


def test_keys_do_not_mix(frame):
    rows = [("a", d, float(i)) for i, d in enumerate(days("2024-01-01", 30))] + [("b", d, float(-i)) for i, d in enumerate(days("2024-01-05", 30))]
    df = frame(rows, "series_key string, data string, v double")
    def run(x):
        week = resample.weekly_aggregate(windows.densify(x, K, "data"), K, "data", ["v"], ["mean", "sum"])
        return windows.add_lags_rolls(week, K, "data", ["v_sum_w"])
    both = sorted(map(str, run(df).filter("series_key = 'a'").collect()))
    assert both == sorted(map(str, run(df.filter("series_key = 'a'")).collect()))


def test_next_instant_crosses_pieces(spark):
    rows = [("p", t) for t in ("2024-01-01 00:10:00", "2024-01-01 00:50:00", "2024-01-01 05:00:00", "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "plant string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = [str(r["next_ts"])[:16] for r in hot.next_instant(df, ["plant"], "ts").orderBy("ts").collect()]
    assert got == ["2024-01-01 00:50", "2024-01-01 05:00", "2024-01-02 00:00", "None"]


@pytest.mark.parametrize("bracket", [0.002, 0.05, 0.3])
def test_exact_quantiles_against_numpy(spark, bracket):
    rng = random.Random(int(1000 * bracket))
    # One group holds most rows, and a single value most of that group.
    rows = [("hot", 7.0) for _ in range(150)] + [("hot", rng.gauss(0, 50)) for _ in range(900)]
    rows += [(g, float(rng.randint(-3, 3))) for g in "xyz" for _ in range(11)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = (0.0, 0.05, 0.5, 0.83, 1.0)
    got = {(r["g"], r["prob"]): r["value"] for r in hot.exact_quantiles(df, ["g"], ["v"], probs, bracket).collect()}
    for g in ("hot", "x", "y", "z"):
        values = [v for k, v in rows if k == g]
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(values, p), abs=1e-9)
    assert not any(k[0] == "empty" for k in got)


def test_quantiles_of_many_columns_with_nulls(spark):
    rng = np.random.default_rng(2)
    wide = rng.normal(0, 1, (60, 300)) * (rng.random((60, 300)) > 0.3)
    rows = [tuple(None if rng.random() < 0.1 else float(x) for x in row) for row in wide]
    cols = [f"c{k}" for k in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {(r["variable"], r["prob"]): r["value"] for r in hot.exact_quantiles(df, [], cols, (0.25, 0.5)).collect()}
    for k, c in enumerate(cols):
        values = [r[k] for r in rows if r[k] is not None]
        assert got[c, 0.5] == pytest.approx(np.median(values)) and got[c, 0.25] == pytest.approx(np.quantile(values, 0.25))


def test_number_rows_over_pieces(spark):
    ids = list(range(300))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame([("hot" if i % 3 else "cold", i) for i in ids], "k string, i bigint")
    got = hot.number_rows(df, ["k"], ["i"])
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("i")))
    assert sorted(map(tuple, got.select("k", "i", "n").collect())) == sorted(map(tuple, want.select("k", "i", "n").collect()))


def test_copies_of_an_instant_move_apart(spark):
    rows = [("a", "2024-01-01 00:00:00", i) for i in range(40)] + [("a", "2024-01-02 00:00:00", 99)]
    df = spark.createDataFrame(rows, "k string, ts string, i bigint").withColumn("ts", F.col("ts").cast("timestamp"))
    out = hot.bump_duplicates(df, ["k"], "ts", "i")
    shift = {r["i"]: r["s"] for r in out.select("i", (F.unix_micros("ts_unique") - F.unix_micros("ts")).alias("s")).collect()}
    assert all(shift[i] == i for i in range(40)) and shift[99] == 0


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")], "k string, o int, v string")
    assert as_dict(hot.last_per_key(df, ["k"], ["o"]), "k") == {"a": {"o": 3, "v": "z"}, "b": {"o": 2, "v": "y"}}


def test_scalar_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (None, 2.0, None), (float("nan"), 3.0, 4.0)], "a double, b double, c double")
    df = df.withColumn("a", scalars.to_number("a"))
    rows = df.select(
        scalars.safe_ratio("a", "b").alias("ratio"), scalars.clip_low(-F.col("a")).alias("clip"),
        scalars.row_sum(["a", "c"], need_one=True).alias("need"), scalars.row_sum(["a", "c"]).alias("zero"),
        scalars.net_sum(["a", "b"], ["c"]).alias("net"), scalars.same_value("a", "c").alias("same")).collect()
    assert [r["ratio"] for r in rows] == [None, None, None]
    assert [r["clip"] for r in rows] == [0.0, None, None]
    assert [r["need"] for r in rows] == [1.0, None, 4.0] and [r["zero"] for r in rows] == [1.0, 0.0, 4.0]
    assert [r["net"] for r in rows] == [1.0, 2.0, -1.0]
    assert [r["same"] for r in rows] == [False, True, False]


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "2024-02-30"), ("x", "2024-02-29"), ("", None)], "n string, d string")
    rows = df.select(scalars.to_number("n").alias("n"), scalars.to_date("d").alias("d")).collect()
    assert [r["n"] for r in rows] == [1.5, None, None]
    assert [r["d"] for r in rows] == [None, dt.date(2024, 2, 29), None]


def test_null_keys_are_kept(spark):
    rows = [(None, "2024-01-01 00:00:00", 1), (None, "2024-01-01 00:00:00", 2), ("p", None, 3), ("p", None, 4)]
    df = spark.createDataFrame(rows, "k string, ts string, i bigint").withColumn("ts", F.col("ts").cast("timestamp"))
    out = {r["i"]: r["ts_unique"] for r in hot.bump_duplicates(df, ["k"], "ts", "i").collect()}
    assert len(out) == 4 and out[3] is out[4] is None and (out[2] - out[1]).microseconds == 1
    power = spark.createDataFrame([(None, "2024-01-01 00:00:00", 1, 4.0, 0.0)], "plant string, ts string, row bigint, ref double, lim double")
    power = power.withColumn("ts", F.col("ts").cast("timestamp"))
    row = energy.integrate_energy(power, ["plant"], "ts", energy.curtailed_power("ref", "lim"), "row", "e").first()
    assert row["plant"] is None and row["e"] == 2.0
    with pytest.raises(ValueError):
        energy.integrate_energy(power, ["plant"], "ts", F.col("ref"), "row", "e", by=["ref"])
