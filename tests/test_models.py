"""Training, validation, persistence and scoring on a small labelled store."""

import json
import random

import pytest
from pyspark.sql import functions as F

from weekloom.config import LabelRules, SelectionSettings, Settings, TrainSettings
from weekloom.plans import training as tr
from weekloom.sources import stores

RULES = LabelRules(margin_col="m", curtail_on=False, hydro_on=False, hard_on=False)
SETTINGS = Settings(labels=RULES, training=TrainSettings(n_splits=2, tuning_splits=2, min_fraction=0.3))


@pytest.fixture(scope="module")
def store(spark):
    rng = random.Random(5)
    rows = []
    for k in ("a", "b"):
        for i in range(60):
            m = rng.gauss(0, 10)
            rows.append((k, i, m, m + rng.gauss(0, 1), None if i % 9 == 0 else rng.random(), None))
    df = spark.createDataFrame(rows, "series_key string, i int, m double, x double, noise double, empty double")
    return df.withColumn("data", F.date_add(F.lit("2020-01-05").cast("date"), F.col("i") * 7)).drop("i")


@pytest.fixture(scope="module")
def data(store):
    return tr.prepare_training(store, SETTINGS)


def test_preparation(data):
    assert data.features == ["m", "x", "noise"]
    assert data.train.count() == 96 and data.holdout.count() == 24
    assert data.audit.filter("label_pipeline <> label_final_calc").count() == 0
    first_hold = data.holdout.agg(F.min("data")).first()[0]
    assert data.train.agg(F.max("data")).first()[0] < first_hold


def test_train_save_load_score(spark, data, tmp_path):
    out = str(tmp_path / "models")
    spec = tr.ModelSpec("rf", "random_forest", {"n_estimators": 8, "max_depth": 4}, grid={"max_depth": [2, 4]})
    model, scores = tr.train_model(data, spec, SETTINGS, out)
    assert scores.count() == 2 and all(0 <= r["f1_macro"] <= 1 for r in scores.collect())
    again = tr.load_model(spark, [f"{out}/absent", f"{out}/rf"])
    assert again.features == model.features and again.thresholds.count() == 2
    def answers(m):
        return {(r["series_key"], r["data"]): r[tr.PRED] for r in m.predict(data.holdout).collect()}
    assert answers(again) == answers(model)
    ev = tr.evaluate(model, data.holdout, RULES, 0)
    assert ev.predictions.count() == 24
    assert {r["row"]: r["f1"] for r in ev.report.collect()}["accuracy"] > 0.7
    stores.write_report(ev.report, ev.matrix, f"{out}/report")
    assert spark.read.text(f"{out}/report").count() == 9
    history = spark.read.parquet(f"{out}/metrics_cv").first()
    assert history["modelo"] == "rf"
    ranking = json.loads(spark.read.text(f"{out}/feature_importances_rf").first()[0])["feature_importances"]
    assert [r["importance"] for r in ranking] == sorted((r["importance"] for r in ranking), reverse=True)
    requests = spark.createDataFrame([('{"features": {"m": -30, "x": "-30"}}',), ("nope",)], "r string")
    got = sorted((r["status"], r["classe_risco"]) for r in tr.score_requests(again, requests, "r").collect())
    assert got == [(200, "alto"), (400, None)]
    with pytest.raises(FileNotFoundError):
        tr.load_model(spark, [f"{out}/absent"])


@pytest.mark.parametrize("family,params", [("logreg", {"max_iter": 30}), ("gbt", {"n_estimators": 3, "max_depth": 2})])
def test_families(data, family, params):
    model = tr.fit_model(data.train, data.features, tr.ModelSpec(family, family, params))
    rows = model.predict(data.train).select(tr.LABEL, tr.PRED).collect()
    assert sum(r[0] == r[1] for r in rows) / len(rows) > 0.7


def test_gaps_in_the_classes(data):
    two = data.train.filter("classe_risco <> 'medio'")
    model = tr.fit_model(two, data.features, tr.ModelSpec("logreg", "logreg", {"max_iter": 20}))
    assert {r[0] for r in model.predict(two).select(tr.PRED).distinct().collect()} == {"baixo", "alto"}
    one = data.train.filter("classe_risco = 'medio'")
    constant = tr.fit_model(one, data.features, tr.ModelSpec("logreg", "logreg"))
    assert {r[0] for r in constant.predict(data.holdout).select(tr.PRED).distinct().collect()} == {"medio"}
    with pytest.raises(ValueError):
        tr.fit_model(one.limit(0), data.features, tr.ModelSpec("logreg", "logreg"))
    with pytest.raises(ValueError):
        tr.fit_model(two, data.features, tr.ModelSpec("x", "svm"))


def test_selection_limits_the_features(data):
    chosen = Settings(labels=RULES, training=TrainSettings(n_splits=2, oversample=False), selection=SelectionSettings(keep=("x",)))
    model, _ = tr.train_model(data, tr.ModelSpec("logreg", "logreg", {"max_iter": 10}), chosen)
    assert model.features == ["x"]


def test_column_statistics(data):
    row = {r["variable"]: r for r in tr.column_statistics(data.train, ["m", "noise"]).collect()}["m"]
    values = sorted(r["m"] for r in data.train.select("m").collect())
    assert row["median"] == pytest.approx((values[47] + values[48]) / 2)
