"""Search grids and trees that are fitted in shared scans, and sums over a staged table."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.config import TrainSettings
from weekloom.models import design, linear, trees
from weekloom.operators import profile
from weekloom.plans import training as tr
from weekloom.sources import delimited

NAMES = ["a", "b", "d", "e"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(600, 4)) * [1, 5, 0.1, 2] + [0, 3, 1, 0], 1)
    y = (x[:, 0] * 1.2 + x[:, 1] * 0.3 + 0.3 * rng.normal(size=600) > 1).astype(int) + (x[:, 3] > 2)
    x[x[:, 0] > 1.5, 1] = np.nan
    rows = [(int(c), i // 150, i, *[None if np.isnan(v) else float(v) for v in r]) for i, (c, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "c int, fold int, i int, " + ", ".join(f"{n} double" for n in NAMES))
    return df, design.design_rows(df, NAMES, F.col("c"), F.col("fold")), x, y


def test_grid_equals_single_fits(spark, data):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df, rows, x, y = data
    grid = linear.fit_grid(rows, 4, 3, 3, [{"C": 1.0}, {"C": 0.01, "class_weight": "balanced"}], only=[2])
    z = x[:300]
    z = np.where(np.isnan(z), np.nanmedian(z, axis=0), z)
    assert np.allclose(grid.mean[2], z.mean(0)) and np.allclose(grid.std[2], z.std(0, ddof=1))
    z = (z - z.mean(0)) / z.std(0, ddof=1)
    counts = np.bincount(y[:300], minlength=3)
    table = spark.createDataFrame([(float(c), float(300 / 3 / counts[c]), *map(float, r)) for c, r in zip(y[:300], z)], "c double, w double, a double, b double, d double, e double")
    table = VectorAssembler(inputCols=NAMES, outputCol="features").transform(table)
    for k, (c, extra) in enumerate(((1.0, {}), (0.01, {"weightCol": "w"}))):
        one = LogisticRegression(labelCol="c", regParam=1 / (c * 300), standardization=False, maxIter=500, tol=1e-10, family="multinomial", **extra).fit(table)
        want = one.coefficientMatrix.toArray().T
        got = grid.weights[2, k, :4]
        assert np.abs((got - got.mean(1, keepdims=True)) - (want - want.mean(1, keepdims=True))).max() < 2e-3
    assert not grid.weights[1].any()


def test_scans_do_not_grow_with_the_grid(data, monkeypatch):
    rows, calls = data[1], []
    plain = linear.summed
    monkeypatch.setattr(linear, "summed", lambda *a: calls.append(1) or plain(*a))
    used = []
    for grid in ([{"C": 0.1, "max_iter": 5}], [{"C": c, "max_iter": 5} for c in (0.1, 0.2, 0.5, 1.0, 2.0, 5.0)]):
        calls.clear()
        linear.fit_grid(rows, 4, 3, 3, grid)
        used.append(len(calls))
    assert used == [6, 6]
    with pytest.raises(ValueError):
        linear.fit_grid(rows, 4, 3, 3, [{"C": -1}])


def test_steps_read_equal_rows_once(data, monkeypatch):
    """Every scan of a table of copies reads its distinct rows, and the models are those of all its rows."""
    rows, read, plain = data[1], [], linear.summed
    rounded = F.transform("x", lambda v: F.when(F.isnan(v), v).otherwise(F.round(v / 4) * 4))
    rows = rows.select("code", "fold", "row", rounded.alias("x"), F.explode(F.sequence(F.lit(0), F.col("row") % 7)).alias("copy")).drop("copy")
    kinds = rows.select("code", "fold", "x").distinct().count()
    grid = [{"C": 1.0, "max_iter": 20}, {"C": 0.1, "class_weight": "balanced", "max_iter": 20}]
    monkeypatch.setattr(linear, "summed", lambda d, *a: read.append(d.count()) or plain(d, *a))
    found = linear.fit_grid(rows, 4, 3, 3, grid)
    assert 2 * kinds < rows.count() and set(read) == {kinds} and len(read) == found.steps + 1
    monkeypatch.setattr(linear, "distinct_rows", lambda d: d.withColumn("n", F.lit(1)))
    each = linear.fit_grid(rows, 4, 3, 3, grid)
    for name in ("weights", "mean", "std"):
        assert np.allclose(getattr(found, name), getattr(each, name), atol=1e-9)


def test_boosting_learns_and_obeys_its_penalties(data):
    _, rows, x, y = data
    base = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "reg_lambda": 1.0}
    found = trees.boost(rows, 4, 3, 3, [(base, 0), ({**base, "reg_lambda": 50.0}, 0), ({**base, "reg_alpha": 10.0}, 0), ({**base, "subsample": 0.7}, 3)])
    plain, heavy, sparse, _ = found
    p = plain.probabilities(x)
    assert (p.argmax(1) == y).mean() > 0.75 and np.allclose(p.sum(1), 1)
    largest = [max(np.abs(trees.leaf_values(t)).max() for t in m.trees) for m in (plain, heavy, sparse)]
    assert largest[1] < largest[0] and largest[2] < largest[0]
    assert [(k, f) for k, f, *_ in trees.fold_scores(rows, found, 4, 3)] == [(0, 0), (1, 0), (2, 0), (3, 3)]
    # The first round's root: derivatives at equal probabilities, summed by hand.
    for t in plain.trees[:3]:
        assert t.stats[0] == pytest.approx([600 / 3 - (y == t.cls).sum(), 600 * 4 / 9])


def test_forest_nodes_obey_the_limits(data):
    _, rows, x, y = data
    limits = {"n_estimators": 4, "max_depth": None, "min_samples_split": 40, "min_samples_leaf": 7, "class_weight": "balanced"}
    model = trees.forest(rows, 4, 3, 3, [(limits, 0)])[0]
    for t in model.trees:
        for node, f in enumerate(t.feature):
            n = t.stats[node][-1]
            assert n >= 7
            if f >= 0:
                assert n >= 40 and np.allclose(t.stats[node], t.stats[t.left[node]] + t.stats[t.right[node]])
    assert (model.probabilities(x).argmax(1) == y).mean() > 0.7
    deep = trees.forest(rows, 4, 3, 3, [({"n_estimators": 1, "bootstrap": False, "max_features": "all"}, 0)])[0]
    assert max(deep.trees[0].depth) > 5 and (deep.probabilities(x).argmax(1) == y).mean() > 0.97


def test_probabilities_and_saving(spark, data, tmp_path):
    df = data[0].withColumn("classe_risco", F.when(F.col("c") == 0, "baixo").when(F.col("c") == 2, "alto"))
    for spec in (tr.ModelSpec("g", "xgboost", {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "reg_lambda": 2}),
                 tr.ModelSpec("r", "rf", {"n_estimators": 2, "max_depth": None, "min_samples_split": 30}),
                 tr.ModelSpec("l", "logreg", {"max_iter": 20})):
        model = tr.fit_model(df, NAMES, spec)
        got = model.probabilities(df.drop("d")).orderBy("i").collect()
        assert all(r["prob_medio"] == 0 and abs(r["prob_baixo"] + r["prob_alto"] - 1) < 1e-9 for r in got)
        tr.save_model(model, spark, f"{tmp_path}/{spec.name}")
        again = tr.load_model(spark, [f"{tmp_path}/{spec.name}"])
        assert again.probabilities(df.drop("d")).orderBy("i").collect() == got
        best = {r["i"]: r[tr.PRED] for r in model.predict(df.drop("d")).collect()}
        assert all(best[r["i"]] == ("baixo" if r["prob_baixo"] >= r["prob_alto"] else "alto") for r in got)
    with pytest.raises(ValueError):
        tr.fit_model(df, NAMES, tr.ModelSpec("g", "xgboost", {"subsample": 2}))


def test_tuning_grows_all_combinations_together(data):
    df = data[0].withColumn("classe_risco", F.when(F.col("c") == 0, "baixo").when(F.col("c") == 1, "medio").otherwise("alto")).withColumn(
        "data", F.date_add(F.lit("2020-01-05").cast("date"), F.col("i")))
    spec = tr.ModelSpec("g", "xgboost", {"n_estimators": 2, "learning_rate": 0.5, "max_depth": 3}, grid={"max_depth": [1, 3], "subsample": [1.0, 7]})
    with pytest.warns(UserWarning, match="skipped"):
        best, table = tr.tune(df, NAMES, spec, TrainSettings(tuning_splits=2))
    rows = {r["params"]: r["f1_macro"] for r in table.collect()}
    assert len(rows) == 2 and best.params["max_depth"] == 3 and max(rows, key=rows.get) == str({"max_depth": 3, "subsample": 1.0})


def test_correlations_of_pairwise_complete_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) + 1e6
    x[:, 2] = x[:, 0] * 2 + rng.normal(size=200)
    x[rng.random((200, 3)) < 0.2] = np.nan
    rows = [(*[None if np.isnan(v) else float(v) for v in r], 5.0, None) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double, none double")
    got = {(r["var_a"], r["var_b"]): r["corr"] for r in profile.correlation_matrix(df, df.columns).collect()}
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)
    assert len(got) == 25 and got["same", "a"] is None and got["none", "none"] is None
    assert all(r["corr"] is None for r in profile.correlation_matrix(df.limit(0), ["a", "b"]).collect())
    counts = {r["variable"]: tuple(r)[1:] for r in profile.value_counts(df, ["same", "none"]).collect()}
    assert counts == {"same": (200, 1, 5.0, 5.0), "none": (0, 0, None, None)}


def test_records_over_block_borders(spark, tmp_path):
    lines = ['id;note;x'] + [f'{k};"line {k}\nand ""more""; still\n\nend";{k}' if k % 3 else f'{k};plain 5" pipe;{k}' for k in range(60)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="latin-1")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for size in ("100", "333", before):
            spark.conf.set(name, size)
            got = {r["id"]: (r["note"], r["x"]) for r in delimited.read_delimited(spark, str(tmp_path)).collect()}
            want = {str(k): (f'line {k}\nand "more"; still\n\nend' if k % 3 else f'plain 5" pipe', str(k)) for k in range(60)}
            assert {k: v for k, v in got.items() if int(k) % 3} == {k: v for k, v in want.items() if int(k) % 3}
            assert got == want
    finally:
        spark.conf.set(name, before)
