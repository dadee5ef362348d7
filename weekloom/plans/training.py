"""Training, validation and scoring of the risk classifiers with Spark ML.

A fitted model is one ``PipelineModel``: imputation with exact medians,
assembly, scaling where wanted, the classifier on gap-free class codes, and
the way back to the original codes. It is saved together with a JSON record of
its features, thresholds and label names.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

import numpy as np
import pandas as pd
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.config import LabelRules, Settings, TrainSettings
from weekloom.functions.scalars import LABEL_CODES, LABELS, decode_label
from weekloom.models import design, linear, trees
from weekloom.models.trees import TreeModel
from weekloom.operators import metrics
from weekloom.operators.coverage import drop_empty_columns, numeric_columns, reindex_columns
from weekloom.operators.hot import exact_quantiles
from weekloom.operators.labels import check_thresholds, label_audit, label_thresholds, label_weeks, relabel_with_hard_rules
from weekloom.operators.sampling import oversample_minority
from weekloom.operators.selection import selected_columns
from weekloom.operators.windows import expanding_folds, lead_target, tail_split
from weekloom.plans.weekly import KEYS, TIME
from weekloom.session import stage
from weekloom.sources import stores
from weekloom.sources.json_feeds import scoring_requests

LABEL, PRED = "classe_risco", "previsto"
_FAMILIES = {
    "logistic_regression": "logreg", "logreg": "logreg", "lr": "logreg",
    "xgboost": "gbt", "xgb": "gbt", "gbt": "gbt",
    "random_forest": "rf", "rf": "rf", "randomforest": "rf",
}


@dataclass(frozen=True)
class ModelSpec:
    """A model family with parameters under their usual names, and an optional search grid."""

    name: str
    family: str
    params: Mapping[str, Any] = field(default_factory=dict)
    grid: Mapping[str, Sequence[Any]] = field(default_factory=dict)
    refit: str = "f1_macro"

    def with_params(self, extra: Mapping[str, Any]) -> "ModelSpec":
        return ModelSpec(self.name, self.family, {**self.params, **extra}, {}, self.refit)


@dataclass
class FittedModel:
    """A fitted pipeline, or trees of this library, and what is needed to use it on other tables."""

    pipeline: PipelineModel
    features: list[str]
    params: dict[str, Any] = field(default_factory=dict)
    thresholds: DataFrame | None = None
    trees: TreeModel | None = None
    present: list[int] = field(default_factory=list)

    def _scored(self, df: DataFrame) -> DataFrame:
        """The table with its features, ``prediction`` and ``_p``, the probabilities by class code."""
        have = set(df.columns)
        full = df.select("*", *[F.lit(None).cast("double").alias(c) for c in self.features if c not in have])
        if self.trees is not None:
            return full.withColumn("_p", _tree_probabilities(self.trees)(_as_array(self.features))).withColumn(
                "prediction", (F.array_position("_p", F.array_max("_p")) - 1).cast("double"))
        scored = self.pipeline.transform(full)
        zero = F.lit(0.0)
        if "probability" in scored.columns:
            given = vector_to_array("probability")
            each = [given[self.present.index(code)] if code in self.present else zero for code in range(len(LABELS))]
        else:  # a single class
            each = [F.lit(1.0) if code in self.present else zero for code in range(len(LABELS))]
        return scored.withColumn("_p", F.array(*each))

    def predict(self, df: DataFrame, out: str = PRED) -> DataFrame:
        """The table with a predicted label; missing feature columns count as null."""
        return self._scored(df).select(*[c for c in df.columns if c != out], decode_label("prediction").alias(out))

    def probabilities(self, df: DataFrame, prefix: str = "prob_") -> DataFrame:
        """The table with one column per class; they add up to 1, and a class without training rows has 0."""
        names = {f"{prefix}{name}": code for code, name in enumerate(LABELS)}
        return self._scored(df).select(*[c for c in df.columns if c not in names], *[F.col("_p")[code].alias(n) for n, code in names.items()])


def _as_array(features: Sequence[str]):
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


def _tree_probabilities(model: TreeModel):
    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(list(model.probabilities(np.stack(x.to_list())))) if len(x) else pd.Series([], dtype=object)
    return run


def column_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median, mean and population standard deviation per column."""
    one = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    rows = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(cols)])
    medians = exact_quantiles(df, [], cols, [0.5]).select("variable", F.col("value").alias("median"))
    return one.select(F.inline(rows)).join(medians, "variable", "left").select("variable", "median", "mean", "std")


def _impute(df: DataFrame, cols: Sequence[str]) -> SQLTransformer:
    """Fill each column with its median; a column without values becomes 0."""
    medians = {r["variable"]: r["value"] for r in exact_quantiles(df, [], cols, [0.5]).collect()}  # one row per column
    filled = ", ".join(f"coalesce(cast(`{c}` as double), {float(medians.get(c, 0.0))!r}D) AS `{c}__in`" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


# The deepest trees Spark grows, and parameters of other libraries that Spark's models do not have.
MAX_DEPTH = 30
_UNUSED = {"logreg": {"solver"}, "rf": set(), "gbt": {"scale_pos_weight"}}


def _grows_here(spec: ModelSpec) -> bool:
    """Whether the trees of this library fit the model: boosting, and forests with limits Spark's trees do not have."""
    family, p = _FAMILIES.get(spec.family.lower()), spec.params
    return family == "gbt" or family == "rf" and ("min_samples_split" in p or "max_depth" in p and (not p["max_depth"] or int(p["max_depth"]) > MAX_DEPTH))


def _classifier(spec: ModelSpec, n_classes: int):
    family, p = _FAMILIES.get(spec.family.lower()), spec.params
    unused = set(p) & _UNUSED.get(family, set())
    if unused:
        warnings.warn(f"{spec.family}: no effect here: {sorted(unused)}", stacklevel=2)
    cols = {"featuresCol": "features", "labelCol": "dense"}
    if family == "logreg":
        # C is the inverse of the penalty on the summed loss; Spark averages the loss.
        return LogisticRegression(
            **cols, weightCol="weight", maxIter=int(p.get("max_iter", 500)), standardization=False,
            regParam=1.0 / (float(p.get("C", 1.0)) * max(1, int(p.get("_rows", 1)))), elasticNetParam=0.0)
    if family == "rf":
        return RandomForestClassifier(
            **cols, weightCol="weight", numTrees=int(p.get("n_estimators", 500)),
            maxDepth=int(p.get("max_depth") or MAX_DEPTH), minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            featureSubsetStrategy=str(p.get("max_features", "sqrt")), seed=int(p.get("random_state", 42)))
    raise ValueError(f"unknown model family: {spec.family}")


def _case(col: str, pairs: Mapping[Any, Any], kind: str = "DOUBLE") -> str:
    body = " ".join(f"WHEN {a} THEN {b}" for a, b in pairs.items())
    return f"CAST(CASE {col} {body} END AS {kind})"


def fit_model(train: DataFrame, features: Sequence[str], spec: ModelSpec, label: str = LABEL) -> FittedModel:
    """Fit on the rows that have a label.

    The classes present get codes without gaps; a single class gives a model
    that always answers it.
    """
    rows = train.filter(F.col(label).isin(*LABELS))
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}  # one row per class
    if not counts:
        raise ValueError("no labelled rows to train on")
    present = sorted(LABEL_CODES[c] for c in counts)
    if len(present) == 1:
        constant = SQLTransformer(statement=f"SELECT *, {float(present[0])}D AS prediction FROM __THIS__")
        return FittedModel(PipelineModel([constant]), list(features), dict(spec.params), present=present)
    if _grows_here(spec):
        return _fit_trees(rows, features, spec, label, present)
    total = sum(counts.values())
    balanced = spec.params.get("class_weight", "balanced" if _FAMILIES.get(spec.family.lower()) == "logreg" else None)
    weight, dense = None, None
    for i, code in enumerate(present):
        name = LABELS[code]
        w = total / (len(present) * counts[name]) if balanced == "balanced" else 1.0
        hit = F.col(label) == name
        weight = F.when(hit, w) if weight is None else weight.when(hit, w)
        dense = F.when(hit, float(i)) if dense is None else dense.when(hit, float(i))
    ready = rows.withColumns({"weight": weight, "dense": dense})
    spec = spec.with_params({"_rows": total})
    inputs = [f"{c}__in" for c in features]
    stages = [_impute(ready, features)]
    if _FAMILIES.get(spec.family.lower()) == "logreg":
        stages += [VectorAssembler(inputCols=inputs, outputCol="raw"),
                   StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]
    else:
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    fitted = Pipeline(stages=[*stages, _classifier(spec, len(present))]).fit(ready)
    if present == list(range(len(present))):
        return FittedModel(fitted, list(features), dict(spec.params), present=present)
    back = SQLTransformer(statement="SELECT * EXCEPT (prediction), " + _case(
        "prediction", {float(i): code for i, code in enumerate(present)}) + " AS prediction FROM __THIS__")
    return FittedModel(PipelineModel([*fitted.stages, back]), list(features), dict(spec.params), present=present)


# What the boosted trees take where nothing is given.
_BOOST_DEFAULTS = {"n_estimators": 300, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8, "reg_lambda": 1.0}


def _tree_params(spec: ModelSpec) -> dict[str, Any]:
    p = {**(_BOOST_DEFAULTS if _FAMILIES.get(spec.family.lower()) == "gbt" else {}), **spec.params}
    if not 0 < float(p.get("subsample", 1.0)) <= 1:
        raise ValueError(f"subsample {p['subsample']} is not in (0, 1]")
    unused = set(p) & _UNUSED.get(_FAMILIES.get(spec.family.lower()), set())
    if unused:
        warnings.warn(f"{spec.family}: no effect here: {sorted(unused)}", stacklevel=2)
    return p


def _grow(rows: DataFrame, features: Sequence[str], spec: ModelSpec, n_folds: int, tasks: Sequence[tuple]) -> list[TreeModel]:
    fit = trees.boost if _FAMILIES[spec.family.lower()] == "gbt" else trees.forest
    return fit(rows, len(features), len(LABELS), n_folds, tasks)


def _fit_trees(rows: DataFrame, features: Sequence[str], spec: ModelSpec, label: str, present: list[int]) -> FittedModel:
    table = design.design_rows(rows, features, code_of(label))
    model = _grow(table, features, spec, 0, [(_tree_params(spec), 0)])[0]
    return FittedModel(PipelineModel([]), list(features), dict(spec.params), trees=model, present=present)


def feature_importances(model: FittedModel, spark: SparkSession) -> DataFrame | None:
    """Rows (feature, importance), largest first, for tree models."""
    if model.trees is not None:
        return spark.createDataFrame(model.trees.importances(model.features), "feature string, importance double").orderBy(F.desc("importance"), "feature")
    found = None
    for s in model.pipeline.stages:
        if hasattr(s, "featureImportances"):
            found = s.featureImportances.toArray()
    if found is None:
        return None
    rows = [(c, float(v)) for c, v in zip(model.features, found)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _fold_scores(folds: DataFrame, features: Sequence[str], spec: ModelSpec, n_splits: int, rules: LabelRules | None,
                 oversample: TrainSettings | None) -> list[tuple[int, float, float]]:
    """Scores per fold: train on the blocks before, test on the block."""
    out = []
    for f in range(1, n_splits + 1):
        train, test = folds.filter((F.col("fold") < f) & F.col(LABEL).isNotNull()), folds.filter(
            (F.col("fold") == f) & F.col(LABEL).isNotNull())
        if train.isEmpty() or test.isEmpty():
            continue
        if oversample is not None:
            train = oversample_minority(train, LABEL, [*KEYS, TIME], oversample.min_fraction, oversample.seed)
        scored = fit_model(train, features, spec).predict(test)
        if rules is not None:
            scored = relabel_with_hard_rules(scored, PRED, rules)
        row = metrics.macro_scores(scored, LABEL, PRED).first()
        out.append((f, row["f1_macro"], row["balanced_acc"]))
    return out


def fold_sizes(folds: DataFrame, n_splits: int) -> DataFrame:
    """Labelled rows each fold trains and tests on."""
    known = folds.filter(F.col(LABEL).isNotNull())
    each = F.explode(F.array(*[F.lit(f) for f in range(1, n_splits + 1)])).alias("k")
    sizes = known.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).select("fold", "n", each)
    return sizes.groupBy(F.col("k").alias("fold")).agg(
        F.coalesce(F.sum(F.when(F.col("fold") < F.col("k"), F.col("n"))), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum(F.when(F.col("fold") == F.col("k"), F.col("n"))), F.lit(0)).alias("n_test"))


_SCORES = "fold int, f1_macro double, balanced_acc double"


def cross_validate(store: DataFrame, features: Sequence[str], spec: ModelSpec, settings: TrainSettings,
                   rules: LabelRules | None = None) -> DataFrame:
    """Expanding-window validation with folds at dates shared by all series: one row per fold."""
    folds = expanding_folds(store, TIME, settings.n_splits)
    boosted = settings if settings.oversample and settings.oversample_in_cv else None
    scores = _fold_scores(folds, features, spec, settings.n_splits, rules, boosted)
    return store.sparkSession.createDataFrame(scores, _SCORES)


def tune(store: DataFrame, features: Sequence[str], spec: ModelSpec, settings: TrainSettings) -> tuple[ModelSpec, DataFrame | None]:
    """The best parameters of the grid by mean validation score; the given ones if none can be fitted.

    A combination the model cannot take is skipped with a warning.
    """
    if not spec.grid:
        return spec, None
    folds = expanding_folds(store.filter(F.col(LABEL).isNotNull()), TIME, settings.tuning_splits)
    names, results = list(spec.grid), []
    if _FAMILIES.get(spec.family.lower()) == "logreg":
        return _best(store.sparkSession, spec, _linear_scores(folds, features, spec, settings.tuning_splits))
    if all(_grows_here(spec.with_params(dict(zip(names, values)))) for values in itertools.product(*spec.grid.values())):
        return _best(store.sparkSession, spec, _tree_scores(folds, features, spec, settings.tuning_splits))
    for values in itertools.product(*spec.grid.values()):
        params = dict(zip(names, values))
        try:
            scores = _fold_scores(folds, features, spec.with_params(params), settings.tuning_splits, None, None)
        except (ValueError, IllegalArgumentException) as exc:  # parameters this model cannot take
            warnings.warn(f"skipped {params}: {exc}", stacklevel=2)
            continue
        if scores:
            results.append((str(params), params, sum(s[1] for s in scores) / len(scores), sum(s[2] for s in scores) / len(scores)))
    return _best(store.sparkSession, spec, results)


def _linear_scores(folds: DataFrame, features: Sequence[str], spec: ModelSpec, n_splits: int) -> list[tuple]:
    """Mean scores of all combinations of a softmax regression, fitted in the same scans."""
    chosen = {k: v for k, v in spec.params.items() if k in linear.PARAMS}
    combos = [{"class_weight": "balanced", **chosen, **dict(zip(spec.grid, values))} for values in itertools.product(*spec.grid.values())]
    rows = design.design_rows(folds, features, code_of(LABEL), F.col("fold"))
    grid = linear.fit_grid(rows, len(features), len(LABELS), n_splits, combos, only=range(1, n_splits + 1))
    scores = linear.grid_scores(rows, grid, len(features), len(LABELS), n_splits)
    return _mean_scores([{k: combo[k] for k in spec.grid} for combo in combos], scores)


def _tree_scores(folds: DataFrame, features: Sequence[str], spec: ModelSpec, n_splits: int) -> list[tuple]:
    """Mean scores of all combinations of boosted trees or forests, grown in the same scans."""
    combos, tasks = [], []
    for values in itertools.product(*spec.grid.values()):
        params = dict(zip(spec.grid, values))
        try:
            full = _tree_params(spec.with_params(params))
        except ValueError as exc:  # parameters this model cannot take
            warnings.warn(f"skipped {params}: {exc}", stacklevel=2)
            continue
        combos.append(params)
        tasks += [(full, f) for f in range(1, n_splits + 1)]
    rows = design.design_rows(folds, features, code_of(LABEL), F.col("fold"))
    grown = _grow(rows, features, spec, n_splits, tasks)
    scores = trees.fold_scores(rows, grown, len(features), len(LABELS))
    return _mean_scores(combos, [(k // n_splits, *rest) for k, *rest in scores])


def _mean_scores(combos: Sequence[Mapping[str, Any]], scores: Sequence[tuple]) -> list[tuple]:
    """(text, parameters, mean macro F1, mean balanced accuracy) of the combinations that have scores (position, fold, F1, accuracy)."""
    out = []
    for c, params in enumerate(combos):
        mine = [s[2:] for s in scores if s[0] == c]
        if mine:
            out.append((str(params), params, *[sum(v) / len(mine) for v in zip(*mine)]))
    return out


def code_of(label: str):
    """The class code of a label; null for others."""
    code = F.lit(None).cast("int")
    for name, value in LABEL_CODES.items():
        code = F.when(F.col(label) == name, value).otherwise(code)
    return code


def _best(spark: SparkSession, spec: ModelSpec, results: Sequence[tuple]) -> tuple[ModelSpec, DataFrame | None]:
    if not results:
        return spec, None
    which = 3 if spec.refit == "balanced_accuracy" else 2
    best = max(results, key=lambda r: r[which])
    table = spark.createDataFrame([(r[0], r[2], r[3]) for r in results], "params string, f1_macro double, balanced_acc double")
    return spec.with_params(best[1]), table


def save_model(model: FittedModel, spark: SparkSession, path: str) -> None:
    if model.trees is None:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    else:
        model.trees.table(spark, model.features).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    stores.write_record(spark, {
        "selected_features": model.features, "label_mapping": LABEL_CODES, "present": model.present,
        "trees": model.trees.record() if model.trees is not None else None,
        "params": {k: v for k, v in model.params.items() if not k.startswith("_")},
    }, f"{path}/record")
    if model.thresholds is not None:
        model.thresholds.write.mode("overwrite").parquet(f"{path}/thresholds")


def load_model(spark: SparkSession, paths: Sequence[str]) -> FittedModel:
    """The first model that exists among the candidate paths."""
    path = stores.first_existing(spark, list(paths))
    if path is None:
        raise FileNotFoundError(f"no model at any of {list(paths)}")
    record = stores.read_record(spark, f"{path}/record")
    thresholds = spark.read.parquet(f"{path}/thresholds") if stores.exists(spark, f"{path}/thresholds") else None
    features, present = record["selected_features"], record.get("present") or []
    if record.get("trees"):
        nodes = spark.read.parquet(f"{path}/trees").collect()  # one row per node of the model
        return FittedModel(PipelineModel([]), features, record["params"], thresholds, TreeModel.restored(nodes, features, record["trees"]), present)
    return FittedModel(PipelineModel.load(f"{path}/pipeline"), features, record["params"], thresholds, present=present)


@dataclass
class TrainingData:
    """The labelled store split in time, with the thresholds its labels come from."""

    train: DataFrame
    holdout: DataFrame
    thresholds: DataFrame
    features: list[str]
    audit: DataFrame


def prepare_training(store: DataFrame, settings: Settings, per_split_windows: bool = False) -> TrainingData:
    """Split off the last weeks of all series, take thresholds from the rest, label both.

    The store and its labelled form are staged: several passes, and then every
    fold and model, read them again.
    Labels are computed on the whole series; ``per_split_windows`` restarts
    runs of low inflow at the split instead.
    """
    store = drop_empty_columns(stage(store, "store"), [*KEYS, TIME])
    features = [c for c in numeric_columns(store) if c not in (*KEYS, TIME)]
    if not features:
        raise RuntimeError("no weekly feature available")
    split = tail_split(store, TIME, settings.training.holdout_fraction)
    thresholds = stage(label_thresholds(split.filter("split = 'train'"), KEYS, settings.labels), "thresholds")
    check_thresholds(thresholds)
    scope = [*KEYS, "split"] if per_split_windows else None
    labelled = label_weeks(split, thresholds, KEYS, TIME, settings.labels, LABEL, window_keys=scope)
    if settings.training.train_horizon:
        labelled = lead_target(labelled, KEYS, TIME, LABEL, settings.training.train_horizon, LABEL, drop_null=False)
    data = stage(labelled, "labelled")
    train, hold = data.filter("split = 'train'").drop("split"), data.filter("split = 'holdout'").drop("split")
    audit = label_audit(train.drop(LABEL), thresholds, KEYS, TIME, settings.labels, train.select(*KEYS, TIME, LABEL))
    return TrainingData(train, hold, thresholds, features, audit)


def train_model(data: TrainingData, spec: ModelSpec, settings: Settings, out_dir: str | None = None,
                importances: DataFrame | None = None) -> tuple[FittedModel, DataFrame]:
    """Select features, search parameters, validate, fit on all training rows, save."""
    t = settings.training
    features = selected_columns(importances, settings.selection, data.features) or data.features
    spec, tried = tune(data.train, features, spec, t)
    scores = cross_validate(data.train, features, spec, t, settings.labels)
    final = data.train.filter(F.col(LABEL).isNotNull())
    if t.oversample and not t.oversample_in_cv:
        final = oversample_minority(final, LABEL, [*KEYS, TIME], t.min_fraction, t.seed)
    model = fit_model(final, features, spec)
    model.thresholds = data.thresholds
    if out_dir:
        _persist(model, data, spec, scores, tried, out_dir)
    return model, scores


def _persist(model: FittedModel, data: TrainingData, spec: ModelSpec, scores: DataFrame, tried: DataFrame | None, out_dir: str) -> None:
    spark = data.train.sparkSession
    save_model(model, spark, f"{out_dir}/{spec.name}")
    data.thresholds.write.mode("overwrite").json(f"{out_dir}/label_thresholds_{spec.name}")
    if tried is not None:
        stores.write_json(tried, f"{out_dir}/tuning_{spec.name}")
    mean = metrics.mean_scores(scores).first()
    stores.append_scores(spark, f"{out_dir}/metrics_cv", spec.name, mean["f1_macro"], mean["balanced_acc"])
    ranking = feature_importances(model, spark)
    if ranking is not None:
        report = ranking.agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("_o"), "feature", "importance"))).alias("r")).select(
            F.lit(spec.name).alias("model"), F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"),
            F.lit(len(model.features)).alias("n_features"),
            F.transform("r", lambda e: F.struct(e["feature"].alias("feature"), e["importance"].alias("importance"))).alias("feature_importances"))
        stores.write_json(report, f"{out_dir}/feature_importances_{spec.name}")


@dataclass
class Evaluation:
    report: DataFrame
    matrix: DataFrame
    predictions: DataFrame


def evaluate(model: FittedModel, labelled: DataFrame, rules: LabelRules, horizon: int = 1) -> Evaluation:
    """Report and confusion matrix against the label ``horizon`` weeks ahead, hard rules applied."""
    target = lead_target(labelled, KEYS, TIME, LABEL, horizon, "alvo")
    scored = relabel_with_hard_rules(model.predict(target), PRED, rules)
    return Evaluation(metrics.class_report(scored, "alvo", PRED), metrics.confusion_matrix(scored, "alvo", PRED), scored)


def score_requests(model: FittedModel, requests: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Answers to JSON feature requests: a class, or an error text for unusable ones."""
    parsed = scoring_requests(requests, col, model.features, keep)
    scored = model.predict(parsed)
    return scored.select(
        *keep, F.when(F.col("error").isNull(), 200).otherwise(400).alias("status"),
        F.when(F.col("error").isNull(), F.col(PRED)).alias(LABEL), "error")
