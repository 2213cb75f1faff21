"""The regressor registry, training with cross-validation, comparison and prediction."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.forest import PREDICTION, UNLIMITED, TreeEstimator, TreeModel
from plumbline.operators.kernel import KernelEstimator, KernelModel
from plumbline.operators.linear import cross_products, fold_rmse
from plumbline.operators.neighbors import NearestNeighbors, NeighborModel
from plumbline.operators.splitting import fold_column, require_folds
from plumbline.operators.stats import moments, spread
from plumbline.session import small_frame

FEATURES = "__features"
MAX_DEPTH = UNLIMITED
TREES = ("random_forest", "gradient_boosting", "xgboost", "decision_tree")
LINEAR = ("linear_regression", "ridge", "lasso", "elastic_net")

# The registered models and their default parameters.
DEFAULTS: dict[str, dict[str, Any]] = {
    "linear_regression": {},
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 1.0},
    "elastic_net": {"alpha": 1.0, "l1_ratio": 0.5},
    "random_forest": {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1, "min_samples_split": 2, "max_features": "all"},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0},
    "xgboost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample": 0.8, "reg_alpha": 0.0, "reg_lambda": 1.0},
    "decision_tree": {"max_depth": None, "min_samples_leaf": 1, "min_samples_split": 2},
    "svr": {"C": 1.0, "gamma": "scale", "epsilon": 0.1, "components": 128},
    "knn": {"n_neighbors": 5},
}


@dataclass(frozen=True)
class FitContext:
    """What a factory may need to know about the training rows."""

    label: str
    features: list[str]
    n: int
    label_std: float
    seed: int
    feature_vars: tuple[float, ...] = ()
    ids: tuple[str, ...] = ()


def _linear(params: Mapping, ctx: FitContext, reg: float, mix: float) -> LinearRegression:
    return LinearRegression(
        featuresCol=FEATURES,
        labelCol=ctx.label,
        regParam=reg,
        elasticNetParam=mix,
        standardization=False,
        solver="normal",
        maxIter=params.get("max_iter", 1000),
        tol=1e-12,
    )


def make_linear(params, ctx):
    return _linear(params, ctx, 0.0, 0.0)


def make_ridge(params, ctx):
    """``|y - Xw|^2 + alpha |w|^2``: Spark scales the penalty by rows and by the label's deviation."""
    return _linear(params, ctx, params["alpha"] / ctx.n * ctx.label_std, 0.0)


def make_lasso(params, ctx):
    return _linear(params, ctx, params["alpha"], 1.0)


def make_elastic_net(params, ctx):
    l1 = params["alpha"] * params["l1_ratio"]
    l2 = params["alpha"] * (1 - params["l1_ratio"]) * ctx.label_std
    return _linear(params, ctx, l1 + l2, l1 / (l1 + l2) if l1 + l2 else 0.0)


def _trees(kind: str) -> Callable[[Mapping, FitContext], TreeEstimator]:
    return lambda params, ctx: TreeEstimator(kind, params, ctx.features, ctx.label, ctx.ids, ctx.seed)


make_decision_tree, make_random_forest, make_boosting = _trees("tree"), _trees("forest"), _trees("boosted")


def make_kernel(params, ctx):
    return KernelEstimator({**DEFAULTS["svr"], **params}, ctx.features, ctx.label, ctx.ids, ctx.seed)


def make_neighbors(params, ctx):
    return NearestNeighbors(
        k=params["n_neighbors"], features=ctx.features, label=ctx.label, ids=ctx.ids,
        weights=params.get("weights", "uniform"), p=params.get("p", 2),
    )


FACTORIES: dict[str, Callable[[Mapping, FitContext], Any]] = {
    "linear_regression": make_linear,
    "ridge": make_ridge,
    "lasso": make_lasso,
    "elastic_net": make_elastic_net,
    "random_forest": make_random_forest,
    "gradient_boosting": make_boosting,
    "xgboost": make_boosting,
    "decision_tree": make_decision_tree,
    "svr": make_kernel,
    "knn": make_neighbors,
}


@dataclass(frozen=True)
class Regressor:
    """A fitted model with the columns it reads."""

    name: str
    model: Any
    features: list[str]
    label: str

    def transform(self, df: DataFrame, column: str = PREDICTION) -> DataFrame:
        """Adds the prediction: NULL for a row that lacks a feature, whatever the model."""
        if not isinstance(self.model, (KernelModel, NeighborModel, PipelineModel, TreeModel)):
            df = VectorAssembler(inputCols=self.features, outputCol=FEATURES, handleInvalid="keep").transform(df)
        df = self.model.transform(df).drop(FEATURES)
        df = self.complete(df)
        return df if column == PREDICTION else df.withColumnRenamed(PREDICTION, column)

    def complete(self, df: DataFrame) -> DataFrame:
        """NULL in place of the prediction of a row that lacks a feature."""
        complete = F.lit(True)
        for f in self.features:
            complete = complete & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
        return df.withColumn(PREDICTION, F.when(complete, F.col(PREDICTION)))

    def importance(self) -> tuple[str, dict[str, float]] | None:
        """(kind, {feature: importance}), strongest first; None where a model has none."""
        last = self.model.stages[-1] if isinstance(self.model, PipelineModel) else self.model
        if isinstance(last, TreeModel):
            kind, values = "gini_importance", last.importances
        elif hasattr(last, "featureImportances"):
            kind, values = "gini_importance", last.featureImportances.toArray()
        elif hasattr(last, "coefficients") and not isinstance(self.model, PipelineModel):
            kind, values = "coefficient_magnitude", np.abs(last.coefficients.toArray())
        else:
            return None
        pairs = sorted(zip(self.features, map(float, values)), key=lambda p: (-p[1], p[0]))
        return kind, dict(pairs)


def fit_context(df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str] = (), seed: int = 42) -> FitContext:
    """Sizes and deviations of the complete rows, which are those a fit uses."""
    s = moments(df.dropna(subset=[*features, label]), [*features, label])
    variances = tuple((s[f].std_pop or 0.0) ** 2 for f in features)
    return FitContext(label, list(features), s[label].count, s[label].std_pop or 0.0, seed, variances, tuple(ids))


def fit_regressor(name: str, params: Mapping, df: DataFrame, ctx: FitContext, factory=None) -> Regressor:
    """Fit one model. ``df`` may already hold the assembled vectors."""
    estimator = (factory or FACTORIES[name])(params, ctx)
    if FEATURES in df.columns or isinstance(estimator, (KernelEstimator, NearestNeighbors, TreeEstimator)):
        return Regressor(name, estimator.fit(df), list(ctx.features), ctx.label)
    vectors = assembled(df, ctx.features, ctx.label)
    if name in LINEAR:  # one scan
        return Regressor(name, estimator.fit(vectors), list(ctx.features), ctx.label)
    cached = spread(vectors)
    try:
        return Regressor(name, estimator.fit(cached), list(ctx.features), ctx.label)
    finally:
        cached.unpersist()


def assembled(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows with their feature vector."""
    names = [*features, label]
    complete = df.select(*keep, *[c for c in names if c not in keep]).dropna(subset=names)
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(complete)


def squared_error(df: DataFrame, label: str) -> Column:
    return F.avg(F.pow(F.col(label) - F.col(PREDICTION), F.lit(2.0)))


def basic_metrics(y: str | Column, p: str | Column) -> list[Column]:
    """rmse, mae, r2 and mse as aggregates of one pass."""
    y, p = (F.col(c) if isinstance(c, str) else c for c in (y, p))
    e = y - p
    return [
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count(y) * F.var_pop(y))).alias("r2"),
        F.avg(e * e).alias("mse"),
    ]


@dataclass
class TrainResult:
    name: str
    params: dict[str, Any]
    training_time: float = 0.0
    fold_scores: list[float] = field(default_factory=list)
    train: dict[str, float] = field(default_factory=dict)
    test: dict[str, float] = field(default_factory=dict)
    error: str | None = None

    @property
    def cv_rmse(self) -> float | None:
        return float(np.mean(self.fold_scores)) if self.fold_scores else None

    @property
    def cv_std(self) -> float | None:
        return float(np.std(self.fold_scores)) if self.fold_scores else None


def cross_validate(
    name: str,
    params: Mapping,
    df: DataFrame,
    features: Sequence[str],
    label: str,
    fold: str,
    folds: int,
    ids: Sequence[str] = (),
    seed: int = 42,
    factory=None,
    parallelism: int = 2,
) -> list[float]:
    """RMSE per fold. Linear models need one pass for all folds, the trees or kernel models of all folds grow together; others are fitted per fold."""
    if name in LINEAR and factory is None:
        parts = cross_products(df, features, label, F.col(fold))
        require_folds(parts, folds)
        return cv_linear(name, params, parts)
    if name in (*TREES, "svr") and factory is None:
        return FACTORIES[name](params, FitContext(label, list(features), 0, 0.0, seed, (), tuple(ids))).fold_rmse(df, fold, folds)
    require_folds([r[0] for r in df.select(fold).distinct().collect()], folds)

    def one(held_out: int) -> float:
        rest = df.filter(F.col(fold) != held_out)
        ctx = fit_context(rest, features, label, ids, seed)
        fitted = fit_regressor(name, params, rest, ctx, factory)
        held = df.filter(F.col(fold) == held_out)
        if FEATURES in df.columns:
            held = held.drop(FEATURES)
        return fitted.transform(held).agg(F.sqrt(squared_error(held, label))).first()[0]

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(one, range(folds)))


def cv_linear(name: str, params: Mapping, parts) -> list[float]:
    sweeps = params.get("max_iter", 10_000)
    if name == "ridge":
        scores = fold_rmse(parts, alpha=params["alpha"])
    elif name == "lasso":
        scores = fold_rmse(parts, l1=params["alpha"], iterations=sweeps)
    elif name == "elastic_net":
        ratio = params["l1_ratio"]
        scores = fold_rmse(parts, l1=params["alpha"] * ratio, l2=params["alpha"] * (1 - ratio), iterations=sweeps)
    else:
        scores = fold_rmse(parts)
    return list(scores.values())


class ModelTrainer:
    """Trains registered models on one frame that has a ``split`` column or a separate test frame.

    ``models_config`` adds or replaces entries: ``{name: {"params": {...}, "factory": callable}}``.
    """

    def __init__(self, models_config: Mapping[str, Mapping] | None = None, cv_folds: int = 5, seed: int = 42, parallelism: int = 2):
        self.cv_folds, self.seed, self.parallelism = cv_folds, seed, parallelism
        self.params = {name: dict(p) for name, p in DEFAULTS.items()}
        self.factories = dict(FACTORIES)
        self.custom: set[str] = set()
        for name, entry in (models_config or {}).items():
            if name not in self.factories and "factory" not in entry:
                raise ValueError(f"model '{name}' needs a factory")
            self.params[name] = {**self.params.get(name, {}), **entry.get("params", {})}
            if "factory" in entry:
                self.factories[name] = entry["factory"]
                self.custom.add(name)
        self.models: dict[str, Regressor] = {}
        self.results: dict[str, TrainResult] = {}

    def _prepared(self, df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str]) -> DataFrame:
        folded = df.withColumn("__fold", fold_column(ids, self.cv_folds, self.seed))
        return spread(assembled(folded, features, label, [*ids, "__fold"]))

    def train_single(
        self, name: str, train: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], test: DataFrame | None = None
    ) -> TrainResult:
        if name not in self.factories:
            raise ValueError(f"model '{name}' is not registered")
        data = self._prepared(train, features, label, ids)
        try:
            return self._train(name, data, list(features), label, ids, test)
        finally:
            data.unpersist()

    def _train(self, name, data, features, label, ids, test) -> TrainResult:
        factory = self.factories[name]
        result = TrainResult(name, self.params[name])
        started = time.monotonic()
        ctx = fit_context(data, features, label, ids, self.seed)
        model = fit_regressor(name, self.params[name], data, ctx, factory)
        result.training_time = time.monotonic() - started
        result.fold_scores = cross_validate(
            name,
            self.params[name],
            data,
            features,
            label,
            "__fold",
            self.cv_folds,
            ids,
            self.seed,
            factory if name in self.custom else None,
            self.parallelism,
        )
        bare = data.drop(FEATURES, "__fold")
        result.train = model.transform(bare).agg(*basic_metrics(label, PREDICTION)).first().asDict()
        if test is not None:
            result.test = model.transform(test).agg(*basic_metrics(label, PREDICTION)).first().asDict()
        self.models[name], self.results[name] = model, result
        return result

    def train_all(
        self,
        train: DataFrame,
        features: Sequence[str],
        label: str,
        ids: Sequence[str],
        test: DataFrame | None = None,
        names: Sequence[str] | None = None,
    ) -> dict[str, TrainResult]:
        """Train several models over one cached frame; a failure becomes a result with ``error``."""
        data = self._prepared(train, features, label, ids)

        def one(name: str) -> tuple[str, TrainResult]:
            try:
                if name not in self.factories:
                    raise ValueError(f"model '{name}' is not registered")
                return name, self._train(name, data, list(features), label, ids, test)
            except Exception as error:  # noqa: BLE001 - reported as a row
                return name, TrainResult(name, self.params.get(name, {}), error=str(error).split("\n")[0])

        try:
            with ThreadPoolExecutor(self.parallelism) as pool:
                return dict(pool.map(one, names or list(self.factories)))
        finally:
            data.unpersist()

    def metric_table(self, spark) -> DataFrame:
        """(model, split, metric, value) of every trained model."""
        return metric_table(spark, self.results.values())

    def compare(self, spark) -> DataFrame:
        return compare_models(self.metric_table(spark))

    def best(self, metric: str = "cv_rmse") -> tuple[str, Regressor]:
        measures = {
            "cv_rmse": lambda r: r.cv_rmse,
            "test_rmse": lambda r: r.test.get("rmse"),
            "test_r2": lambda r: -r.test["r2"] if r.test else None,
        }
        if metric not in measures:
            raise ValueError(f"metric must be one of {tuple(measures)}")
        usable = {n: v for n, r in self.results.items() if (v := measures[metric](r)) is not None}
        if not usable:
            raise ValueError(f"no trained model has {metric}")
        name = min(usable, key=lambda n: (usable[n], n))
        return name, self.models[name]

    def predict(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.models:
            raise ValueError(f"model '{name}' has not been trained")
        return self.models[name].transform(df)

    def importance(self, name: str, spark) -> DataFrame | None:
        if name not in self.models:
            raise ValueError(f"model '{name}' has not been trained")
        found = self.models[name].importance()
        if found is None:
            return None
        return small_frame(spark, list(found[1].items()), "feature string, importance double")


def metric_table(spark, results) -> DataFrame:
    rows: list[tuple[str, str, str, float | None]] = []
    for r in results:
        if r.error:
            continue
        rows.append((r.name, "train", "training_time", r.training_time))
        rows += [(r.name, "cv", "rmse_mean", r.cv_rmse), (r.name, "cv", "rmse_std", r.cv_std)]
        rows += [(r.name, "cv", f"rmse_fold_{i}", s) for i, s in enumerate(r.fold_scores)]
        rows += [(r.name, "train", m, v) for m, v in r.train.items()]
        rows += [(r.name, "test", m, v) for m, v in r.test.items()]
    return small_frame(spark, rows, "model string, split string, metric string, value double")


# Columns of a comparison and the (split, metric) each is read from.
COMPARISON = {
    "cv_rmse_mean": ("cv", "rmse_mean"),
    "cv_rmse_std": ("cv", "rmse_std"),
    "train_rmse": ("train", "rmse"),
    "train_r2": ("train", "r2"),
    "training_time": ("train", "training_time"),
    "test_rmse": ("test", "rmse"),
    "test_r2": ("test", "r2"),
    "test_mae": ("test", "mae"),
}


def compare_models(metrics: DataFrame, order_by: str = "cv_rmse_mean", columns: Mapping[str, tuple[str, str]] = COMPARISON) -> DataFrame:
    """One row per model from a long metric table, best first; empty in, empty out."""
    picked = [
        F.max(F.when((F.col("split") == s) & (F.col("metric") == m), F.col("value"))).alias(name)
        for name, (s, m) in columns.items()
    ]
    return metrics.groupBy("model").agg(*picked).orderBy(F.asc_nulls_last(order_by), "model")


def best_model(metrics: DataFrame) -> DataFrame:
    """(criterion, model, value): least CV and test RMSE, largest test R2; models without them are left out."""
    wide = compare_models(metrics)
    choices = [("cv_rmse", "cv_rmse_mean", 1), ("test_rmse", "test_rmse", 1), ("test_r2", "test_r2", -1)]
    row = wide.agg(
        *[
            F.min(F.when(F.col(c).isNotNull(), F.struct((F.col(c) * sign).alias("v"), F.col("model").alias("m")))).alias(name)
            for name, c, sign in choices
        ]
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("criterion"), F.col(f"{name}.m").alias("model"), (F.col(f"{name}.v") * sign).alias("value")
                    )
                    for name, _, sign in choices
                ]
            )
        )
    ).filter("model IS NOT NULL")
