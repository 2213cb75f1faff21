"""Evaluation of predictions: metrics, residual diagnostics, intervals, comparisons, reports.

The predictions table is long: ``model, split, y_true, y_pred`` and the row ids. It
is never collected; every number below comes from grouped aggregates over it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.moments import adjusted_kurtosis, adjusted_skewness, jarque_bera, pearson, student_t_two_sided
from plumbline.operators.explore import histogram, scatter_sample
from plumbline.operators.forest import TreeModel
from plumbline.operators.regression import PREDICTION, Regressor
from plumbline.operators.stats import quantiles, spread
from plumbline.session import small_frame

COMPLEXITY_DDL = (
    "model string, model_type string, n_parameters bigint, n_estimators bigint, max_depth bigint, n_nodes bigint, n_features bigint"
)
MACHINE_EPSILON = 2.220446049250313e-16
METRICS = (
    "rmse mae r2 mse mape max_error mean_residual std_residual q95_error q99_error adjusted_r2".split()
)
# Columns of an evaluation comparison and the metric each is read from.
COMPARISON = {
    "test_rmse": "rmse",
    "test_mae": "mae",
    "test_r2": "r2",
    "test_mape": "mape",
    "max_error": "max_error",
    "q95_error": "q95_error",
}


def residual() -> Column:
    return F.col("y_true") - F.col("y_pred")


def predictions(model: Regressor, frames: Mapping[str, DataFrame], ids: Sequence[str] = ()) -> DataFrame:
    """(model, split, ids, y_true, y_pred) for every given split."""
    parts = [
        model.transform(df).select(
            F.lit(model.name).alias("model"),
            F.lit(split).alias("split"),
            *ids,
            F.col(model.label).cast("double").alias("y_true"),
            F.col(PREDICTION).alias("y_pred"),
        )
        for split, df in frames.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def regression_metrics(preds: DataFrame, keys: Sequence[str] = ("model", "split"), p: int = 1) -> DataFrame:
    """The eleven metrics of every group. Error quantiles are exact and found for all groups together.

    Rows without a prediction or a label are left out: ``n`` is the number of rows that are measured.
    """
    spark = preds.sparkSession
    held = preds.storageLevel.useMemory or preds.storageLevel.useDisk
    # Read once for the aggregates and a few times for the quantiles: kept unless the caller keeps it.
    preds = preds if held else spread(preds.select(*keys, "y_true", "y_pred"))
    try:
        return small_frame(spark, *_metric_rows(preds, keys, p))
    finally:
        if not held:
            preds.unpersist()


def _metric_rows(preds: DataFrame, keys: Sequence[str], p: int) -> tuple[list[tuple], str]:
    e = residual()
    y = F.when(e.isNotNull(), F.col("y_true"))
    wide = preds.groupBy(*keys).agg(
        F.count(e).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count(e) * F.var_pop(y))).alias("r2"),
        F.avg(e * e).alias("mse"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(MACHINE_EPSILON))) * 100).alias("mape"),
        F.max(F.abs(e)).alias("max_error"),
        F.avg(e).alias("mean_residual"),
        F.stddev_pop(e).alias("std_residual"),
    )
    rows = wide.collect()  # one row per model and split
    groups = {str(i): r for i, r in enumerate(rows)}

    position = F.lit(None).cast("int")
    for g, r in groups.items():  # rows without an error have no rank
        test = F.lit(True)
        for k in keys:
            test = test & F.col(k).eqNullSafe(F.lit(r[k]))
        position = F.when(test, F.lit(int(g))).otherwise(position)
    sizes = {g: r["n"] for g, r in groups.items()}
    cut = quantiles(preds, {g: F.abs(e) for g in groups}, (0.95, 0.99), sizes, group=position)
    out = []
    for g, r in groups.items():
        values = {**r.asDict(), "q95_error": cut[g][0.95], "q99_error": cut[g][0.99]}
        rest = r["n"] - p - 1
        values["adjusted_r2"] = None if r["r2"] is None or rest <= 0 else 1 - (1 - r["r2"]) * (r["n"] - 1) / rest
        out.append((*[str(r[k]) for k in keys], r["n"], *[values[m] for m in METRICS]))
    ddl = ", ".join([f"{k} string" for k in keys] + ["n bigint"] + [f"{m} double" for m in METRICS])
    return out, ddl


def residual_moments(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    e = residual()
    return preds.withColumn("e", e).groupBy(*keys).agg(
        F.avg("e").alias("mean"),
        F.stddev_pop("e").alias("std"),
        adjusted_skewness("e").alias("skewness"),
        adjusted_kurtosis("e").alias("kurtosis"),
    )


def normality(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Jarque-Bera; its chi-square with two degrees of freedom has the closed tail ``exp(-x/2)``."""
    tested = preds.withColumn("e", residual()).groupBy(*keys).agg(jarque_bera("e").alias("statistic"))
    p = F.exp(-F.col("statistic") / 2)
    return tested.select(*keys, "statistic", p.alias("p_value"), (p > 0.05).alias("is_normal"))


def heteroscedasticity(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Correlation of predictions with absolute residuals, its t statistic and p value."""
    spark = preds.sparkSession
    rows = []
    measured = preds.groupBy(*keys).agg(pearson("y_pred", F.abs(residual())).alias("r"), F.count(residual()).alias("n"))
    for row in measured.collect():  # one row per group
        r, n = row["r"], row["n"]
        known = r is not None and n > 2 and abs(r) < 1
        t = r * math.sqrt((n - 2) / (1 - r * r)) if known else None
        p = student_t_two_sided(t, n - 2) if known else None
        rows.append((*[str(row[k]) for k in keys], r, t, p, None if p is None else p > 0.05))
    ddl = ", ".join([f"{k} string" for k in keys]) + ", correlation double, t double, p_value double, is_homoscedastic boolean"
    return small_frame(spark, rows, ddl)


def durbin_watson(df: DataFrame, value: Column, order_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Sum of squared steps over sum of squares, along an explicit order.

    One range shuffle puts neighbours together (any number of equal leading keys is
    spread by the remaining order columns). Each task walks its sorted run batch by
    batch and returns one row; the steps between runs are added from their ends.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = (
        df.select(*order_by, value.cast("double").alias("__e"))
        .filter(F.col("__e").isNotNull())
        .repartitionByRange(n, *order_by)
        .sortWithinPartitions(*order_by)
        .select(F.spark_partition_id().alias("run"), F.col("__e").alias("e"))
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        position, steps, squares = 0, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            position = batch.column(0)[0].as_py()
            e = batch.column(1).to_numpy()
            squares += float(np.dot(e, e))
            if last is not None:
                steps += float((e[0] - last) ** 2)
            d = np.diff(e)
            steps += float(np.dot(d, d))
            first, last = (float(e[0]) if first is None else first), float(e[-1])
        if first is not None:
            yield pa.RecordBatch.from_pydict(
                {"run": pa.array([position], pa.int32()), "first": [first], "last": [last], "steps": [steps], "squares": [squares]}
            )

    runs = run.mapInArrow(walk, "run int, first double, last double, steps double, squares double")
    across = F.pow(F.col("first") - F.lag("last").over(Window.orderBy("run")), F.lit(2.0))  # one row per task
    statistic = F.try_divide(F.sum("steps") + F.coalesce(F.sum("across"), F.lit(0.0)), F.sum("squares"))
    return (
        runs.withColumn("across", across)
        .agg(statistic.alias("statistic"))
        .withColumn(
            "interpretation",
            F.when((F.col("statistic") > 1.5) & (F.col("statistic") < 2.5), F.lit("no_autocorr")).otherwise(
                F.lit("autocorr_present")
            ),
        )
    )


def residual_report(preds: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row with moments, normality, autocorrelation and heteroscedasticity of one model's residuals."""
    one = preds.withColumn("model", F.lit("all"))
    moments_row = residual_moments(one)
    normal = normality(one).withColumnsRenamed({"statistic": "jb", "p_value": "jb_p"})
    spread = heteroscedasticity(one).withColumnRenamed("p_value", "spread_p")
    walk = durbin_watson(preds, residual(), order_by).withColumn("model", F.lit("all"))
    walk = walk.withColumnRenamed("statistic", "durbin_watson")
    return moments_row.join(normal, "model").join(spread, "model").join(walk, "model").drop("model")


def importance_top(model: Regressor, spark, k: int = 10) -> DataFrame:
    """(model, kind, feature, importance, rank) of the ``k`` most important features."""
    kind, scores = model.importance() or ("none", {})
    rows = [(model.name, kind, f, v, i) for i, (f, v) in enumerate(list(scores.items())[:k], start=1)]
    return small_frame(spark, rows, "model string, kind string, feature string, importance double, rank bigint")


def parameter_count(model: Regressor) -> int | None:
    """Linear: coefficients and intercept. Trees: trees times 2^depth, unknown for unlimited depth."""
    last = model.model.stages[-1] if hasattr(model.model, "stages") else model.model
    if isinstance(last, TreeModel):
        return None if last.max_depth is None else last.n_trees * 2**last.max_depth
    if hasattr(last, "coefficients"):
        return int(last.coefficients.size) + 1
    if hasattr(last, "getMaxDepth"):
        trees = last.getNumTrees if hasattr(last, "getNumTrees") else 1
        return None if last.getMaxDepth() >= 30 else int(trees) * 2 ** last.getMaxDepth()
    return None


def complexity(model: Regressor, spark) -> DataFrame:
    last = model.model.stages[-1] if hasattr(model.model, "stages") else model.model
    if isinstance(last, TreeModel):
        trees = None if last.kind == "tree" else last.n_trees
        kind = {"tree": "DecisionTree", "forest": "RandomForest", "boosted": "BoostedTrees"}[last.kind]
        row = (model.name, kind, parameter_count(model), trees, last.max_depth, last.nodes, len(model.features))
        return small_frame(spark, [row], COMPLEXITY_DDL)
    trees = int(last.getNumTrees) if hasattr(last, "getNumTrees") else None
    depth = int(last.getMaxDepth()) if hasattr(last, "getMaxDepth") else None
    nodes = getattr(last, "totalNumNodes", getattr(last, "numNodes", None))
    row = (model.name, type(last).__name__, parameter_count(model), trees, depth, nodes, len(model.features))
    return small_frame(spark, [row], COMPLEXITY_DDL)


def prediction_intervals(model: Regressor, df: DataFrame, confidence: float = 0.95) -> DataFrame | None:
    """Forests: prediction, deviation across trees, bounds and width per row. Others: None.

    Rows are routed through the packed trees, and only the sum of the trees' values and of their squares is kept
    for each row: nothing is shuffled for each tree. A row without a prediction has no deviation.
    """
    if not isinstance(model.model, TreeModel) or model.model.kind != "forest":
        return None
    scored = model.complete(model.model.with_spread(df))
    scored = scored.withColumn("prediction_std", F.when(F.col(PREDICTION).isNotNull(), F.col("prediction_std")))
    z = NormalDist().inv_cdf(1 - (1 - confidence) / 2)
    return (
        scored.withColumn("lower_bound", F.col(PREDICTION) - F.lit(z) * F.col("prediction_std"))
        .withColumn("upper_bound", F.col(PREDICTION) + F.lit(z) * F.col("prediction_std"))
        .withColumn("interval_width", F.lit(2 * z) * F.col("prediction_std"))
    )


def diagnostic_histograms(preds: DataFrame, bins: int = 30) -> DataFrame:
    """Residual and absolute-error histograms of one model's predictions."""
    errors = preds.select(residual().alias("residual"), F.abs(residual()).alias("abs_error"))
    return histogram(errors, ["residual", "abs_error"], bins)


def diagnostic_scatter(preds: DataFrame, ids: Sequence[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """A reproducible sample of (y_true, y_pred, residual) for the two scatter panels."""
    return scatter_sample(preds.withColumn("residual", residual()), ids, ["y_true", "y_pred", "residual"], n, seed)


def evaluation_compare(metrics: DataFrame, complexity_table: DataFrame | None = None, models: Sequence[str] | None = None) -> DataFrame:
    """One row per model from its test metrics with sizes, least RMSE first."""
    chosen = metrics if models is None else metrics.filter(F.col("model").isin(list(models)))
    test = F.col("split") == "test"
    wide = chosen.groupBy("model").agg(
        *[F.max(F.when(test, F.col(m))).alias(name) for name, m in COMPARISON.items()],
        F.max(F.when(F.col("split") == "train", F.col("n"))).alias("train_size"),
        F.max(F.when(test, F.col("n"))).alias("test_size"),
    )
    if complexity_table is not None:
        wide = wide.join(complexity_table.select("model", "n_features", "n_parameters"), "model", "left")
    return wide.orderBy("test_rmse", "model")


def report_table(metrics: DataFrame, residuals: DataFrame, sizes: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """(section, item, value) of everything known about one model."""

    def items(df: DataFrame, section: str, columns: Sequence[str], prefix: Column | None = None) -> DataFrame:
        def cell(c):
            item = F.lit(c) if prefix is None else F.concat(prefix, F.lit("_"), F.lit(c))
            return F.struct(item.alias("item"), F.col(c).cast("string").alias("value"))

        return df.select(F.lit(section).alias("section"), F.inline(F.array(*[cell(c) for c in columns])))

    parts = [
        items(metrics, "metrics", [m for m in METRICS], F.col("split")),
        items(metrics, "dataset", ["n"], F.col("split")),
        items(residuals, "residuals", residuals.columns),
        items(sizes, "complexity", [c for c in sizes.columns if c != "model"]),
    ]
    if importance is not None:
        parts.append(importance.select(F.lit("importance").alias("section"), F.col("feature").alias("item"), F.col("importance").cast("string").alias("value")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def report_text(table: DataFrame) -> str:
    """The report of one model as text, a section per block (a few dozen rows)."""
    lines: list[str] = []
    for row in table.collect():
        if f"[{row['section']}]" not in lines:
            lines.append(f"[{row['section']}]")
        lines.append(f"{row['item']}: {row['value']}")
    return "\n".join(lines)


class ModelEvaluator:
    """Evaluates fitted models over one cached predictions table each, and keeps the results by name."""

    def __init__(self, ids: Sequence[str]):
        self.ids = list(ids)
        self.results: dict[str, dict[str, DataFrame | None]] = {}

    def evaluate(self, model: Regressor, train: DataFrame, test: DataFrame, validation: DataFrame | None = None) -> dict[str, DataFrame | None]:
        spark = train.sparkSession
        frames = {"train": train, "test": test, **({"validation": validation} if validation is not None else {})}
        preds = predictions(model, frames, self.ids)
        cached = spread(preds)
        try:
            on_test = cached.filter(F.col("split") == "test")
            # Ids may repeat; rows that also agree in both values have equal residuals, so their order is immaterial.
            residuals = residual_report(on_test, [*self.ids, "y_true", "y_pred"])
            result = {
                "metrics": regression_metrics(cached),
                "residuals": small_frame(spark, [tuple(residuals.first())], residuals.schema.simpleString()[7:-1].replace(":", " ")),
                "importance": importance_top(model, spark),
                "complexity": complexity(model, spark),
            }
        finally:
            cached.unpersist()
        result["predictions"] = preds
        result["intervals"] = prediction_intervals(model, test)
        self.results[model.name] = result
        return result

    def _known(self, name: str) -> dict:
        if name not in self.results:
            raise ValueError(f"model '{name}' has not been evaluated")
        return self.results[name]

    def compare(self, spark, names: Sequence[str] | None = None) -> DataFrame:
        chosen = [self.results[n] for n in (names or self.results) if n in self.results]
        if not chosen:
            return small_frame(spark, [], "model string, test_rmse double")
        metrics, sizes = chosen[0]["metrics"], chosen[0]["complexity"]
        for r in chosen[1:]:
            metrics, sizes = metrics.unionByName(r["metrics"]), sizes.unionByName(r["complexity"])
        return evaluation_compare(metrics, sizes)

    def report(self, name: str) -> DataFrame:
        r = self._known(name)
        return report_table(r["metrics"], r["residuals"], r["complexity"], r["importance"])

    def report_text(self, name: str) -> str:
        return report_text(self.report(name))

    def save(self, name: str, path: str) -> None:
        """Metrics, residual diagnostics and report as JSON, predictions as Parquet by split."""
        r = self._known(name)
        for part in ("metrics", "residuals", "importance", "complexity"):
            r[part].write.mode("overwrite").json(f"{path}/{name}/{part}")
        r["predictions"].write.mode("overwrite").partitionBy("split").parquet(f"{path}/{name}/predictions")
