"""Registered queries: metrics, residual diagnostics, intervals, comparisons and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.columns import row_key
from plumbline.operators import evaluation
from plumbline.operators.stats import spread
from plumbline.plans.frames import (
    ONE_FEATURE_MODELS,
    PRED_SQL,
    REG_IDS,
    Registry,
    pred_frame,
    r,
    reg_split,
    rounded,
    table,
)
from plumbline.plans.model_queries import default_model
from plumbline.plans.profile_queries import histogram_sql
from plumbline.session import small_frame

registry = Registry()

METRIC_SQL = {
    "rmse": "sqrt(avg(e * e))",
    "mae": "avg(abs(e))",
    "r2": "1 - sum(e * e) / (count(*) * var_pop(y_true))",
    "mse": "avg(e * e)",
    "mape": "avg(abs(e) / greatest(abs(y_true), 2.220446049250313e-16)) * 100",
    "max_error": "max(abs(e))",
    "mean_residual": "avg(e)",
    "std_residual": "stddev_pop(e)",
    "q95_error": "quantile_cont(abs(e), 0.95)",
    "q99_error": "quantile_cont(abs(e), 0.99)",
    "adjusted_r2": "1 - (sum(e * e) / (count(*) * var_pop(y_true))) * (count(*) - 1) / (count(*) - 2)",
}
METRICS_SQL = f"met AS (SELECT model, split, count(*) AS n, {', '.join(f'{e} AS {m}' for m, e in METRIC_SQL.items())} FROM preds GROUP BY model, split)"
METRIC_COLUMNS = ", ".join(f"{r(m)} AS {m}" for m in METRIC_SQL)


@registry.add(
    "regression_metrics", f"WITH {PRED_SQL}, {METRICS_SQL} SELECT model, split, n, {METRIC_COLUMNS} FROM met WHERE split = 'test'"
)
def _(spark, d):
    return rounded(evaluation.regression_metrics(pred_frame(spark, d).filter("split = 'test'")))


# The training rows with the largest keys serve as a validation split.
VALIDATION_FROM = 4_000_000_000_000_000


@registry.add(
    "metrics_by_split",
    f"""WITH {PRED_SQL.replace("AS model, split,", f"AS model, CASE WHEN row_key >= {VALIDATION_FROM} THEN 'validation' ELSE split END AS split,")},
    {METRICS_SQL} SELECT model, split, n, {METRIC_COLUMNS} FROM met""",
)
def _(spark, d):
    later = row_key(*REG_IDS) >= F.lit(VALIDATION_FROM)
    split = F.when(later, F.lit("validation")).otherwise(F.col("split"))
    return rounded(evaluation.regression_metrics(pred_frame(spark, d).withColumn("split", split)))


def _test_preds(spark, d):
    return pred_frame(spark, d).filter("split = 'test'")


@registry.add(
    "residual_moments",
    f"""WITH {PRED_SQL}, t AS (SELECT model, avg(e) AS mean, stddev_pop(e) AS std, skewness(e) AS skewness, kurtosis(e) AS kurtosis
         FROM preds WHERE split = 'test' GROUP BY model)
    SELECT model, {r("mean")} AS mean, {r("std")} AS std, {r("skewness")} AS skewness, {r("kurtosis")} AS kurtosis FROM t""",
)
def _(spark, d):
    return rounded(evaluation.residual_moments(_test_preds(spark, d)))


# Jarque-Bera from central moments, on both sides of the check.
JB_SQL = f"""WITH {PRED_SQL}, c AS (SELECT model, avg(e) AS mu, count(*) AS n FROM preds WHERE split = 'test' GROUP BY model),
k AS (SELECT model, any_value(n) AS n, avg(pow(e - mu, 3)) / pow(avg(pow(e - mu, 2)), 1.5) AS g1, avg(pow(e - mu, 4)) / pow(avg(pow(e - mu, 2)), 2) - 3 AS g2
      FROM preds JOIN c USING (model) WHERE split = 'test' GROUP BY model),
jb AS (SELECT model, n / 6 * (g1 * g1 + g2 * g2 / 4) AS jb FROM k)"""


@registry.add(
    "jarque_bera",
    f"{JB_SQL} SELECT model, round(jb, 4) AS statistic, {r('exp(-jb / 2)')} AS p_value, exp(-jb / 2) > 0.05 AS is_normal FROM jb",
)
def _(spark, d):
    return rounded(evaluation.normality(_test_preds(spark, d)), {"statistic": 4})


@registry.add(
    "durbin_watson",
    """WITH t AS (SELECT value - avg(value) OVER () AS e, ts, event_id FROM events),
    l AS (SELECT e, e - lag(e) OVER (ORDER BY ts, event_id) AS step FROM t), w AS (SELECT sum(step * step) / sum(e * e) AS dw FROM l)
    SELECT round(dw, 6) AS statistic, CASE WHEN dw > 1.5 AND dw < 2.5 THEN 'no_autocorr' ELSE 'autocorr_present' END AS interpretation FROM w""",
)
def _(spark, d):
    events = table(spark, d, "events")
    mean = events.agg(F.avg("value")).first()[0]
    return rounded(evaluation.durbin_watson(events, F.col("value") - F.lit(mean), ["ts", "event_id"]))


@registry.add(
    "heteroscedasticity",
    f"""WITH {PRED_SQL}, c AS (SELECT model, corr(y_pred, abs(e)) AS r, count(*) AS n FROM preds WHERE split = 'test' GROUP BY model)
    SELECT model, round(r, 6) AS correlation, round(r * sqrt((n - 2) / (1 - r * r)), 4) AS t FROM c""",
)
def _(spark, d):
    return rounded(evaluation.heteroscedasticity(_test_preds(spark, d)).select("model", "correlation", "t"), {"t": 4})


@registry.add("residual_report")
def _(spark, d):
    preds = spread(_test_preds(spark, d).select("model", *REG_IDS, "y_true", "y_pred"))
    try:
        reports = []
        for model in ONE_FEATURE_MODELS:
            report = evaluation.residual_report(preds.filter(F.col("model") == model), [*REG_IDS, "y_true"])
            reports.append(report.select(F.lit(model).alias("model"), "*"))
        rows = [tuple(row) for report in reports for row in report.collect()]  # one row per model
        return rounded(small_frame(spark, rows, reports[0].schema.simpleString()[7:-1].replace(":", " ")))
    finally:
        preds.unpersist()


@registry.add(
    "predictions_table",
    f"WITH {PRED_SQL} SELECT model, split, l_orderkey, l_linenumber, round(y_true, 10) AS y_true, round(y_pred, 5) AS y_pred FROM preds",
)
def _(spark, d):
    preds = pred_frame(spark, d).select("model", "split", *REG_IDS, "y_true", "y_pred")
    return rounded(preds, {"y_true": 10, "y_pred": 5})


@registry.add(
    "diagnostic_tables",
    f"WITH {PRED_SQL}, err AS (SELECT e AS residual, abs(e) AS abs_error FROM preds WHERE split = 'test' AND model = 'by_price') "
    + histogram_sql("err", ["residual", "abs_error"], 30),
)
def _(spark, d):
    one = _test_preds(spark, d).filter("model = 'by_price'")
    return rounded(evaluation.diagnostic_histograms(one))


COMPARE_COLUMNS = ", ".join(f"round({m}, 6) AS {name}" for name, m in evaluation.COMPARISON.items())


@registry.add(
    "evaluation_compare",
    f"""WITH {PRED_SQL}, {METRICS_SQL} SELECT t.model, {COMPARE_COLUMNS.replace("round(", "round(t.")},
        tr.n AS train_size, t.n AS test_size FROM met t JOIN met tr ON t.model = tr.model AND t.split = 'test' AND tr.split = 'train'""",
)
def _(spark, d):
    return rounded(evaluation.evaluation_compare(evaluation.regression_metrics(pred_frame(spark, d))))


def _forest(spark, d):
    data = reg_split(spark, d)
    return default_model(spark, d, "random_forest"), data.filter("split = 'train'"), data.filter("split = 'test'")


@registry.add("importance_top10")
def _(spark, d):
    return evaluation.importance_top(_forest(spark, d)[0], spark)


@registry.add("model_complexity")
def _(spark, d):
    return evaluation.complexity(_forest(spark, d)[0], spark)


@registry.add("prediction_intervals")
def _(spark, d):
    model, _, test = _forest(spark, d)
    columns = ["prediction", "prediction_std", "lower_bound", "upper_bound", "interval_width"]
    return rounded(evaluation.prediction_intervals(model, test).select(*REG_IDS, *columns))


def _evaluated(spark, d):
    model, train, test = _forest(spark, d)
    evaluator = evaluation.ModelEvaluator([*REG_IDS])
    evaluator.evaluate(model, train, test)
    return evaluator


@registry.add("evaluate_model")
def _(spark, d):
    return _evaluated(spark, d).results["random_forest"]["metrics"]


@registry.add("evaluation_report")
def _(spark, d):
    return _evaluated(spark, d).report("random_forest")
