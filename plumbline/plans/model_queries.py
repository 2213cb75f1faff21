"""Registered queries: regressors, training, cross-validation and hyper-parameter search."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import regression, tuning
from plumbline.operators.linear import cross_products
from plumbline.operators.neighbors import NearestNeighbors
from plumbline.operators.regression import PREDICTION, ModelTrainer, basic_metrics, cv_linear, fit_context, fit_regressor
from plumbline.operators.splitting import fold_column, test_flag
from plumbline.plans.frames import (
    ONE_FEATURE_MODELS,
    PRED_SQL,
    REG_FEATURES,
    REG_IDS,
    REG_SPLIT_SQL,
    REG_SQL,
    TEST_KEYS,
    Registry,
    pred_frame,
    reg_frame,
    reg_split,
    rounded,
    sql_key,
    table,
)
from plumbline.session import small_frame
from plumbline.sources import artifacts

registry = Registry()

def model_mark(spark, d) -> str:
    """The fingerprint that models fitted to the training tables are published under."""
    return artifacts.fingerprint([table(spark, d, name) for name in ("lineitem", "part")], d, REG_FEATURES, regression.DEFAULTS)


def stored_model(spark, d, name, train=None) -> str:
    """Where the registered model with its defaults is published, fitted to the training rows by the first process that asks.

    A caller that holds these rows gives them, so that they are not made again.
    """

    def build(path: str) -> None:
        rows = reg_split(spark, d).filter("split = 'train'") if train is None else train
        ctx = fit_context(rows, REG_FEATURES, "label", REG_IDS)
        artifacts.save_model(fit_regressor(name, regression.DEFAULTS[name], rows, ctx), path)

    return artifacts.published(spark, f"model-{name}", model_mark(spark, d), build)


def default_model(spark, d, name):
    return artifacts.load_model(spark, stored_model(spark, d, name))


def _terms(spark, regressor):
    model = regressor.model
    rows = [("intercept", float(model.intercept)), *zip(regressor.features, map(float, model.coefficients))]
    return rounded(small_frame(spark, rows, "term string, value double"), 5)


def _linear(spark, d, name, features, **params):
    df = reg_frame(spark, d)
    ctx = fit_context(df, features, "label", REG_IDS)
    return _terms(spark, fit_regressor(name, {**regression.DEFAULTS[name], **params}, df, ctx))


# Two-feature least squares through Cramer's rule.
OLS2_SQL = """m AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_quantity, p_retailprice) AS ab,
          covar_pop(p_retailprice, p_retailprice) AS bb, covar_pop(l_quantity, label) AS ay, covar_pop(p_retailprice, label) AS byy,
          avg(l_quantity) AS ma, avg(p_retailprice) AS mb, avg(label) AS my FROM {source}),
w AS (SELECT (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb, * FROM m)"""


@registry.add(
    "ml_linear",
    f"""WITH {REG_SQL}, {OLS2_SQL.format(source="reg")}
    SELECT 'intercept' AS term, round(my - wa * ma - wb * mb, 5) AS value FROM w
    UNION ALL SELECT 'l_quantity', round(wa, 5) FROM w UNION ALL SELECT 'p_retailprice', round(wb, 5) FROM w""",
)
def _(spark, d):
    return _linear(spark, d, "linear_regression", ["l_quantity", "p_retailprice"])


def one_feature_sql(l1: str, l2: str) -> str:
    """Closed form of a penalised fit on l_quantity."""
    return f"""WITH {REG_SQL}, m AS (SELECT covar_pop(l_quantity, label) AS c, var_pop(l_quantity) AS v, count(*) AS n, avg(l_quantity) AS mx, avg(label) AS my FROM reg),
    w AS (SELECT sign(c) * greatest(abs(c) - {l1}, 0) / (v + {l2}) AS w, mx, my FROM m)
    SELECT 'l_quantity' AS term, round(w, 5) AS value FROM w UNION ALL SELECT 'intercept', round(my - w * mx, 5) FROM w"""


@registry.add("ml_ridge", one_feature_sql("0", "100.0::DOUBLE / n"))
def _(spark, d):
    return _linear(spark, d, "ridge", ["l_quantity"], alpha=100.0)


@registry.add("ml_lasso", one_feature_sql("1.0::DOUBLE", "0"))
def _(spark, d):
    return _linear(spark, d, "lasso", ["l_quantity"])


@registry.add("ml_elastic_net", one_feature_sql("0.5::DOUBLE", "0.5::DOUBLE"))
def _(spark, d):
    return _linear(spark, d, "elastic_net", ["l_quantity"])


def _fit_and_measure(spark, d, name):
    test = reg_split(spark, d).filter("split = 'test'")
    fitted = default_model(spark, d, name)
    return rounded(fitted.transform(test).agg(*basic_metrics("label", PREDICTION)).withColumn("model", F.lit(name)))


for _key, _name in {
    "ml_random_forest": "random_forest",
    "ml_gbt": "gradient_boosting",
    "ml_boosted_subsample": "xgboost",
    "ml_decision_tree": "decision_tree",
    "ml_kernel": "svr",
}.items():
    registry.add(_key)(lambda spark, d, name=_name: _fit_and_measure(spark, d, name))


@registry.add(
    "ml_knn",
    f"""WITH p AS (SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice / 10 AS b, (p_partkey % 13)::DOUBLE AS y, {sql_key("p_partkey")} < {TEST_KEYS} AS is_test FROM part),
    near AS (SELECT q.p_partkey, t.y, row_number() OVER (PARTITION BY q.p_partkey ORDER BY (q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b), {sql_key("t.p_partkey")}) AS k
             FROM p q, p t WHERE q.is_test AND NOT t.is_test)
    SELECT p_partkey, round(avg(y), 6) AS prediction FROM near WHERE k <= 5 GROUP BY p_partkey""",
)
def _(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("a"),
        (F.col("p_retailprice") / 10).alias("b"),
        (F.col("p_partkey") % 13).cast("double").alias("y"),
    )
    is_test = test_flag(["p_partkey"])
    model = NearestNeighbors(5, ["a", "b"], "y", ["p_partkey"]).fit(parts.filter(~is_test))
    return rounded(model.transform(parts.filter(is_test)).select("p_partkey", "prediction"))


@registry.add("train_single")
def _(spark, d):
    data = reg_split(spark, d)
    trainer = ModelTrainer()
    trainer.train_single(
        "decision_tree", data.filter("split = 'train'"), REG_FEATURES, "label", REG_IDS, data.filter("split = 'test'")
    )
    return trainer.metric_table(spark)


@registry.add("train_all")
def _(spark, d):
    data = reg_split(spark, d)
    trainer = ModelTrainer()
    results = trainer.train_all(
        data.filter("split = 'train'"),
        REG_FEATURES,
        "label",
        REG_IDS,
        data.filter("split = 'test'"),
        [*regression.DEFAULTS, "unregistered"],
    )
    rows = [(x.name, x.cv_rmse, x.test.get("rmse"), x.test.get("r2"), x.error) for x in results.values()]
    return small_frame(spark, rows, "model string, cv_rmse double, test_rmse double, test_r2 double, error string")


def cv_fold_sql(model: str, feature: str) -> str:
    """RMSE per fold of the one-feature fit to the other folds."""
    return f"""SELECT '{model}' AS model, s.fold, sqrt(avg(pow(label - a - b * {feature}, 2))) AS rmse
    FROM s JOIN (SELECT f.fold AS fold, regr_intercept(label, {feature}) AS a, regr_slope(label, {feature}) AS b
                 FROM s, (SELECT DISTINCT fold FROM s) f WHERE s.fold <> f.fold GROUP BY f.fold) c ON s.fold = c.fold GROUP BY s.fold"""


@registry.add(
    "cv_kfold", f"WITH {REG_SPLIT_SQL} SELECT fold::BIGINT AS fold, round(rmse, 6) AS rmse FROM ({cv_fold_sql('one', 'l_quantity')})"
)
def _(spark, d):
    parts = cross_products(reg_frame(spark, d), ["l_quantity"], "label", fold_column(REG_IDS))
    scores = cv_linear("linear_regression", {}, parts)
    return rounded(small_frame(spark, list(zip(sorted(parts), scores)), "fold bigint, rmse double"))


BASIC_SQL = """sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - sum(e * e) / (count(*) * var_pop(y_true)) AS r2, avg(e * e) AS mse"""


@registry.add(
    "basic_metrics",
    f"WITH {PRED_SQL}, b AS (SELECT model, split, {BASIC_SQL} FROM preds GROUP BY model, split) "
    "SELECT model, split, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, round(mse, 6) AS mse FROM b",
)
def _(spark, d):
    return rounded(pred_frame(spark, d).groupBy("model", "split").agg(*basic_metrics("y_true", "y_pred")))


def _one_feature_metrics(spark, d):
    """(model, split, metric, value) of the one-feature models with their cross-validation."""
    measured = pred_frame(spark, d).groupBy("model", "split").agg(*basic_metrics("y_true", "y_pred"))
    names = ["rmse", "mae", "r2", "mse"]
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names]
    long = measured.select("model", "split", F.inline(F.array(*cells)))
    data = reg_frame(spark, d)
    rows = []
    for model, feature in ONE_FEATURE_MODELS.items():
        scores = cv_linear("linear_regression", {}, cross_products(data, [feature], "label", fold_column(REG_IDS)))
        mean = sum(scores) / len(scores)
        spread = (sum((x - mean) ** 2 for x in scores) / len(scores)) ** 0.5
        rows += [(model, "cv", "rmse_mean", mean), (model, "cv", "rmse_std", spread)]
    return long.unionByName(small_frame(spark, rows, "model string, split string, metric string, value double"))


CV_SQL = f"""cv AS (SELECT model, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse FROM
  ({" UNION ALL ".join(cv_fold_sql(m, f) for m, f in ONE_FEATURE_MODELS.items())}) GROUP BY model),
basic AS (SELECT model, split, {BASIC_SQL} FROM preds GROUP BY model, split),
cmp AS (SELECT model, mean_rmse AS cv_rmse_mean, std_rmse AS cv_rmse_std, tr.rmse AS train_rmse, tr.r2 AS train_r2,
         te.rmse AS test_rmse, te.r2 AS test_r2, te.mae AS test_mae
  FROM cv JOIN (SELECT * FROM basic WHERE split = 'train') tr USING (model) JOIN (SELECT * FROM basic WHERE split = 'test') te USING (model))"""
COMPARED = ["cv_rmse_mean", "cv_rmse_std", "train_rmse", "train_r2", "test_rmse", "test_r2", "test_mae"]


@registry.add(
    "model_compare", f"WITH {PRED_SQL}, {CV_SQL} SELECT model, {', '.join(f'round({c}, 6) AS {c}' for c in COMPARED)} FROM cmp"
)
def _(spark, d):
    return rounded(regression.compare_models(_one_feature_metrics(spark, d)).drop("training_time"))


@registry.add(
    "best_model",
    f"""WITH {PRED_SQL}, {CV_SQL}
    (SELECT 'cv_rmse' AS criterion, model, round(cv_rmse_mean, 6) AS value FROM cmp ORDER BY cv_rmse_mean LIMIT 1)
    UNION ALL (SELECT 'test_rmse', model, round(test_rmse, 6) FROM cmp ORDER BY test_rmse LIMIT 1)
    UNION ALL (SELECT 'test_r2', model, round(test_r2, 6) FROM cmp ORDER BY test_r2 DESC LIMIT 1)""",
)
def _(spark, d):
    return rounded(regression.best_model(_one_feature_metrics(spark, d)))


OLS2_TRAIN_SQL = OLS2_SQL.format(source="s WHERE split = 'train'")


@registry.add(
    "predict",
    f"""WITH {REG_SPLIT_SQL}, {OLS2_TRAIN_SQL}
    SELECT l_orderkey, l_linenumber, round(my - wa * ma - wb * mb + wa * l_quantity + wb * p_retailprice, 5) AS prediction
    FROM s, w WHERE split = 'test'""",
)
def _(spark, d):
    data = reg_split(spark, d)
    train = data.filter("split = 'train'")
    ctx = fit_context(train, ["l_quantity", "p_retailprice"], "label", REG_IDS)
    model = fit_regressor("linear_regression", {}, train, ctx)
    return rounded(model.transform(data.filter("split = 'test'")).select(*REG_IDS, PREDICTION), 5)


@registry.add(
    "model_importance",
    f"""WITH {REG_SPLIT_SQL}, {OLS2_TRAIN_SQL}
    SELECT 'l_quantity' AS feature, round(abs(wa), 5) AS importance FROM w UNION ALL SELECT 'p_retailprice', round(abs(wb), 5) FROM w""",
)
def _(spark, d):
    train = reg_split(spark, d).filter("split = 'train'")
    ctx = fit_context(train, ["l_quantity", "p_retailprice"], "label", REG_IDS)
    _, scores = fit_regressor("linear_regression", {}, train, ctx).importance()
    return rounded(small_frame(spark, list(scores.items()), "feature string, importance double"), 5)


# Penalised one-feature fits for every setting and fold, in closed form (which no number of sweeps changes).
LASSO_ALPHAS = [a for a in tuning.GRIDS["lasso"]["alpha"] for _ in tuning.GRIDS["lasso"]["max_iter"]]
GRID_SQL = f"""f AS (SELECT DISTINCT fold AS held FROM s),
m AS (SELECT held, covar_pop(l_quantity, label) AS c, var_pop(l_quantity) AS v, count(*) AS n, avg(l_quantity) AS mx, avg(label) AS my
      FROM s, f WHERE fold <> held GROUP BY held),
setting AS (SELECT 'ridge' AS model, unnest(range(5)) AS trial, unnest({tuning.GRIDS["ridge"]["alpha"]!r}::DOUBLE[]) AS alpha
  UNION ALL SELECT 'lasso', unnest(range({len(LASSO_ALPHAS)})), unnest({LASSO_ALPHAS!r}::DOUBLE[])),
fit AS (SELECT model, trial, alpha, held, mx, my, CASE WHEN model = 'ridge' THEN c / (v + alpha / n)
               ELSE sign(c) * greatest(abs(c) - alpha, 0) / v END AS w FROM m, setting),
score AS (SELECT model, trial, alpha, held AS fold, avg(pow(label - my - w * (l_quantity - mx), 2)) AS mse
          FROM fit JOIN s ON s.fold = held GROUP BY ALL),
mean AS (SELECT model, trial, alpha, avg(mse) AS mean_mse, stddev_pop(mse) AS std_mse, count(*) AS fits FROM score GROUP BY ALL)"""


def _alpha():
    return F.get_json_object("params", "$.alpha").cast("double").alias("alpha")


def _searches(spark, d, *models):
    tuner = tuning.HyperparameterTuner(["l_quantity"], "label", REG_IDS)
    data = reg_frame(spark, d)
    for model in models:
        tuner.grid_search(model, data)
    return tuner


@registry.add(
    "tune_grid",
    f"WITH {REG_SPLIT_SQL}, {GRID_SQL} SELECT trial, alpha, fold::BIGINT AS fold, round(sqrt(mse), 6) AS rmse FROM score WHERE model = 'ridge'",
)
def _(spark, d):
    trials = _searches(spark, d, "ridge").trials(spark)
    return rounded(trials.select("trial", _alpha(), "fold", "rmse"))


@registry.add("tune_grid_trees")
def _(spark, d):
    tuner = tuning.HyperparameterTuner(REG_FEATURES, "label", REG_IDS)
    tuner.grid_search("decision_tree", reg_frame(spark, d))
    return rounded(tuning.per_setting(tuner.trials(spark)))


@registry.add("tune_random")
def _(spark, d):
    tuner = tuning.HyperparameterTuner(REG_FEATURES, "label", REG_IDS)
    tuner.random_search("elastic_net", reg_frame(spark, d))
    return rounded(tuning.per_setting(tuner.trials(spark)))


@registry.add("tune_adaptive")
def _(spark, d):
    tuner = tuning.HyperparameterTuner(REG_FEATURES, "label", REG_IDS)
    tuner.adaptive_search("ridge", reg_frame(spark, d))
    return rounded(tuning.per_setting(tuner.trials(spark)))


@registry.add(
    "tune_trial_log",
    f"""WITH {REG_SPLIT_SQL}, {GRID_SQL} SELECT model, trial, alpha, round(mean_mse, 6) AS mean_mse, round(std_mse, 6) AS std_mse,
        round(sqrt(mean_mse), 6) AS rmse, fits FROM mean""",
)
def _(spark, d):
    settings = tuning.per_setting(_searches(spark, d, "ridge", "lasso").trials(spark))
    return rounded(settings.select("model", "trial", _alpha(), "mean_mse", "std_mse", "rmse", "fits"))


@registry.add(
    "tune_compare",
    f"""WITH {REG_SPLIT_SQL}, {GRID_SQL} SELECT model || '_grid_search' AS experiment, model, 'grid_search' AS method,
        round(sqrt(min(mean_mse)), 6) AS best_rmse, round(min(mean_mse), 6) AS best_mse, arg_min(alpha, mean_mse) AS best_alpha,
        sum(fits)::BIGINT AS total_fits FROM mean GROUP BY model""",
)
def _(spark, d):
    compared = tuning.compare_studies(_searches(spark, d, "ridge", "lasso").trials(spark))
    best = F.get_json_object("best_params", "$.alpha").cast("double")
    return rounded(compared.withColumn("best_alpha", best).drop("best_params"))


@registry.add(
    "tune_best_params",
    f"""WITH {REG_SPLIT_SQL}, {GRID_SQL}, b AS (SELECT model, arg_min(alpha, mean_mse) AS alpha, round(sqrt(min(mean_mse)), 6) AS rmse FROM mean GROUP BY model)
    SELECT model, m AS method, alpha, rmse FROM b, (VALUES ('grid_search'), ('any')) v(m)""",
)
def _(spark, d):
    best = tuning.best_params(_searches(spark, d, "ridge", "lasso").trials(spark))
    return rounded(best.select("model", "method", _alpha(), "rmse"))
