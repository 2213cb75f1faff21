"""Registered queries: sources, sinks, stored models and the manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators.engineering import FeatureEngineer
from plumbline.operators.regression import DEFAULTS, PREDICTION, basic_metrics, cross_validate, fit_context, fit_regressor
from plumbline.operators.selection import FeatureFlow, FeatureSelector
from plumbline.operators.splitting import fold_column
from plumbline.operators.stats import spread
from plumbline.plans.frames import (
    HOUSE_FEATURES,
    HOUSE_SQL,
    PRED_SQL,
    REG_FEATURES,
    REG_IDS,
    REG_SPLIT_SQL,
    Registry,
    dirty_house,
    house_frame,
    pred_frame,
    r,
    reg_split,
    rounded,
)
from plumbline.plans.cleaning_queries import DIRTY_ALL, DIRTY_FEATURES, PREPARED_SQL
from plumbline.plans.feature_queries import CANDIDATES, WIDE_SQL, f_test_sql
from plumbline.plans.model_queries import BASIC_SQL, OLS2_TRAIN_SQL, default_model, model_mark, stored_model
from plumbline.plans.preprocess import Preprocessor
from plumbline.session import overlapped, scratch_path
from plumbline.sources import artifacts, tables

registry = Registry()
ROUND_HOUSE = ", ".join(f"round({c}, 8) AS {c}" for c in [*HOUSE_FEATURES, "target"])
HOUSE_ALL_SQL = f"WITH {HOUSE_SQL} SELECT row_id, {ROUND_HOUSE} FROM house"


@registry.add("scan_csv", HOUSE_ALL_SQL)
def _(spark, d):
    path = scratch_path(spark, "csv")
    tables.land(house_frame(spark, d), path, "csv")
    return rounded(tables.load(spark, path, "csv", tables.HOUSING_SCHEMA), 8)


@registry.add("scan_columnar", HOUSE_ALL_SQL)
def _(spark, d):
    path = scratch_path(spark, "columnar")
    paths = tables.sink_all(house_frame(spark, d), path)
    features = tables.load(spark, paths["features"], "parquet")
    return rounded(tables.attach_label(features, tables.load(spark, paths["label"], "parquet")), 8)


@registry.add("scan_or_fallback", HOUSE_ALL_SQL)
def _(spark, d):
    path = scratch_path(spark, "fallback")
    return rounded(tables.load(spark, path, "parquet", provider=lambda: house_frame(spark, d)), 8)


@registry.add("land_dataset", HOUSE_ALL_SQL)
def _(spark, d):
    path = scratch_path(spark, "landed")
    tables.land(house_frame(spark, d), path, "orc")
    return rounded(tables.load(spark, path, "orc"), 8)


@registry.add(
    "sink_multi_format",
    "SELECT a AS artifact, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES ('combined_csv'), ('features'), ('label')) v(a)",
)
def _(spark, d):
    paths = tables.sink_all(house_frame(spark, d), scratch_path(spark, "sink"))
    formats = {"combined_csv": ("csv", tables.HOUSING_SCHEMA), "features": ("parquet", None), "label": ("parquet", None)}
    parts = [
        tables.load(spark, paths[name], fmt, schema).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("artifact"), "n_rows")
        for name, (fmt, schema) in formats.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registry.add(
    "dataset_info",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'double' AS dtype, '{text}' AS description, count(*) AS n_samples, 8::BIGINT AS n_features FROM orders"
        for c, text in tables.HOUSING_COLUMNS.items()
    ),
)
def _(spark, d):
    return tables.dataset_info(house_frame(spark, d, label=False), tables.HOUSING_COLUMNS, exclude=("row_id",))


@registry.add(
    "split_features_label",
    f"""WITH {HOUSE_SQL} SELECT 'features' AS part, count(*) AS n_rows, 9::BIGINT AS n_columns, round(avg(MedInc), 8) AS mean FROM house
    UNION ALL SELECT 'label', count(*), 2, round(avg(target), 8) FROM house""",
)
def _(spark, d):
    features, label = tables.split_features_label(house_frame(spark, d))

    def summary(df, name, column):
        width = F.lit(len(df.columns)).cast("bigint")
        return df.agg(F.count("*").alias("n_rows"), F.avg(column).alias("mean")).select(
            F.lit(name).alias("part"), "n_rows", width.alias("n_columns"), "mean"
        )

    return rounded(summary(features, "features", "MedInc").unionByName(summary(label, "label", "target")), 8)


@registry.add("attach_label", HOUSE_ALL_SQL)
def _(spark, d):
    labels = house_frame(spark, d).select("row_id", "target")
    return rounded(tables.attach_label(house_frame(spark, d, label=False), labels), 8)


RESULT_DDL = "model string, split string, rmse double, mae double, r2 double, mse double"
RESULT_SQL = (
    f"WITH {PRED_SQL}, b AS (SELECT model, split, {BASIC_SQL} FROM preds GROUP BY model, split) "
    "SELECT model, split, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, round(mse, 6) AS mse FROM b"
)


def _stored_results(spark, d) -> str:
    path = scratch_path(spark, "results")
    artifacts.save_results(pred_frame(spark, d).groupBy("model", "split").agg(*basic_metrics("y_true", "y_pred")), path)
    return path


@registry.add("sink_json_results", f"SELECT count(*) AS n_results, count(DISTINCT model) AS n_models FROM ({RESULT_SQL})")
def _(spark, d):
    stored = spark.read.schema(RESULT_DDL).json(_stored_results(spark, d))
    return stored.agg(F.count("*").alias("n_results"), F.count_distinct("model").alias("n_models"))


@registry.add("scan_json_results", RESULT_SQL)
def _(spark, d):
    return rounded(artifacts.load_results(spark, _stored_results(spark, d), RESULT_DDL))


def _published(spark, d, names=tuple(DEFAULTS)):
    """Publish the default models and a manifest of their scores, unless another process has; return (manifest path, test rows)."""
    data = reg_split(spark, d)
    test = data.filter("split = 'test'")

    def build(path: str) -> None:
        columns = [*REG_IDS, *REG_FEATURES, "label", "split", fold_column(REG_IDS).alias("fold")]
        kept = spread(data.select(*columns))  # the join is made once, for all models
        train, held = (kept.filter(F.col("split") == s).drop("split") for s in ("train", "test"))

        def row(name: str) -> tuple:
            stored = stored_model(spark, d, name, train)
            folds = cross_validate(name, DEFAULTS[name], train, REG_FEATURES, "label", "fold", 5, REG_IDS)
            scores = default_model(spark, d, name).transform(held).agg(*basic_metrics("label", PREDICTION)).first()
            return name, stored, sum(folds) / len(folds), scores["rmse"], scores["r2"], REG_FEATURES, REG_FEATURES

        try:
            rows = overlapped(row, names)
        finally:
            kept.unpersist()
        artifacts.write_manifest(spark, path, rows)

    return artifacts.published(spark, f"manifest-{'-'.join(names)}", model_mark(spark, d), build), test


@registry.add("model_manifest")
def _(spark, d):
    return rounded(artifacts.read_manifest(spark, _published(spark, d)[0]).drop("path"))


@registry.add("load_all_models")
def _(spark, d):
    manifest, test = _published(spark, d)
    scored = test
    models = artifacts.load_all(spark, manifest)
    for name, model in models.items():
        scored = model.transform(scored, f"pred_{name}")
    return rounded(scored.select(*REG_IDS, *[f"pred_{name}" for name in sorted(models)]))


@registry.add("required_artifacts_check", "SELECT 'random_forest' AS model UNION ALL SELECT 'xgboost'")
def _(spark, d):
    manifest = artifacts.read_manifest(spark, _published(spark, d, ("linear_regression", "ridge"))[0])
    return artifacts.missing_artifacts(spark, manifest, ["linear_regression", "random_forest", "xgboost"])


@registry.add(
    "persist_model",
    f"""WITH {REG_SPLIT_SQL}, {OLS2_TRAIN_SQL}
    SELECT l_orderkey, l_linenumber, round(my - wa * ma - wb * mb + wa * l_quantity + wb * p_retailprice, 5) AS prediction
    FROM s, w WHERE split = 'test'""",
)
def _(spark, d):
    data = reg_split(spark, d)
    train = data.filter("split = 'train'")
    ctx = fit_context(train, ["l_quantity", "p_retailprice"], "label", REG_IDS)
    path = scratch_path(spark, "model")
    artifacts.save_model(fit_regressor("linear_regression", DEFAULTS["linear_regression"], train, ctx), path)
    loaded = artifacts.load_model(spark, path)
    return rounded(loaded.transform(data.filter("split = 'test'")).select(*REG_IDS, PREDICTION), 5)


@registry.add(
    "persist_preprocessor",
    f"SELECT row_id, {', '.join([*DIRTY_ALL, *[f'{c}_scaled' for c in DIRTY_FEATURES]])} FROM ({PREPARED_SQL})",
)
def _(spark, d):
    dirty = dirty_house(spark, d)
    prepared = Preprocessor().run(dirty, ["row_id"], "target")
    path = scratch_path(spark, "preprocessor")
    artifacts.save_fitted(spark, path, imputer=prepared.imputer, capper=prepared.capper, scaler=prepared.scaler)
    parts = artifacts.load_fitted(spark, path)
    for name in ("imputer", "capper", "scaler"):
        dirty = parts[name].transform(dirty)
    return rounded(dirty, 8)


@registry.add(
    "persist_feature_flow",
    f"""WITH {WIDE_SQL}, {f_test_sql('wide', CANDIDATES, 'target')},
    long AS ({" UNION ALL ".join(f"SELECT row_id, '{c}' AS feature, {c}::DOUBLE AS value FROM wide" for c in CANDIDATES)})
    SELECT row_id, feature, {r("value")} AS value FROM long JOIN f USING (feature) WHERE rank <= 5""",
)
def _(spark, d):
    house = house_frame(spark, d)
    flow = FeatureFlow(FeatureEngineer(), FeatureSelector("f_test", 5, ["row_id"]), ("row_id",))
    path = scratch_path(spark, "features")
    artifacts.save_fitted(spark, path, flow=flow.fit(house, "target", HOUSE_FEATURES))
    selected = artifacts.load_fitted(spark, path)["flow"].transform(house)
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in selected.columns[1:]]
    return rounded(selected.select("row_id", F.inline(F.array(*cells))))
