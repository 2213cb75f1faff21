"""Registered queries use the registered defaults, not smaller stand-ins."""

import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plumbline.operators import evaluation, selection, tuning
from plumbline.operators.neighbors import NearestNeighbors
from plumbline.operators.regression import DEFAULTS, MAX_DEPTH, Regressor, fit_context, fit_regressor
from plumbline.plans import evaluation_queries, feature_queries, model_queries, scoring_queries, storage_queries
from plumbline.session import overlapped
from plumbline.sources import artifacts


def test_stored_default_is_deep_and_fitted_once(spark, sf):
    path = model_queries.stored_model(spark, sf, "decision_tree")
    assert model_queries.stored_model(spark, sf, "decision_tree") == path
    model = model_queries.default_model(spark, sf, "decision_tree").model
    assert model.getMaxDepth() == MAX_DEPTH and model.depth > 8


def test_queries_fit_the_defaults(spark, sf, monkeypatch):
    asked = {}

    def fit(name, params, df, ctx):
        asked[name] = dict(params)
        raise InterruptedError

    monkeypatch.setattr(model_queries, "fit_regressor", fit)
    monkeypatch.setattr(model_queries, "model_mark", lambda spark, d: "none-published")
    for key, name in {
        "ml_random_forest": "random_forest",
        "ml_gbt": "gradient_boosting",
        "ml_boosted_subsample": "xgboost",
        "ml_decision_tree": "decision_tree",
        "ml_kernel": "svr",
    }.items():
        with pytest.raises(InterruptedError):
            model_queries.registry.queries[key](spark, sf)
    assert asked == {n: DEFAULTS[n] for n in asked} and len(asked) == 5


def test_evaluation_reads_the_default_forest(spark, sf, monkeypatch):
    asked = []
    monkeypatch.setattr(evaluation_queries, "default_model", lambda spark, d, name: asked.append(name) or InterruptedError)
    assert evaluation_queries._forest(spark, sf)[0] is InterruptedError and asked == ["random_forest"]


def test_interval_leaves_stay_in_spark(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i % 11), float(i % 5)) for i in range(120)]
    data = spark.createDataFrame(rows, "id int, a double, b double, y double")
    params = {**DEFAULTS["random_forest"], "n_estimators": 3, "max_depth": 4}
    model = fit_regressor("random_forest", params, data, fit_context(data, ["a", "b"], "y"))

    def refuse(*_):
        raise AssertionError("leaves came to the driver")

    holed = data.withColumn("a", F.when(F.col("id") != 5, F.col("a")))
    with monkeypatch.context() as m:
        m.setattr(type(data), "toPandas", refuse)
        intervals = evaluation.prediction_intervals(model, holed)
    assert intervals.count() == 120
    missing = intervals.filter("id = 5").first()
    assert missing["prediction_std"] is None and missing["interval_width"] is None


def test_train_all_takes_every_model(spark, sf, monkeypatch):
    seen = {}

    def train_all(self, train, features, label, ids, test, names):
        seen.update(names=names, folds=self.cv_folds, params=self.params)
        return {}

    monkeypatch.setattr(model_queries.ModelTrainer, "train_all", train_all)
    model_queries.registry.queries["train_all"](spark, sf)
    assert seen == {"names": [*DEFAULTS, "unregistered"], "folds": 5, "params": DEFAULTS}


def test_searches_take_their_default_settings(spark, sf, monkeypatch):
    tried = {}

    def run(self, model, method, df, settings):
        study = tuning.Study(model, method)
        for batch in settings(study):
            study.trials += [tuning.Trial(s, [1.0] * self.cv_folds) for s in batch]
        tried[method] = study
        self.studies[study.experiment] = study
        return study

    monkeypatch.setattr(tuning.HyperparameterTuner, "_run", run)
    for key in ("tune_random", "tune_adaptive", "tune_grid_trees"):
        model_queries.registry.queries[key](spark, sf)
    assert {m: (len(s.trials), s.total_fits) for m, s in tried.items()} == {
        "random_search": (50, 250),
        "adaptive": (100, 500),
        "grid_search": (15, 75),
    }
    assert [t.params for t in tried["grid_search"].trials][0] == {"max_depth": None, "min_samples_leaf": 1}


def test_elimination_forests_have_their_full_size(spark, sf, monkeypatch):
    asked = []

    def trees(rows, specs):
        asked.extend(specs)
        raise InterruptedError

    monkeypatch.setattr(selection, "grow_trees", trees)
    with pytest.raises(InterruptedError):
        feature_queries.registry.queries["select_rfe"](spark, sf)
    assert len(asked) == 50 and all(s.bootstrap and s.how.max_depth is None for s in asked)


def test_residual_report_has_every_model(spark, sf):
    rows = evaluation_queries.registry.queries["residual_report"](spark, sf).collect()
    assert sorted(r["model"] for r in rows) == ["by_discount", "by_price", "by_quantity"]
    assert len({r["std"] for r in rows}) == 3


@pytest.mark.parametrize("config", [{}, {"broadcast_rows": 5, "leaf_rows": 16}])
def test_neighbours_stored_and_loaded(spark, tmp_path, config):
    rows = [(i, float(i * 7 % 31), float(i * 5 % 17), float(i)) for i in range(200)]
    data = spark.createDataFrame(rows, "id int, a double, b double, y double")
    model = Regressor("knn", NearestNeighbors(5, ["a", "b"], "y", ["id"], **config).fit(data), ["a", "b"], "y")
    artifacts.save_model(model, str(tmp_path / "knn"))
    loaded = artifacts.load_model(spark, str(tmp_path / "knn"))
    got, want = ([r[0] for r in m.transform(data).orderBy("id").select("prediction").collect()] for m in (loaded, model))
    assert got == want and loaded.name == "knn"


def test_scoring_and_storing_take_every_model(spark, sf, monkeypatch):
    asked = []

    def model(spark, d, name):
        asked.append(name)
        return Regressor(name, None, ["absent"], "label")

    monkeypatch.setattr(scoring_queries, "default_model", model)
    with pytest.raises(AnalysisException):
        scoring_queries.registry.queries["batch_score"](spark, sf)
    assert asked == list(DEFAULTS)
    assert storage_queries._published.__defaults__ == (tuple(DEFAULTS),)


def test_manifest_joins_its_rows_once(spark, sf, tmp_path, monkeypatch):
    """All models of a manifest are fitted to rows that were made once, not by a join (and a broadcast) for each fit."""
    train = model_queries.reg_split(spark, sf).filter("split = 'train'")
    test = model_queries.reg_split(spark, sf).filter("split = 'test'")

    def kept(spark, name, mark, build):
        if not (tmp_path / name).exists():
            build(str(tmp_path / name))
        return str(tmp_path / name)

    def refuse(*_):
        raise AssertionError("the rows of a fit were joined again")

    monkeypatch.setattr(storage_queries.artifacts, "published", kept)
    with monkeypatch.context() as m:
        m.setattr(model_queries, "reg_split", refuse)
        path, _ = storage_queries._published(spark, sf, ("linear_regression", "ridge"))
    rows = {r["model"]: r for r in storage_queries.artifacts.read_manifest(spark, path).collect()}
    assert set(rows) == {"linear_regression", "ridge"}
    ctx = fit_context(train, model_queries.REG_FEATURES, "label", model_queries.REG_IDS)
    for name, r in rows.items():
        alone = fit_regressor(name, DEFAULTS[name], train, ctx).transform(test)
        want = alone.agg(*model_queries.basic_metrics("label", "prediction")).first()
        assert (r["test_rmse"], r["test_r2"]) == pytest.approx((want["rmse"], want["r2"]))


def test_overlapped_work_keeps_its_order():
    """Items run side by side, start in their order and come back in it; an error of one is the caller's."""
    meet, begun = threading.Barrier(2, timeout=20), []

    def work(i):
        begun.append(i)
        meet.wait()
        return -i

    assert overlapped(work, range(4)) == [0, -1, -2, -3] and begun == [0, 1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        overlapped(lambda i: 1 // i, [1, 0])
