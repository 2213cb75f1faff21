import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import row_key
from plumbline.operators import evaluation, forest, regression, scoring, tuning
from plumbline.operators.linear import cross_products, fold_rmse, solve, total
from plumbline.operators.neighbors import NearestNeighbors
from plumbline.operators.regression import DEFAULTS, PREDICTION, ModelTrainer, fit_context, fit_regressor
from plumbline.operators.splitting import fold_column
from plumbline.sources import artifacts
from plumbline.streaming.scoring import read_files, score_stream_batches

FEATURES = [f"f{i}" for i in range(4)]


def numbers(n=250, seed=42):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 3, 0.5, 2] + [0, 1, 5, -2]
    return x, 2 * x[:, 0] + 1.5 * x[:, 1] + 0.5 * rng.normal(size=n) + 10


def frame(spark, n=250):
    x, y = numbers(n)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{f} double" for f in FEATURES) + ", y double")


@pytest.fixture(scope="module")
def data(spark):
    return frame(spark).cache()


def coordinate_descent(x, y, l1, l2):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(3000):
        for j in range(len(w)):
            rest = yc - xc @ w + xc[:, j] * w[j]
            g = xc[:, j] @ rest / len(y)
            w[j] = np.sign(g) * max(abs(g) - l1, 0) / (xc[:, j] @ xc[:, j] / len(y) + l2)
    return w


@pytest.mark.parametrize("name", ["linear_regression", "ridge", "lasso", "elastic_net"])
def test_penalised_fits_match_their_definition(data, name):
    x, y = numbers()
    params = {**DEFAULTS[name], **({"alpha": 20.0} if name == "ridge" else {"alpha": 0.3} if name != "linear_regression" else {})}
    fitted = fit_regressor(name, params, data, fit_context(data, FEATURES, "y"))
    a = params.get("alpha", 0.0)
    l1, l2 = {
        "linear_regression": (0, 0),
        "ridge": (0, a / len(y)),
        "lasso": (a, 0),
        "elastic_net": (a * 0.5, a * 0.5),
    }[name]
    want = coordinate_descent(x, y, l1, l2)
    assert np.allclose(fitted.model.coefficients.toArray(), want, atol=1e-6)
    ours = solve(total(cross_products(data, FEATURES, "y")), l1, l2)
    assert np.allclose(ours.coefficients, want, atol=1e-8)


def test_one_pass_cross_validation_equals_refitting(data):
    folded = data.withColumn("fold", fold_column(["row_id"], 3)).cache()
    parts = cross_products(folded, FEATURES, "y", F.col("fold"))
    quick = fold_rmse(parts)
    for f, score in quick.items():
        rest = folded.filter(F.col("fold") != f)
        model = fit_regressor("linear_regression", {}, rest, fit_context(rest, FEATURES, "y"))
        held = model.transform(folded.filter(F.col("fold") == f))
        assert score == pytest.approx(held.agg(F.sqrt(F.avg((F.col("y") - F.col(PREDICTION)) ** 2))).first()[0], rel=1e-9)


SMALL = {
    "random_forest": {"params": {"n_estimators": 5, "max_depth": 4}},
    "gradient_boosting": {"params": {"n_estimators": 5}},
    "xgboost": {"params": {"n_estimators": 5, "max_depth": 3}},
    "decision_tree": {"params": {"max_depth": 4}},
    "svr": {"params": {"components": 16}},
}


def test_train_all_compare_and_choose(spark, data):
    train, test = data.filter("row_id < 200"), data.filter("row_id >= 200")
    trainer = ModelTrainer(SMALL, cv_folds=2)
    results = trainer.train_all(train, FEATURES, "y", ["row_id"], test, [*DEFAULTS, "absent"])
    assert results["absent"].error and not [n for n in DEFAULTS if results[n].error], {n: r.error for n, r in results.items()}
    table = trainer.compare(spark).collect()
    assert len(table) == 10
    scores = [r["cv_rmse_mean"] for r in table]
    assert scores == sorted(scores)
    name, model = trainer.best("test_r2")
    assert trainer.results[name].test["r2"] > 0.9
    assert trainer.best("cv_rmse")[0] == table[0]["model"]
    assert model.transform(test).filter(f"isnan({PREDICTION}) OR {PREDICTION} IS NULL").count() == 0
    importance = trainer.importance("random_forest", spark).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert trainer.importance("knn", spark) is None
    for call in (lambda: trainer.best("other"), lambda: trainer.predict("absent", test), lambda: trainer.importance("absent", spark)):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError):
        trainer.train_single("absent", train, FEATURES, "y", ["row_id"])
    with pytest.raises(ValueError):
        ModelTrainer().best()
    assert ModelTrainer().compare(spark).count() == 0


def test_custom_model(spark, data):
    entry = {"mine": {"params": {"alpha": 5.0}, "factory": regression.make_ridge}}
    trainer = ModelTrainer(entry, cv_folds=2)
    assert len(trainer.params) == 11
    result = trainer.train_single("mine", data, FEATURES, "y", ["row_id"])
    assert result.cv_rmse < 1 and not result.test
    with pytest.raises(ValueError):
        ModelTrainer({"mine": {"params": {}}})


def test_models_stored_and_loaded(spark, data, tmp_path):
    ctx = fit_context(data, FEATURES, "y", ["row_id"])
    rows = []
    for name in ("ridge", "random_forest", "gradient_boosting", "svr"):
        params = {**DEFAULTS[name], **SMALL.get(name, {}).get("params", {})}
        model = fit_regressor(name, params, data, ctx)
        path = str(tmp_path / name)
        artifacts.save_model(model, path)
        loaded = artifacts.load_model(spark, path)
        a = [r[0] for r in model.transform(data).orderBy("row_id").select(PREDICTION).collect()]
        b = [r[0] for r in loaded.transform(data).orderBy("row_id").select(PREDICTION).collect()]
        assert np.allclose(a, b)
        rows.append((name, path, 1.0, 1.0, 0.5, FEATURES, FEATURES))
    manifest = str(tmp_path / "manifest")
    assert artifacts.load_all(spark, manifest) == {}
    ran = []
    assert artifacts.ensure_artifacts(spark, manifest, ["ridge"], lambda: ran.append(1))
    artifacts.write_manifest(spark, manifest, [*rows, ("gone", str(tmp_path / "gone"), 1.0, 1.0, 0.0, [], [])])
    assert not artifacts.ensure_artifacts(spark, manifest, ["ridge"], lambda: ran.append(1)) and len(ran) == 1
    assert set(artifacts.load_all(spark, manifest)) == {"ridge", "random_forest", "gradient_boosting", "svr"}


@pytest.mark.parametrize("config", [{}, {"broadcast_rows": 5, "leaf_rows": 16}, {"broadcast_rows": 5, "leaf_rows": 16, "queries_per_group": 7}, {"weights": "distance", "p": 1}, {"broadcast_rows": 5, "leaf_rows": 16, "weights": "distance", "p": 1}])
def test_neighbours_match_brute_force(spark, config):
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(300, 2)), 1)
    points[:100] = points[0]  # a third of the rows is one vector
    labels = rng.integers(0, 9, 300).astype(float)
    asked = np.vstack([np.round(rng.normal(size=(60, 2)), 1), points[:20], [[50.0, 50.0]]])
    train = spark.createDataFrame([(i, *map(float, p), float(v)) for i, (p, v) in enumerate(zip(points, labels))], "id int, a double, b double, y double")
    queries = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(asked)], "id int, a double, b double")
    got = NearestNeighbors(5, ["a", "b"], "y", ["id"], **config).fit(train).transform(queries).orderBy("id").collect()
    assert len(got) == len(asked)
    ties = [int(hashlib.md5(f"{i}|42".encode()).hexdigest()[:13], 16) for i in range(300)]
    p, by_distance = config.get("p", 2), config.get("weights") == "distance"
    for row, q in zip(got, asked):
        d = (np.abs(q - points) ** p).sum(axis=1)
        near = np.lexsort((ties, d))[:5]
        with np.errstate(divide="ignore"):
            share = 1 / d[near] ** (1 / p) if by_distance else np.ones(5)
        share = np.isinf(share).astype(float) if np.isinf(share).any() else share
        assert row["prediction"] == pytest.approx((labels[near] * share).sum() / share.sum())


def test_equal_vectors_are_not_biased_to_small_labels(spark):
    train = spark.createDataFrame([(i, 1.0, float(i)) for i in range(1000)], "id int, a double, y double")
    got = NearestNeighbors(200, ["a"], "y", ["id"]).fit(train).transform(train.limit(1).select("a")).first()["prediction"]
    assert abs(got - 499.5) < 80


def test_incomplete_rows_have_no_prediction_and_no_metric(spark, data):
    ctx = fit_context(data, FEATURES, "y", ["row_id"])
    holed = data.withColumn(FEATURES[0], F.when(F.col("row_id") % 5 == 0, None).otherwise(F.col(FEATURES[0])))
    gaps = holed.filter(F.col(FEATURES[0]).isNull()).count()
    assert fit_context(holed, FEATURES, "y").n == data.count() - gaps
    for name, params in (("ridge", {}), ("decision_tree", {"max_depth": 3}), ("svr", {"components": 8}), ("knn", {})):
        model = fit_regressor(name, {**DEFAULTS[name], **params}, data, ctx)
        scored = model.transform(holed)
        assert scored.filter("prediction IS NULL").count() == gaps, name
        preds = evaluation.predictions(model, {"test": holed}, ["row_id"])
        assert evaluation.regression_metrics(preds).first()["n"] == data.count() - gaps


def test_depth_that_cannot_be_had_is_refused():
    assert forest.growth({"max_depth": None}, 3).max_depth is None and forest.growth({"max_depth": 0}, 3).max_depth == 0
    assert forest.growth({"max_depth": 31}, 3).max_depth == 31  # no deepest tree
    with pytest.raises(ValueError):
        forest.growth({"max_depth": -1}, 3)


def hand_predictions(spark):
    rows = [("m", "test", i, float(t), p) for i, (t, p) in enumerate(zip([1, 2, 3, 4, 5], [1.1, 2.2, 2.8, 4.1, 4.9]))]
    return spark.createDataFrame(rows, "model string, split string, row_id int, y_true double, y_pred double")


def test_metrics_by_hand(spark):
    m = evaluation.regression_metrics(hand_predictions(spark)).first().asDict()
    want = {"mse": 0.022, "mae": 0.14, "max_error": 0.2, "mean_residual": -0.02, "r2": 0.989, "rmse": math.sqrt(0.022)}
    for key, value in want.items():
        assert m[key] == pytest.approx(value, abs=1e-12)
    assert set(evaluation.METRICS) <= set(m)
    assert m["adjusted_r2"] == pytest.approx(1 - 0.011 * 4 / 3)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_durbin_watson_over_runs(spark, partitions):
    rng = np.random.default_rng(0)
    e = rng.normal(size=400)
    ts = np.repeat(np.arange(100), 4)
    ts[:150] = 0  # a third of the rows shares one time
    rows = [(int(t), i, float(v)) for i, (t, v) in enumerate(zip(ts, e))]
    df = spark.createDataFrame(rows, "ts int, id int, e double")
    order = np.lexsort((np.arange(400), ts))
    want = np.sum(np.diff(e[order]) ** 2) / np.sum(e**2)
    got = evaluation.durbin_watson(df.repartition(5), F.col("e"), ["ts", "id"], partitions).first()["statistic"]
    assert got == pytest.approx(want, rel=1e-12)


def test_forest_intervals_match_single_trees(spark, data, monkeypatch):
    params = {**DEFAULTS["random_forest"], "n_estimators": 7, "max_depth": 5}
    ctx = fit_context(data, FEATURES, "y")
    model = fit_regressor("random_forest", params, data, ctx)
    vectors = regression.VectorAssembler(inputCols=FEATURES, outputCol=regression.FEATURES).transform(data)
    trees = np.array([[r[0] for r in t.transform(vectors).orderBy("row_id").select("prediction").collect()] for t in model.model.trees])
    for limit in (8_000_000, 2_000):  # bytes that are broadcast: all trees, or none
        monkeypatch.setattr(forest, "GROUP_BYTES", limit)
        rows = evaluation.prediction_intervals(model, data).orderBy("row_id").collect()
        assert np.allclose([r["prediction_std"] for r in rows], trees.std(axis=0), atol=1e-9)
        assert np.allclose([r["interval_width"] for r in rows], 2 * 1.959963984540054 * trees.std(axis=0), atol=1e-8)
    assert evaluation.prediction_intervals(fit_regressor("gradient_boosting", {**DEFAULTS["gradient_boosting"], "n_estimators": 2}, data, ctx), data) is None


def test_evaluator(spark, data, tmp_path):
    train, test = data.filter("row_id < 200"), data.filter("row_id >= 200")
    ctx = fit_context(train, FEATURES, "y")
    evaluator = evaluation.ModelEvaluator(["row_id"])
    assert evaluator.compare(spark).count() == 0
    for name in ("linear_regression", "decision_tree"):
        params = {**DEFAULTS[name], **SMALL.get(name, {}).get("params", {})}
        evaluator.evaluate(fit_regressor(name, params, train, ctx), train, test, test)
    table = evaluator.compare(spark).collect()
    assert [r["test_rmse"] for r in table] == sorted(r["test_rmse"] for r in table) and table[0]["n_features"] == 4
    assert evaluator.results["linear_regression"]["metrics"].count() == 3
    sizes = evaluator.results["linear_regression"]["complexity"].first()
    assert sizes["n_parameters"] == 5
    assert evaluator.results["decision_tree"]["complexity"].first()["n_parameters"] == 16
    text = evaluator.report_text("linear_regression")
    assert "[metrics]" in text and "test_rmse" in text and "[residuals]" in text
    evaluator.save("linear_regression", str(tmp_path))
    assert spark.read.json(str(tmp_path / "linear_regression" / "metrics")).count() == 3
    with pytest.raises(ValueError):
        evaluator.report("absent")


def test_searches(spark, data, tmp_path):
    tuner = tuning.HyperparameterTuner(FEATURES, "y", ["row_id"], cv_folds=3)
    assert len(tuner.grid_search("ridge", data).trials) == 5
    assert len(tuner.random_search("elastic_net", data, n_iter=6).trials) == 6
    assert tuner.random_search("lasso", data, n_iter=100).total_fits == 6 * 3 * 3  # penalties, limits of steps, folds
    study = tuner.adaptive_search("ridge", data, n_trials=25)
    assert study.best_score <= tuner.studies["ridge_grid_search"].best_score * 1.001
    again = tuning.HyperparameterTuner(FEATURES, "y", ["row_id"], cv_folds=3).adaptive_search("ridge", data, n_trials=25)
    assert [t.params for t in again.trials] == [t.params for t in study.trials]
    assert tuner.grid_search("unknown", data) is None
    with pytest.raises(ValueError):
        tuner.adaptive_search("knn", data)
    with pytest.raises(ValueError):
        tuner.best_params("svr")
    scores = [r["best_rmse"] for r in tuner.compare(spark).collect()]
    assert scores == sorted(scores) and len(scores) == 4
    assert tuner.best_params("ridge", "grid_search")["alpha"] in tuning.GRIDS["ridge"]["alpha"]
    tuner.save(spark, str(tmp_path / "trials"))
    assert tuner.load_trials(spark, str(tmp_path / "trials")).exceptAll(tuner.trials(spark)).count() == 0
    assert tuner.adaptive_search("ridge", data, n_trials=500, timeout=0.0).total_fits == 3


def test_adaptive_search_in_batches(spark, data, monkeypatch):
    asked = []
    whole = tuning.HyperparameterTuner._tree_trials

    def counted(self, model, frame, batch):
        asked.append(len(batch))
        return whole(self, model, frame, batch)

    monkeypatch.setattr(tuning.HyperparameterTuner, "_tree_trials", counted)
    tuner = tuning.HyperparameterTuner(FEATURES, "y", ["row_id"], cv_folds=3)
    space = {"max_depth": ("int", 1, 6), "min_samples_leaf": ("int", 1, 40)}
    study = tuner.adaptive_search("decision_tree", data, n_trials=14, space=space, batch=6)
    assert asked == [6, 6, 2] and study.total_fits == 42
    assert len({tuple(sorted(t.params.items())) for t in study.trials}) > 7
    again = tuning.HyperparameterTuner(FEATURES, "y", ["row_id"], cv_folds=3).adaptive_search("decision_tree", data, n_trials=14, space=space, batch=6)
    assert [(t.params, t.scores) for t in again.trials] == [(t.params, t.scores) for t in study.trials]
    one = tuner.grid_search("decision_tree", data, {k: [v] for k, v in study.best_params.items()})
    assert one.best_score == pytest.approx(study.best_score)
    with pytest.raises(ValueError):
        tuner.adaptive_search("ridge", data, batch=0)


def test_ensemble_and_lookup(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0, "Fresno"), (2.0, 2.0, 2.0, None)], "a double, b double, c double, city string")
    rows = df.select(*scoring.ensemble(["a", "b", "c"])).collect()
    assert rows[0]["ensemble"] == pytest.approx(300_000) and rows[0]["spread"] == pytest.approx(np.std([1, 2, 6]) * 1e5)
    assert rows[1]["spread"] == 0.0
    places = [(r["lat"], r["lon"]) for r in scoring.place_lookup(df, "city").orderBy("a").collect()]
    assert places == [scoring.PLACES["Fresno"], scoring.PLACES[scoring.DEFAULT_PLACE]]


def test_models_without_their_features_are_left_out(spark, data):
    model = fit_regressor("linear_regression", {}, data, fit_context(data, FEATURES, "y"))
    _, skipped = scoring.batch_score(data.drop("f0"), [model])
    assert skipped == {"linear_regression": ["f0"]}


def test_stream_equals_batch(spark, sf, tmp_path):
    model = lambda df: df.select("event_id", (F.col("value") * 2).alias("twice"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    seen = str(tmp_path / "out")
    source = read_files(spark, sf, "events.parquet", events.schema)
    query = score_stream_batches(source, model, lambda df, _: df.write.mode("append").parquet(seen), str(tmp_path / "log"))
    query.awaitTermination()
    assert spark.read.parquet(seen).exceptAll(model(events)).count() == 0
    assert spark.read.parquet(seen).count() == events.count()


def test_row_key_is_stable(spark):
    a = spark.range(50).select(row_key("id").alias("k")).agg(F.sum("k"), F.count_distinct("k")).first()
    b = spark.range(50).repartition(9).select(row_key("id").alias("k")).agg(F.sum("k"), F.count_distinct("k")).first()
    assert a == b and a[1] == 50
