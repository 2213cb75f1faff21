"""The kernel regressor against pairwise ascent of its dual, and its landmarks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import kernel
from plumbline.operators.regression import DEFAULTS, ModelTrainer, cross_validate, fit_context, fit_regressor
from plumbline.operators.splitting import fold_column
from plumbline.sources import artifacts

NAMES = ["a", "b"]


def table(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [1.0, 2.0]
    y = np.sin(2 * x[:, 0]) + 0.3 * x[:, 1] + 0.1 * rng.normal(size=n)
    return x, y, spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, y double").repartition(3)


def scale_gamma(x):
    return 1.0 / (x.shape[1] * x.var())


def dual_value(k, y, cost, epsilon, sweeps=150):
    """The best of ``-a'Ka/2 + y'a - epsilon|a|`` with ``sum(a) = 0`` and ``|a| <= cost``, two weights at a time."""
    a = np.zeros(len(y))
    for _ in range(sweeps):
        for i in range(len(y)):
            for j in range(i):
                slope = (y - k @ a)[i] - (y - k @ a)[j]
                bend = k[i, i] + k[j, j] - 2 * k[i, j]
                low, high = max(-cost - a[i], a[j] - cost), min(cost - a[i], a[j] + cost)
                marks = [low, high, *[t for t in (-a[i], a[j]) if low < t < high]]
                for si in (-1, 1):
                    for sj in (-1, 1):
                        t = (slope - epsilon * (si - sj)) / max(bend, 1e-12)
                        marks.append(min(max(t, low), high))
                gain = [t * slope - t * t * bend / 2 - epsilon * (abs(a[i] + t) + abs(a[j] - t)) for t in marks]
                t = marks[int(np.argmax(gain))]
                a[i], a[j] = a[i] + t, a[j] - t
    return -a @ k @ a / 2 + y @ a - epsilon * np.abs(a).sum()


@pytest.mark.parametrize("cost,epsilon", [(1.0, 0.1), (10.0, 0.3)])
def test_fit_reaches_the_dual(spark, cost, epsilon):
    x, y, df = table(spark, 24)
    params = {"C": cost, "gamma": "scale", "epsilon": epsilon, "components": 64}
    model = kernel.KernelEstimator(params, NAMES, "y", ["id"]).fit(df)
    assert model.gamma == pytest.approx(scale_gamma(x)) and len(model.centers) == 24
    k = np.exp(-model.gamma * kernel.squared_distances(x, x))
    centers, w = np.array(model.centers), np.array(model.weights)
    f = np.exp(-model.gamma * kernel.squared_distances(x, centers)) @ w + model.intercept
    inner = np.exp(-model.gamma * kernel.squared_distances(centers, centers))
    primal = w @ inner @ w / 2 + cost * np.maximum(np.abs(y - f) - epsilon, 0).sum()
    best = dual_value(k, y, cost, epsilon)
    assert best - 1e-6 <= primal <= best * 1.01
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert [got[i] for i in range(24)] == pytest.approx(f, abs=1e-9)


def test_few_landmarks_come_near_the_whole_kernel(spark):
    x, _, df = table(spark, 400)
    truth = np.sin(2 * x[:, 0]) + 0.3 * x[:, 1]
    found = {}
    for size in (60, 400):
        model = kernel.KernelEstimator({**DEFAULTS["svr"], "C": 10.0, "components": size}, NAMES, "y", ["id"]).fit(df)
        assert len(model.centers) <= size
        rows = model.transform(df).orderBy("id").toPandas()["prediction"].to_numpy()
        found[size] = rows
    assert np.sqrt(np.mean((found[60] - found[400]) ** 2)) < 0.02
    assert np.sqrt(np.mean((found[60] - truth) ** 2)) < 0.1


def test_landmarks_do_not_depend_on_partitions(spark):
    _, _, df = table(spark, 300)
    fits = [kernel.KernelEstimator({**DEFAULTS["svr"], "components": 20}, NAMES, "y", ["id"]).fit(d) for d in (df, df.repartition(9))]
    assert fits[0].centers == fits[1].centers and fits[0].weights == pytest.approx(fits[1].weights, rel=1e-4, abs=1e-5)


def test_folds_together_are_folds_apart(spark):
    _, _, df = table(spark, 120)
    df = df.withColumn("fold", fold_column(["id"], 3))
    params = {**DEFAULTS["svr"], "components": 30}
    together = cross_validate("svr", params, df, NAMES, "y", "fold", 3, ["id"])
    for fold, score in enumerate(together):
        rest = df.where(F.col("fold") != fold)
        model = fit_regressor("svr", params, rest, fit_context(rest, NAMES, "y", ["id"]))
        held = model.transform(df.where(F.col("fold") == fold)).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
        assert score == pytest.approx(held, rel=1e-4)


def test_gaps_constants_and_storage(spark, tmp_path):
    _, _, df = table(spark, 40)
    holed = df.withColumn("a", F.when(F.col("id") != 3, F.col("a"))).withColumn("b", F.lit(1.0))
    trainer = ModelTrainer({"svr": {"params": {"components": 16}}}, cv_folds=2)
    trainer.train_single("svr", holed, NAMES, "y", ["id"])
    model = trainer.models["svr"]
    artifacts.save_model(model, str(tmp_path / "m"))
    again = artifacts.load_model(spark, str(tmp_path / "m"))
    pairs = zip(model.transform(holed).orderBy("id").collect(), again.transform(holed).orderBy("id").collect())
    assert all(p["prediction"] == q["prediction"] and (p["prediction"] is None) == (p["id"] == 3) for p, q in pairs)
    flat = kernel.KernelEstimator(DEFAULTS["svr"], NAMES, "y", ["id"]).fit(df.withColumn("y", F.lit(2.0)))
    assert flat.transform(df).agg(F.max(F.abs(F.col("prediction") - 2.0))).first()[0] <= 0.1 + 1e-6
    with pytest.raises(ValueError, match="needs rows"):
        kernel.KernelEstimator(DEFAULTS["svr"], NAMES, "y", ["id"]).fit(df.where("id < 0"))


def test_adders_change_nothing(spark, monkeypatch):
    _, _, df = table(spark, 200)
    estimator = kernel.KernelEstimator({**DEFAULTS["svr"], "components": 15}, NAMES, "y", ["id"])
    direct = estimator.fit(df.repartition(9))
    monkeypatch.setattr(kernel, "ADDERS", 3)
    added = estimator.fit(df.repartition(9))
    assert direct.centers == added.centers and direct.weights == pytest.approx(added.weights, rel=1e-4, abs=1e-5)


def test_wide_blocks_are_worked_on_in_runs(monkeypatch):
    """Runs of rows change no bit of distances, kernel values or what is nearest."""
    rng = np.random.default_rng(1)
    x, centers = rng.normal(size=(20_000, 3)), rng.normal(size=(64, 3))
    view = kernel.View(-1, 0.5, 0.0, 1.0, centers, np.eye(64), np.zeros(65))
    found = view.mapped(x)
    plain = np.zeros((len(x), 64))
    for j in range(3):
        plain += (x[:, j, None] - centers[None, :, j]) ** 2
    assert np.array_equal(found, np.column_stack([np.exp(-0.5 * plain) @ np.eye(64), np.ones(len(x))]))
    at, far = kernel.nearest_centers(x, centers)
    assert np.array_equal(at, plain.argmin(axis=1)) and np.array_equal(far, plain.min(axis=1))
    monkeypatch.setattr(kernel, "CACHED_VALUES", 7)
    assert np.array_equal(kernel.squared_distances(x[:50], centers), plain[:50])
    assert np.array_equal(kernel.kernel_values(x[:50], centers, 0.5), np.exp(-0.5 * plain[:50]))
