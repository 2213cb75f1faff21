"""Trees grown on Spark against exhaustive search, in one task and by histograms."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import cart, forest
from plumbline.operators.cart import Growth, Tree, grow
from plumbline.operators.regression import DEFAULTS, ModelTrainer, fit_context, fit_regressor
from plumbline.operators.splitting import fold_column, require_folds, test_flag as is_test_row
from plumbline.operators.tuning import HyperparameterTuner

FEATURES = list("abcd")


def numbers(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 1] = np.round(2 * x[:, 1])
    return x, np.sin(3 * x[:, 0]) + x[:, 1] * x[:, 2] + 0.1 * rng.normal(size=n)


def frame(spark, n):
    x, y = numbers(n)
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, c double, d double, y double").repartition(5)


def exhaustive(x, y, w, how, depth=0):
    total, mass = (w * y).sum(), w.sum()
    node = {"value": how.value(total, mass)}
    if len(y) < max(how.min_split, 2) or np.ptp(y) == 0 or depth == how.max_depth:
        return node
    best = None
    for f in range(x.shape[1]):
        for c in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= c
            if min(left.sum(), (~left).sum()) < how.min_leaf:
                continue
            gain = sum(how.strength((w * y)[s].sum(), w[s].sum()) for s in (left, ~left))
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, c, left)
    if best is None or (how.penalty != (0.0, 0.0) and best[0] <= how.strength(total, mass)):
        return node
    _, f, c, left = best
    values = np.unique(x[:, f])
    sides = [exhaustive(x[s], y[s], w[s], how, depth + 1) for s in (left, ~left)]
    return node | {"f": f, "cut": (c + values[values > c][0]) / 2, "sides": sides}


def walked(node, row):
    while "f" in node:
        node = node["sides"][int(row[node["f"]] > node["cut"])]
    return node["value"]


@pytest.mark.parametrize("how", [Growth(), Growth(3), Growth(None, 4), Growth(5, 2, 12), Growth(4, penalty=(0.5, 2.0))])
def test_levels_give_what_exhaustive_search_gives(how):
    x, y = numbers(160)
    w = np.random.default_rng(1).poisson(1, 160).astype(float)
    tree, gains = grow(x, y, w, how, np.random.default_rng(0), inner=True)
    want = exhaustive(x[w > 0], y[w > 0], w[w > 0], how)
    asked = np.random.default_rng(2).normal(size=(300, 4))
    leaf, _ = tree.leaves(asked)
    assert np.allclose(tree.cut[leaf], [walked(want, r) for r in asked])
    copy = Tree.unpacked(tree.packed())
    assert all((getattr(copy, c) == getattr(tree, c)).all() for c in ("feature", "cut", "child", "value"))
    assert (gains >= 0).all() and tree.depth <= (how.max_depth or 99)


@pytest.fixture(scope="module")
def data(spark):
    return frame(spark, 400).cache()


def predicted(model, df):
    return [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]


def test_default_tree_equals_exhaustive_search(data):
    x, y = numbers(400)
    want = exhaustive(x, y, np.ones(400), Growth())
    model = fit_regressor("decision_tree", DEFAULTS["decision_tree"], data, fit_context(data, FEATURES, "y", ["id"]))
    assert np.allclose(predicted(model, data), [walked(want, r) for r in x]) and model.model.depth > 5
    assert sum(model.model.importances) == pytest.approx(1)


@pytest.mark.parametrize("how", [Growth(), Growth(3), Growth(None, 4), Growth(5, 2, 12), Growth(4, penalty=(0.5, 2.0))])
@pytest.mark.parametrize("front", [20, 32_768])
def test_sums_by_value_give_what_exhaustive_search_gives(monkeypatch, how, front):
    """Levels whose rows are summed up by value, then levels of sorted rows, whole and in runs of nodes."""
    monkeypatch.setattr(cart, "SUMMED_ROWS", 8)
    monkeypatch.setattr(cart, "NODE_ROWS", 1)
    monkeypatch.setattr(cart, "FRONT_ROWS", front)
    x, y = numbers(160)
    x[:, 0], x[:, 2] = np.round(x[:, 0]), np.round(3 * x[:, 2])
    summed, asked = [], cart._Front.summed
    monkeypatch.setattr(cart._Front, "summed", lambda *a: summed.append(asked(*a)) or summed[-1])
    w = np.random.default_rng(1).poisson(1, 160).astype(float)
    tree, gains = grow(x, y, w, how, np.random.default_rng(0), inner=True)
    found = exhaustive(x[w > 0], y[w > 0], w[w > 0], how)
    assert np.allclose(tree.cut[tree.leaves(x)[0]], [walked(found, r) for r in x])
    assert {True, False} == set(summed) and gains.min() >= 0


def test_waves_of_trees_are_finished_side_by_side(spark, data, monkeypatch):
    """Two at a time: each waits until another one has begun."""
    ctx = fit_context(data, FEATURES, "y", ["id"])
    params = {**DEFAULTS["random_forest"], "n_estimators": 8}
    want = predicted(fit_regressor("random_forest", params, data, ctx), data)
    both, finish, sizes = threading.Barrier(2, timeout=60), forest._finish, []

    def waiting(rows, specs, tops):
        both.wait()
        sizes.append(len(specs))
        return finish(rows, specs, tops)

    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    monkeypatch.setattr(forest, "WAVE_ROWS", 1_600)  # four trees
    monkeypatch.setattr(forest, "_finish", waiting)
    model = fit_regressor("random_forest", params, data, ctx)
    assert sizes == [2] * 4 and model.model.table.where("node = -1").count() == 8
    got = predicted(model, data)
    assert np.corrcoef(got, want)[0, 1] > 0.99


def test_histograms_then_tasks_fit_every_row(spark, data, monkeypatch):
    """With at most 100 rows in a task: rows with their own values are told apart to the last one, also where bins are too coarse."""
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    monkeypatch.setattr(forest, "BINS", 4)
    ctx = fit_context(data, FEATURES, "y", ["id"])
    tree = fit_regressor("decision_tree", DEFAULTS["decision_tree"], data, ctx)
    _, y = numbers(400)
    assert tree.model.table.where("node > 0").count() >= 4
    assert np.allclose(predicted(tree, data), y) and tree.model.nodes == 799
    crowd = data.select("id", *[(F.when(F.col("id") < 8, F.lit(100.0) * F.col(f)).otherwise(F.col(f) / 1e6)).alias(f) for f in FEATURES], "y")
    crowded = fit_regressor("decision_tree", DEFAULTS["decision_tree"], crowd, fit_context(crowd, FEATURES, "y", ["id"]))
    assert np.allclose(predicted(crowded, crowd), y)
    flat = data.withColumn("a", F.lit(1.0)).select("id", "a", "y")
    assert predicted(fit_regressor("decision_tree", DEFAULTS["decision_tree"], flat, fit_context(flat, ["a"], "y", ["id"])), flat) == pytest.approx([y.mean()] * 400)


def test_depth_counts_through_the_top(data, monkeypatch):
    ctx = fit_context(data, FEATURES, "y", ["id"])
    whole = fit_regressor("decision_tree", {**DEFAULTS["decision_tree"], "max_depth": 3}, data, ctx)
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    parted = fit_regressor("decision_tree", {**DEFAULTS["decision_tree"], "max_depth": 3}, data, ctx)
    assert parted.model.depth == whole.model.depth == 3 and parted.model.nodes == whole.model.nodes > 7


@pytest.mark.parametrize("name", ["random_forest", "xgboost", "gradient_boosting"])
def test_groups_of_trees_add_up(data, monkeypatch, name):
    params = {**DEFAULTS[name], "n_estimators": 8}
    model = fit_regressor(name, params, data, fit_context(data, FEATURES, "y", ["id"]))
    scanned = predicted(model, data)
    monkeypatch.setattr(forest, "GROUP_BYTES", 3_000)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 150)
    assert np.allclose(predicted(model, data), scanned)


def test_sizes_of_parts_are_known_without_them(data, monkeypatch):
    rows = forest.packed_rows(data, FEATURES, "y", ["id"])
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    for inner in (False, True):
        trees = forest.grow_trees(rows, [forest.Spec(0, t, 42, Growth(), bootstrap=True, inner=inner) for t in range(3)]).where("node >= 0")
        want = [tuple(r) for r in trees.select("fit", "tree", "node", F.octet_length("body")).orderBy("fit", "tree", "node").collect()]
        assert len(want) > 6 and forest.part_sizes(trees.drop("body"), inner) == want
    rows.blocks.unpersist()


def test_rows_of_one_file_are_routed_on_all_cores(spark, data, monkeypatch):
    model = fit_regressor("random_forest", {**DEFAULTS["random_forest"], "n_estimators": 4}, data, fit_context(data, FEATURES, "y", ["id"]))
    want, routed, counted = predicted(model, data), [], forest._on_all_cores
    monkeypatch.setattr(forest, "GROUP_BYTES", 3_000)
    monkeypatch.setattr(forest, "_on_all_cores", lambda *a: routed.append(counted(*a)) or routed[-1])
    assert np.allclose(predicted(model, data.coalesce(1)), want)
    assert routed[0].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1


def test_forest_is_its_trees(data):
    """A forest's trees are exhaustive trees of their weighted rows; its spread is that of their values."""
    model = fit_regressor("random_forest", {**DEFAULTS["random_forest"], "n_estimators": 4}, data, fit_context(data, FEATURES, "y", ["id"])).model
    x, y = numbers(400)
    keys = np.array([r[0] for r in data.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    values = []
    for t in range(4):
        w = forest.Spec(0, t, 42, Growth(), bootstrap=True).weights(keys, np.zeros(400, int))
        assert 0.5 < (w > 0).mean() < 0.75 and 0.85 < w.mean() < 1.15
        tree = exhaustive(x[w > 0], (y - y.mean())[w > 0], w[w > 0], Growth())
        values.append([walked(tree, r) for r in x])
    got = model.with_spread(data).orderBy("id").select("prediction", "prediction_std").collect()
    assert np.allclose([r[0] for r in got], np.mean(values, axis=0) + y.mean())
    assert np.allclose([r[1] for r in got], np.std(values, axis=0), atol=1e-7)


def boosted(x, y, keys, params, seed=42):
    left, total = y - y.mean(), np.full(len(y), y.mean())
    boost = forest.Boost(0, 0, 0, forest.growth(params, 4, (params["reg_alpha"], params["reg_lambda"])), seed, share=params["subsample"], columns=params["colsample"])
    for i in range(params["n_estimators"]):
        spec = boost.spec(i, 4)
        w, use = spec.weights(keys, np.zeros(len(y), int)), list(spec.use)
        tree = exhaustive(x[w > 0][:, use], left[w > 0], w[w > 0], spec.how)
        step = params["learning_rate"] * np.array([walked(tree, r) for r in x[:, use]])
        left, total = left - step, total + step
    return total


@pytest.mark.parametrize("local", [True, False])
def test_boosting_with_columns_for_each_tree_and_penalties(data, monkeypatch, local):
    params = {**DEFAULTS["xgboost"], "n_estimators": 3, "max_depth": 2, "reg_alpha": 0.3, "colsample": 0.5}
    if not local:  # bins for every value: histograms find the same cuts but for their place between two values
        monkeypatch.setattr(forest, "LOCAL_VALUES", 100)
        monkeypatch.setattr(forest, "BINS", 512)
        monkeypatch.setattr(forest, "SETTLED_ROUNDS", 2)
    model = fit_regressor("xgboost", params, data, fit_context(data, FEATURES, "y", ["id"]))
    x, y = numbers(400)
    keys = np.array([r[0] for r in data.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    got, want = np.array(predicted(model, data)), boosted(x, y, keys, params)
    assert np.allclose(got, want) if local else np.isclose(got, want).mean() > 0.97


def test_grid_of_depths_equals_separate_fits(data):
    tuner = HyperparameterTuner(FEATURES, "y", ["id"], cv_folds=3)
    study = tuner.grid_search("decision_tree", data.withColumn("fold", F.col("id") % 3))
    x, y = numbers(400)
    fold = np.arange(400) % 3
    assert len(study.trials) == 15
    for trial in study.trials[::4]:
        want = []
        for f in range(3):
            how = Growth(trial.params["max_depth"], trial.params["min_samples_leaf"])
            tree, _ = grow(x[fold != f], y[fold != f], np.ones((fold != f).sum()), how, np.random.default_rng(0))
            want.append(np.sqrt(np.mean((tree.cut[tree.leaves(x[fold == f])[0]] - y[fold == f]) ** 2)))
        assert trial.scores == pytest.approx(want)


def test_folds_of_a_train_split_are_even(spark):
    rows = spark.range(20_000).where(~is_test_row(["id"]))
    sizes = {r["f"]: r["count"] for r in rows.groupBy(fold_column(["id"]).alias("f")).count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and all(abs(n / sum(sizes.values()) - 0.2) < 0.02 for n in sizes.values())
    with pytest.raises(ValueError, match="hold no row"):
        require_folds([1, 2, 3, 4], 5)


def test_cross_validation_refuses_an_empty_fold(data):
    tuner = HyperparameterTuner(FEATURES, "y", ["id"], cv_folds=3)
    with pytest.raises(ValueError, match="hold no row"):
        tuner.grid_search("decision_tree", data.withColumn("fold", F.lit(1)), {"max_depth": [2]})


def test_training_scores_every_fold(data):
    trainer = ModelTrainer({"random_forest": {"params": {"n_estimators": 5}}}, cv_folds=3)
    result = trainer.train_single("random_forest", data, FEATURES, "y", ["id"], data.limit(50))
    assert len(result.fold_scores) == 3 and result.cv_rmse > result.train["rmse"] > 0


@pytest.mark.parametrize("name, cuts", [("decision_tree", ()), ("decision_tree", (2, 6)), ("random_forest", ())])
def test_a_part_meets_the_rows_that_end_in_it(data, monkeypatch, name, cuts):
    """A model too large to broadcast: its parts are copied for the rows they score, not for all rows."""
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    rows = forest.packed_rows(data, FEATURES, "y", ["id"])
    specs = [forest.Spec(0, t, 42, Growth(min_leaf=2), bootstrap=name == "random_forest", inner=bool(cuts)) for t in range(3 if name == "random_forest" else 1)]
    trees = forest.grow_trees(rows, specs).cache()
    asked = data.withColumn("a", F.when(F.col("id") != 7, F.col("a"))).withColumn("note", F.lit("kept"))
    names = ["id", "note", "__s0", "__q", *[f"__s{i + 1}" for i in range(len(cuts))]]
    want = sorted(map(tuple, forest.score(asked, FEATURES, trees, cuts=cuts).select(names).collect()))
    monkeypatch.setattr(forest, "GROUP_BYTES", 1_000)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 20)
    copies, dealt = [], forest._dealt_parts
    monkeypatch.setattr(forest, "_dealt_parts", lambda *a: copies.append(dealt(*a)) or copies[0])
    got = sorted(map(tuple, forest.score(asked, FEATURES, trees, cuts=cuts).select(names).collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2:] for g in got], [w[2:] for w in want])
    assert 2 * copies[0].count() < trees.where("node >= 0").count() * 400 / 20


def test_boosting_reads_the_residuals_of_the_round_before(data, monkeypatch):
    """A round takes one tree off what the round before left, and bins are found once, before the first round."""
    monkeypatch.setattr(forest, "LOCAL_VALUES", 100)
    taken, left = [], forest._residuals
    monkeypatch.setattr(forest, "_residuals", lambda trees, rate: taken.append(len(trees)) or left(trees, rate))
    blocks, levels = [], forest.grow_tops
    monkeypatch.setattr(forest, "grow_tops", lambda rows, *a, **k: blocks.append(rows.blocks.columns) or levels(rows, *a, **k))
    fit_regressor("gradient_boosting", {**DEFAULTS["gradient_boosting"], "n_estimators": 4}, data, fit_context(data, FEATURES, "y", ["id"]))
    assert taken == [1] * 4 and all("codes" in columns for columns in blocks)


@pytest.mark.parametrize("held, calls", [(2_000, 1), (12, 2)])
def test_tops_of_many_trees_share_their_scans(data, monkeypatch, held, calls):
    """However few trees are finished at a time, their tops grow together, as far as a task can hold their sums."""
    model = lambda: fit_regressor("random_forest", {**DEFAULTS["random_forest"], "n_estimators": 6}, data, fit_context(data, FEATURES, "y", ["id"]))
    x, y = numbers(400)
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    monkeypatch.setattr(forest, "WAVE_ROWS", 800)
    monkeypatch.setattr(forest, "HELD_HISTOGRAMS", held)
    grown, levels = [], forest.grow_tops
    monkeypatch.setattr(forest, "grow_tops", lambda rows, specs, *a, **k: grown.append(len(specs)) or levels(rows, specs, *a, **k))
    table = model().model.table
    assert len(grown) == calls and sum(grown) == 6
    keys = np.array([r[0] for r in data.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    trees = {}
    for r in table.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = Tree.unpacked(r["body"])
    assert sorted(trees) == list(range(6))
    for t, parts in trees.items():  # rows with values of their own: a tree gives back each row that it was grown on
        used = forest.Spec(0, t, 42, Growth(), bootstrap=True).weights(keys, np.zeros(400, np.int32)) > 0
        assert np.allclose(forest.tree_values(parts, x[used], ())[:, 0], y[used] - y.mean())
