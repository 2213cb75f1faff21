"""Trees of large tables on the JVM against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import forest
from plumbline.operators.cart import Growth, Tree, grow
from plumbline.operators.regression import DEFAULTS, fit_context, fit_regressor
from tests.test_trees import FEATURES, frame, numbers


@pytest.fixture(scope="module")
def data(spark):
    return frame(spark, 400).cache()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", [Growth(), Growth(5), Growth(None, 4), Growth(6, 2, 12), Growth(None, 1, 2, None, (0.01, 2.0))])
def test_nodes_are_finished_as_numpy_finishes_them(data, how):
    x, y = numbers(400)
    y = y - y.mean()
    keys = np.array([r[0] for r in data.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    rows = forest.packed_rows(data, FEATURES, "y", ["id"])
    specs = [forest.Spec(0, t, 42, how, bootstrap=t > 0, use=(0, 2) if t == 2 else None, inner=True) for t in range(3)]
    tops = forest.grow_tops(rows, specs, fits=150)
    finished = forest._finish(rows, specs, tops)
    assert "FlatMapGroupsInArrow" not in planned(finished)
    met = 0
    for r in finished.collect():
        spec, top = specs[r["tree"]], tops[r["tree"]]
        w = spec.weights(keys, np.zeros(400, np.int32))
        here = (w > 0) & (top.tree().leaves(x)[0] == r["node"])
        use = list(spec.use or range(4))
        left = Growth(how.max_depth and how.max_depth - top.depth[r["node"]], how.min_leaf, how.min_split, None, how.penalty)
        want, gains = grow(x[here][:, use], y[here], w[here], left, np.random.default_rng(0), True)
        got = Tree.unpacked(r["body"])
        assert np.allclose(got.cut[got.leaves(x[here])[0]], want.cut[want.leaves(x[here][:, use])[0]])
        assert len(got.value) == r["nodes"] == len(want.feature) and r["depth"] == want.depth + top.depth[r["node"]]
        assert np.allclose(np.array(r["gains"])[use], gains)
        met += 1
    assert met >= 6
    rows.blocks.unpersist()


def test_models_share_the_scans_of_boosting(data, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_VALUES", 100)
    rows = forest.packed_rows(data.withColumn("fold", F.col("id") % 3), FEATURES, "y", ["id"], "fold")
    boosts = [forest.Boost(f, 3, 0.3, Growth(3), 42, f, share=0.8, columns=0.8) for f in range(3)]
    calls, levels = [], forest.grow_tops
    monkeypatch.setattr(forest, "grow_tops", lambda rows, specs, *a, **k: calls.append(len(specs)) or levels(rows, specs, *a, **k))
    together = forest.boost_trees(rows, boosts).collect()
    assert calls == [3] * 3
    x, _ = numbers(400)
    for boost in boosts:
        alone = {r["tree"]: Tree.unpacked(r["body"]) for r in forest.boost_trees(rows, [boost]).collect()}
        mine = {r["tree"]: Tree.unpacked(r["body"]) for r in together if r["fit"] == boost.fit}
        assert sorted(alone) == sorted(mine) == [-1, 0, 1, 2]
        assert all(np.allclose(alone[t].cut[alone[t].leaves(x)[0]], mine[t].cut[mine[t].leaves(x)[0]]) for t in alone)
    rows.blocks.unpersist()


@pytest.mark.parametrize("on_driver", [True, False])
def test_boosted_nodes_get_bins_of_their_own(data, monkeypatch, on_driver):
    """Four bins do not tell a crowd's rows apart: blocks then bring their values along, and every row is fitted."""
    monkeypatch.setattr(forest, "LOCAL_VALUES", 1_599 if on_driver else 1)
    monkeypatch.setattr(forest, "BINS", 4)
    _, y = numbers(400)
    crowd = data.select("id", *[(F.when(F.col("id") < 8, F.lit(100.0) * F.col(f)).otherwise(F.col(f) / 1e6)).alias(f) for f in FEATURES], "y")
    params = {**DEFAULTS["gradient_boosting"], "n_estimators": 2, "learning_rate": 1.0, "max_depth": 30}
    model = fit_regressor("gradient_boosting", params, crowd, fit_context(crowd, FEATURES, "y", ["id"]))
    assert np.allclose([r[0] for r in model.transform(crowd).orderBy("id").select("prediction").collect()], y)


def test_rows_meet_few_groups_of_parts(data, monkeypatch):
    """Parts that lie alike in their trees share a group, and rows meet them without a Python worker."""
    monkeypatch.setattr(forest, "LOCAL_VALUES", 400)
    monkeypatch.setattr(forest, "GROUP_BYTES", 6_000)
    model = fit_regressor("random_forest", {**DEFAULTS["random_forest"], "n_estimators": 12}, data, fit_context(data, FEATURES, "y", ["id"])).model
    sizes = forest.part_sizes(model.table, False)
    tops = [tuple(r) for r in model.table.where("node = -1").select("fit", "tree", "node", "body").collect()]
    place = forest.grouped_parts(sizes, tops)
    assert sorted(p[:3] for p in place) == [s[:3] for s in sizes if s[2] >= 0]
    x, _ = numbers(400)
    held = type("Held", (), {"value": (tops, place)})
    visits = sum(len(rows) for group, rows in forest._Routes(held).groups(np.zeros(400, int), x) if group >= 0)
    groups = len({p[3] for p in place})
    assert groups > 6 and visits < 0.7 * 400 * groups
    assert "FlatMapCoGroupsInArrow" not in planned(model.scored(data))
