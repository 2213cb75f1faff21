import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions.moments import student_t_two_sided
from plumbline.operators import explore, profile
from plumbline.operators.stats import moments, order_statistics, quantiles


def frame(spark, values, name="v"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize("kind", ["normal", "ties", "constant", "boundary_tie", "heavy_tail"])
def test_narrowing_is_exact(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "normal": rng.normal(size=5000),
        "ties": rng.integers(0, 4, 5000).astype(float),
        "constant": np.full(3000, 7.0),
        "boundary_tie": np.concatenate([np.full(2500, 1.0), np.full(1250, 2.0), rng.normal(5, 1, 1250)]),
        "heavy_tail": np.exp(rng.normal(0, 6, 5000)),
    }[kind]
    df = frame(spark, values).repartition(4)
    ranks = [0, 1, 1249, 2499, 2500, len(values) - 1]
    found = order_statistics(df, {"v": F.col("v")}, {"v": ranks}, {"v": len(values)}, gather_limit=20, accuracy=50)
    ordered = np.sort(values)
    assert [found["v", k] for k in ranks] == [ordered[k] for k in ranks]


def test_narrowing_by_group(spark):
    rng = np.random.default_rng(2)
    x, g = np.exp(rng.normal(0, 3, 6000)), rng.integers(0, 3, 6000)
    x[g == 1] = np.round(x[g == 1])
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g0 int, x double").repartition(4)
    values = {str(i): F.col("x") for i in range(3)}
    counts = {str(i): int((g == i).sum()) for i in range(3)}
    ranks = {str(i): [0, counts[str(i)] // 2, counts[str(i)] - 1] for i in range(3)}
    found = order_statistics(df, values, ranks, counts, gather_limit=20, accuracy=50, group=F.col("g0"))
    assert all(found[n, k] == np.sort(x[g == int(n)])[k] for n in ranks for k in ranks[n])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = frame(spark, values)
    present = [float(v) for v in values if v is not None]
    got = quantiles(df, ["v"], (0.25, 0.5, 0.9))["v"]
    for p, value in got.items():
        if not present:
            assert value is None
        else:
            assert value == pytest.approx(np.quantile(present, p), rel=1e-12, abs=1e-9)


def test_moments_of_missing_and_constant(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, 5.0)], "a double, b double, c double")
    m = moments(df, ["a", "b", "c"])
    assert (m["a"].mean, m["a"].missing, m["b"].count, m["b"].missing, m["c"].std_pop) == (2.0, 0, 0, 2, 0.0)


def test_quality_of_dirty_table(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(100):
        a = 100.0 if i == 0 else float(rng.normal(10, 2))
        b = 1000.0 if i == 1 else float(rng.uniform(0, 100))
        rows.append((None if 5 <= i < 10 else a, None if 15 <= i < 18 else b, None if i in (25, 26) else "ABC"[i % 3]))
    df = spark.createDataFrame(rows, "a double, b double, c string")
    missing = {r["column"]: r["missing"] for r in profile.missing(df).collect()}
    assert missing == {"a": 5, "b": 3, "c": 2}
    outliers = {r["column"]: r["outliers"] for r in profile.iqr_outliers(df).collect()}
    assert outliers["a"] > 0 and outliers["b"] > 0
    assert profile.total_missing(df).first()[0] == 10
    kinds = {r["column"]: r["kind"] for r in profile.dtypes(df).collect()}
    assert kinds == {"a": "numeric", "b": "numeric", "c": "categorical"}


def test_hot_value_categories(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c"))
    top = profile.categorical(df, ["c"]).orderBy("rank").collect()
    assert (top[0]["value"], top[0]["n"], top[0]["n_unique"], len(top)) == ("hot", 3000, 6001, 5)


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "a int, b string")
    assert profile.duplicates(df).first()["duplicates"] == 2


def test_correlation_with_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert explore.correlations(df).filter("column_a = 'a' AND column_b = 'b'").first()["r"] is None


def test_percentile_of_score_counts_whole_population(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(500, 4.0), rng.integers(0, 50, 1000)]).astype(float)
    asked = [-1.0, 0.0, 4.0, 17.5, 99.0]
    got = explore.percentile_of_score(frame(spark, values), frame(spark, asked), ["v"], buckets=16).collect()
    assert {r["value"]: round(r["percentile"], 9) for r in got} == {
        v: round(float(np.mean(values <= v) * 100), 9) for v in asked
    }


def test_histogram_keeps_every_row(spark):
    got = explore.histogram(frame(spark, [0, 0, 1, 10, None]), ["v"], 5).collect()
    assert [r["n"] for r in sorted(got, key=lambda r: r["bin"])] == [3, 0, 0, 0, 1]


def test_student_t_tail():
    # Closed forms for one and two degrees of freedom.
    for t in (0.3, 1.7, 12.0):
        assert student_t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-10)
        assert student_t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)


def test_top_columns_without_label(spark):
    df = spark.createDataFrame([tuple(float(i) for i in range(10))], ", ".join(f"c{i} double" for i in range(10)))
    rows = explore.top_correlated(df, None, 8).orderBy("rank").collect()
    assert [r["feature"] for r in rows] == [f"c{i}" for i in range(8)]


def test_nan_infinity_and_large_integers(spark):
    odd = [float("nan")] * 40 + [float("inf")] * 30 + [float("-inf")] * 30
    rows = [(2**60 + i, odd[i] if i < 100 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "big long, x double").repartition(5)
    counts = {"big": 3000, "x": 3000}
    ranks = {"big": [0, 7, 1500, 2999], "x": [0, 29, 30, 1499, 2930, 2960, 2999]}
    for limit in (50, 20_000):
        got = order_statistics(df, {n: F.col(n) for n in counts}, ranks, counts, gather_limit=limit, accuracy=100)
        assert [got["big", r] for r in ranks["big"]] == [2**60 + r for r in ranks["big"]]
        want = sorted((v for _, v in rows), key=lambda v: (v != v, v))
        assert repr([got["x", r] for r in ranks["x"]]) == repr([want[r] for r in ranks["x"]])
    assert quantiles(df, ["x"], (0.0, 0.999), counts)["x"][0.0] == float("-inf")
