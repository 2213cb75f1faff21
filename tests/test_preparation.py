import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import nan_to_null
from plumbline.operators import splitting
from plumbline.operators.cleaning import Imputer, OutlierCapper
from plumbline.operators.engineering import FeatureEngineer
from plumbline.operators.scaling import Scaler
from plumbline.operators.selection import FeatureFlow, FeatureSelector, align, default_k, schema_diff
from plumbline.plans.preprocess import Preprocessor
from plumbline.sources import artifacts, tables

HOUSE = "MedInc HouseAge AveRooms AveBedrms Population AveOccup Latitude Longitude".split()


def dirty(spark):
    rng = np.random.default_rng(42)
    rows = [
        (
            i,
            None if 5 <= i < 10 else (100.0 if i == 0 else float(rng.normal(10, 2))),
            None if 15 <= i < 18 else float(rng.uniform(0, 100)),
            None if i in (25, 26) else "ABC"[i % 3],
            float(rng.normal(50, 10)),
        )
        for i in range(100)
    ]
    return spark.createDataFrame(rows, "row_id bigint, a double, b double, c string, target double")


def housing(spark, n=100):
    rng = np.random.default_rng(42)
    spans = [(0.5, 15), (1, 52), (3, 10), (0.8, 2.5), (100, 5000), (2, 6), (32, 42), (-124, -114)]
    data = np.column_stack([rng.uniform(*s, n) for s in spans])
    y = 2 * data[:, 0] + 1.5 * data[:, 2] + 0.5 * rng.normal(size=n)
    rows = [(i, *map(float, data[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{c} double" for c in HOUSE) + ", target double")


@pytest.mark.parametrize("strategy", ["mean", "median", "most_frequent"])
def test_imputation_leaves_no_gap(spark, strategy):
    filled = Imputer(strategy).fit(dirty(spark)).transform(dirty(spark))
    assert filled.dropna().count() == 100


def test_imputation_edge_cases(spark):
    full = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Imputer().fit(full)
    assert model.transform(full).dtypes == full.dtypes and model.transform(full).exceptAll(full).isEmpty()
    with pytest.raises(ValueError):
        Imputer("meen")
    empty = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    got = Imputer().fit(empty).transform(empty).collect()
    assert [r["a"] for r in got] == [1.0, 1.0] and [r["b"] for r in got] == [None, None]


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int"))
    assert df.filter("a IS NULL").count() == 1


def test_capping(spark):
    df = dirty(spark)
    model = OutlierCapper("iqr", columns=["a", "b"]).fit(df)
    capped = model.transform(df)
    assert capped.count() == 100
    assert model.info(capped).agg(F.sum("outliers")).first()[0] == 0
    assert capped.filter("a IS NULL").count() == 5
    with pytest.raises(ValueError):
        OutlierCapper("other")
    constant = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    for method in ("iqr", "zscore"):
        fitted = OutlierCapper(method).fit(constant)
        assert [r[0] for r in fitted.transform(constant).collect()] == [5.0, 5.0]


@pytest.mark.parametrize("method", ["standard", "robust", "minmax"])
def test_scaling(spark, method):
    df = housing(spark)
    got = Scaler(method, HOUSE).fit(df).transform(df)
    x = np.array([list(r) for r in df.select(HOUSE).collect()])
    want = {
        "standard": (x - x.mean(0)) / x.std(0),
        "robust": (x - np.median(x, 0)) / (np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)),
        "minmax": (x - x.min(0)) / (x.max(0) - x.min(0)),
    }[method]
    assert np.allclose(np.array([list(r) for r in got.select(HOUSE).collect()]), want)
    with pytest.raises(ValueError):
        Scaler("other")


@pytest.mark.parametrize("size", [0.2, 0.3, 0.001])
def test_exact_split(spark, size):
    df = spark.range(997).withColumnRenamed("id", "row_id")
    got = splitting.split_exact(df, ["row_id"], size)
    again = splitting.split_exact(df.repartition(7), ["row_id"], size)
    assert got.filter("split = 'test'").count() == math.ceil(size * 997)
    assert got.exceptAll(again).count() == 0


def test_exact_split_with_equal_keys(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    monkeypatch.setattr(splitting, "row_key", lambda *ids, seed=42: F.col("row_id") % 3)
    got = splitting.split_exact(df, ["row_id"], 0.2)
    test = sorted(r["row_id"] for r in got.filter("split = 'test'").collect())
    assert test == [i for i in range(500) if i % 3 == 0][:100]


def test_exact_split_with_gaps_in_the_ids(spark):
    """Keys leave out nulls: (1, null) and (null, 1) agree in all of them, but are two rows."""
    rows = [(i, None) for i in range(40)] + [(None, i) for i in range(40)]
    df = spark.createDataFrame(rows, "a long, b long")
    for size in (0.1125, 0.3125, 0.5125):  # an odd number of rows
        got = splitting.split_exact(df, ["a", "b"], size)
        assert got.filter("split = 'test'").count() == math.ceil(size * 80 - 1e-9)
    same = splitting.split_exact(spark.createDataFrame([(7, None)] * 9, "a long, b long"), ["a", "b"], 0.3)
    assert same.select("split").distinct().count() == 1  # rows with the same ids stay together


def test_stratified_split_keeps_shares(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 100).cast("double").alias("y"))
    got = splitting.split_stratified(df, ["row_id"], "y").groupBy("y").pivot("split").count()
    total = splitting.split_stratified(df, ["row_id"], "y").filter("split = 'test'").count()
    assert total == 200 and got.count() == 100


def test_folds(spark):
    df = spark.range(1003).withColumnRenamed("id", "row_id")
    sizes = [r["count"] for r in splitting.contiguous_folds(df, "row_id", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [201, 201, 201, 200, 200]
    shuffled = df.groupBy(splitting.fold_column(["row_id"]).alias("f")).count().collect()
    assert len(shuffled) == 5 and min(r["count"] for r in shuffled) > 150


@pytest.mark.parametrize("fit_on,split", [("all", "exact"), ("train", "threshold"), ("all", "stratified")])
def test_whole_preparation(spark, fit_on, split):
    prepared = Preprocessor(fit_on=fit_on, split=split, test_size=0.3).run(dirty(spark), ["row_id"], "target", report_quality=True)
    assert prepared.train.count() + prepared.test.count() == 100
    if split == "exact":
        assert prepared.test.count() == 30
    mean = prepared.train.agg(F.avg("a_scaled"), F.avg("b_scaled")).first()
    assert max(abs(v) for v in mean) < 1e-10
    assert prepared.quality.filter("section = 'missing'").count() > 0
    with pytest.raises(ValueError):
        Preprocessor(split="other").run(dirty(spark), ["row_id"], "target")


def test_housing_features(spark):
    df = housing(spark)
    wide = FeatureEngineer(create_polynomials=True, degree=3).fit(df.drop("target"), HOUSE).transform(df.drop("target"))
    assert len(wide.columns) == 1 + 25 + 6
    assert wide.filter("BedroomRatio < 0 OR BedroomRatio > 1").count() == 0
    for flag in ("IsNewHouse", "IsOldHouse", "IsNorthernCA", "HighIncome", "LowIncome"):
        assert wide.filter(~F.col(flag).isin(0, 1)).count() == 0
    assert wide.filter("abs(MedInc_x_AveRooms - MedInc * AveRooms) > 1e-9 OR abs(MedInc_poly_3 - MedInc * MedInc * MedInc) > 1e-6").count() == 0
    assert wide.agg(F.sum("HighIncome"), F.sum("LowIncome")).first() == (25, 25)
    assert wide.select(HOUSE).exceptAll(df.select(HOUSE)).count() == 0


def test_income_flags_of_a_single_row(spark):
    df = housing(spark)
    rich = df.orderBy(F.desc("MedInc")).limit(1)
    assert FeatureEngineer().fit(df).transform(rich).first()["HighIncome"] == 1
    assert FeatureEngineer(scope="batch").fit(df).transform(rich).first()["HighIncome"] == 0


def test_division_by_zero_is_defined(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0)], "AveRooms double, AveBedrms double, AveOccup double")
    row = FeatureEngineer().fit(df).transform(df).first()
    assert row["RoomDensity"] is None and row["BedroomRatio"] == 0.0


def selector_table(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(200, 8))
    y = 2 * x[:, 0] + 1.5 * x[:, 1] + 0.5 * x[:, 2] + 0.1 * rng.normal(size=200)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(200)]
    return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"f{i} double" for i in range(8)) + ", y double")


@pytest.mark.parametrize("method,k", [("f_test", 3), ("mutual_info", 3), ("rfe", 5), ("lasso", 3)])
def test_selection(spark, method, k):
    df = selector_table(spark)
    model = FeatureSelector(method, k, ["row_id"], trees=5).fit(df, "y")
    assert "f0" in model.selected and "f1" in model.selected
    assert len(model.selected) <= k and (method == "lasso" or len(model.selected) == k)
    assert model.transform(df).columns == model.selected
    assert model.ranking()[0][0] in model.selected
    if method in ("f_test", "lasso"):
        assert set(model.selected) == {"f0", "f1", "f2"}


def test_selection_contract():
    with pytest.raises(ValueError):
        FeatureSelector("other")
    assert (default_k(25), default_k(8), default_k(3)) == (12, 5, 3)
    assert dict(schema_diff(["a", "b"], ["b", "c"])) == {"a": "missing", "b": "matching", "c": "extra"}


def test_feature_flow_stored_and_loaded(spark, tmp_path):
    df = housing(spark, 200)
    flow = FeatureFlow(FeatureEngineer(), FeatureSelector("f_test", 15, ["row_id"]), ("row_id",)).fit(df, "target", HOUSE)
    made = flow.transform(df)
    assert len(made.columns) == 16 and "MedInc" in made.columns
    assert flow.info(df).filter("selected").count() == 15
    artifacts.save_fitted(spark, str(tmp_path / "flow"), flow=flow)
    loaded = artifacts.load_fitted(spark, str(tmp_path / "flow"))["flow"]
    assert loaded.transform(df).exceptAll(made).count() == 0
    with pytest.raises(ValueError):
        align(df, ["Bedrooms"])


def test_selection_prunes_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    capped = OutlierCapper("iqr", columns=["value"]).fit(events).transform(events.select("event_id", "value"))
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "Exchange" not in plan


def test_sources(spark, tmp_path):
    df = housing(spark)
    for fmt, schema in (("csv", tables.HOUSING_SCHEMA), ("parquet", None), ("orc", None), ("json", tables.HOUSING_SCHEMA)):
        path = str(tmp_path / fmt)
        got = tables.load(spark, path, fmt, schema, provider=lambda: df)
        assert got.select(df.columns).exceptAll(df).count() == 0
    with pytest.raises(ValueError):
        tables.load(spark, str(tmp_path), "pickle")
    with pytest.raises(ValueError):
        tables.land(df, str(tmp_path), "pickle")
    with pytest.raises(ValueError):
        tables.load(spark, str(tmp_path / "csv"), "csv")
    info = tables.dataset_info(df, tables.HOUSING_COLUMNS, ("row_id", "target")).collect()
    assert len(info) == 8 and {r["n_samples"] for r in info} == {100}
    y = tables.attach_label(*tables.split_features_label(df))
    assert y.select(df.columns).exceptAll(df).count() == 0
