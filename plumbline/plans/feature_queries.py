"""Registered queries: derived features and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.columns import absolute_offset, euclidean, ratio, threshold_flag
from plumbline.operators import engineering, selection
from plumbline.operators.engineering import FeatureEngineer
from plumbline.operators.selection import FeatureFlow, FeatureSelector
from plumbline.plans.frames import (
    HOUSE_FEATURES,
    HOUSE_SQL,
    HOUSE_X_SQL,
    REG_FEATURES,
    REG_IDS,
    REG_SQL,
    Registry,
    house_frame,
    r,
    reg_frame,
    rounded,
)

registry = Registry()

# The preset's features as SQL, keyed by name.
DERIVED_SQL = {
    "RoomDensity": "AveRooms / AveOccup",
    "BedroomRatio": "coalesce(AveBedrms / nullif(AveRooms, 0), 0)",
    "PopulationDensity": "Population / (AveOccup + 1e-8)",
    "IncomePerPerson": "MedInc / (AveOccup + 1e-8)",
    "IsNewHouse": "CAST(coalesce(HouseAge < 10, false) AS INTEGER)",
    "IsOldHouse": "CAST(coalesce(HouseAge > 40, false) AS INTEGER)",
    "DistanceToSF": "sqrt(pow(Latitude - 37.7749::DOUBLE, 2) + pow(Longitude - -122.4194::DOUBLE, 2))",
    "DistanceToLA": "sqrt(pow(Latitude - 34.0522::DOUBLE, 2) + pow(Longitude - -118.2437::DOUBLE, 2))",
    "CoastalProximity": "abs(Longitude - -120.0::DOUBLE)",
    "IsNorthernCA": "CAST(coalesce(Latitude > 36.0::DOUBLE, false) AS INTEGER)",
    "HighIncome": "CAST(coalesce(MedInc > q75, false) AS INTEGER)",
    "LowIncome": "CAST(coalesce(MedInc < q25, false) AS INTEGER)",
}
INTERACTION_SQL = {f"{a}_x_{b}": f"{a} * {b}" for a, b in engineering.INTERACTIONS}
POLYNOMIAL_SQL = {f"{c}_poly_{p}": f"pow({c}, {p})" for c in engineering.POLYNOMIALS for p in (2, 3)}
INCOME_CUT = "(SELECT quantile_cont(MedInc, 0.25) AS q25, quantile_cont(MedInc, 0.75) AS q75 FROM house)"
FLAGS = {"IsNewHouse", "IsOldHouse", "IsNorthernCA", "HighIncome", "LowIncome"}
CANDIDATES = [*HOUSE_FEATURES, *DERIVED_SQL, *INTERACTION_SQL]


def derived(names, view: str = HOUSE_X_SQL, originals=(), extra: str = "") -> str:
    every = {**DERIVED_SQL, **INTERACTION_SQL, **POLYNOMIAL_SQL}
    columns = ", ".join((f"{every[n]} AS {n}" if n in FLAGS else f"{r(every[n])} AS {n}") for n in names)
    kept = "".join(f"{r(c)} AS {c}, " for c in originals)
    return f"WITH {view} SELECT row_id, {kept}{columns}{extra} FROM house, {INCOME_CUT}"


def _house(spark, d):
    return house_frame(spark, d, label=False)


@registry.add("feat_ratio", derived(["RoomDensity"]))
def _(spark, d):
    return rounded(_house(spark, d).select("row_id", ratio("AveRooms", "AveOccup").alias("RoomDensity")))


@registry.add("feat_ratio_fill0", derived(["BedroomRatio"]))
def _(spark, d):
    return rounded(_house(spark, d).select("row_id", ratio("AveBedrms", "AveRooms", fill=0.0).alias("BedroomRatio")))


@registry.add("feat_ratio_eps", derived(["PopulationDensity", "IncomePerPerson"]))
def _(spark, d):
    return rounded(
        _house(spark, d).select(
            "row_id",
            ratio("Population", "AveOccup", eps=engineering.EPSILON).alias("PopulationDensity"),
            ratio("MedInc", "AveOccup", eps=engineering.EPSILON).alias("IncomePerPerson"),
        )
    )


@registry.add("feat_threshold_flag", derived(["IsNewHouse", "IsOldHouse", "IsNorthernCA"]))
def _(spark, d):
    return _house(spark, d).select(
        "row_id",
        threshold_flag("HouseAge", "<", engineering.NEW_HOUSE_AGE).alias("IsNewHouse"),
        threshold_flag("HouseAge", ">", engineering.OLD_HOUSE_AGE).alias("IsOldHouse"),
        threshold_flag("Latitude", ">", engineering.NORTH_LATITUDE).alias("IsNorthernCA"),
    )


@registry.add("feat_distance", derived(["DistanceToSF", "DistanceToLA"]))
def _(spark, d):
    return rounded(
        _house(spark, d).select(
            "row_id", *[euclidean("Latitude", "Longitude", *at).alias(name) for name, at in engineering.PLACES.items()]
        )
    )


@registry.add("feat_abs_offset", derived(["CoastalProximity"]))
def _(spark, d):
    return rounded(
        _house(spark, d).select("row_id", absolute_offset("Longitude", engineering.COAST_LONGITUDE).alias("CoastalProximity"))
    )


@registry.add("feat_quantile_flag", derived(["HighIncome", "LowIncome"]))
def _(spark, d):
    house = _house(spark, d)
    low, high = FeatureEngineer().cut_income(house)
    flags = engineering.quantile_flags("LowIncome", "HighIncome", "MedInc", low, high)
    return house.select("row_id", *[expr.alias(name) for name, (_, expr) in flags.items()])


@registry.add("feat_interactions", derived(INTERACTION_SQL))
def _(spark, d):
    made = engineering.interactions(engineering.INTERACTIONS)
    return rounded(_house(spark, d).select("row_id", *[expr.alias(name) for name, (_, expr) in made.items()]))


@registry.add("feat_polynomial", derived(POLYNOMIAL_SQL))
def _(spark, d):
    made = engineering.polynomials(engineering.POLYNOMIALS, 3)
    return rounded(_house(spark, d).select("row_id", *[expr.alias(name) for name, (_, expr) in made.items()]))


@registry.add(
    "feat_conditional_schema",
    f"WITH {HOUSE_X_SQL} SELECT row_id, AveRooms, AveBedrms, HouseAge, AveRooms AS RoomDensity, {r(DERIVED_SQL['BedroomRatio'])} AS BedroomRatio, "
    f"{DERIVED_SQL['IsNewHouse']} AS IsNewHouse, {DERIVED_SQL['IsOldHouse']} AS IsOldHouse, AveRooms * AveBedrms AS AveRooms_x_AveBedrms FROM house",
)
def _(spark, d):
    partial = _house(spark, d).select("row_id", "AveRooms", "AveBedrms", "HouseAge")
    return rounded(FeatureEngineer().fit(partial).transform(partial))


@registry.add(
    "feature_engineer",
    derived([*DERIVED_SQL, *INTERACTION_SQL, *[n for n in POLYNOMIAL_SQL if n.endswith("2")]], originals=HOUSE_FEATURES),
)
def _(spark, d):
    house = _house(spark, d)
    return rounded(FeatureEngineer(create_polynomials=True).fit(house, HOUSE_FEATURES).transform(house))


def f_test_sql(source: str, features, label: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, pow(corr({f}, {label}), 2) / (1 - pow(corr({f}, {label}), 2)) * (count(*) - 2) AS score FROM {source}"
        for f in features
    )
    return f"f AS (SELECT *, row_number() OVER (ORDER BY score DESC, feature) AS rank FROM ({rows}))"


WIDE_SQL = f"""{HOUSE_SQL}, wide AS (SELECT house.*, {", ".join(f"{e} AS {n}" for n, e in {**DERIVED_SQL, **INTERACTION_SQL}.items())}
FROM house, {INCOME_CUT})"""


@registry.add(
    "select_f_test",
    f"WITH {REG_SQL}, {f_test_sql('reg', REG_FEATURES, 'label')} SELECT feature, round(score, 3) AS score, rank, rank <= 3 AS selected FROM f",
)
def _(spark, d):
    return rounded(FeatureSelector("f_test", 3, REG_IDS).fit(reg_frame(spark, d), "label").table(spark), 3)


def mutual_sql(source: str, features, label: str, bins: int = 10) -> str:
    def cell(c):
        return f"greatest(0, least({bins - 1}, floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / {bins}))))"

    limits = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in [*features, label])
    binned = " UNION ALL ".join(f"SELECT '{f}' AS feature, {cell(f)} AS xb, {cell(label)} AS yb FROM {source}, lim" for f in features)
    return f"""lim AS (SELECT {limits} FROM {source}), j AS (SELECT feature, xb, yb, count(*)::DOUBLE AS n FROM ({binned}) GROUP BY ALL),
    w AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, xb) AS nx,
                 sum(n) OVER (PARTITION BY feature, yb) AS ny FROM j)
    SELECT feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mutual_info FROM w GROUP BY feature"""


@registry.add("select_mutual_info", f"WITH {REG_SQL}, {mutual_sql('reg', REG_FEATURES, 'label')}")
def _(spark, d):
    return rounded(selection.mutual_information(reg_frame(spark, d), REG_FEATURES, "label"))


@registry.add("select_rfe")
def _(spark, d):
    selector = FeatureSelector("rfe", 2, REG_IDS)
    return selector.fit(reg_frame(spark, d), "label", REG_FEATURES).table(spark)


@registry.add("select_lasso")
def _(spark, d):
    return rounded(FeatureSelector("lasso", 4, REG_IDS).fit(reg_frame(spark, d), "label", REG_FEATURES).table(spark))


@registry.add(
    "selector_transform",
    f"WITH {REG_SQL} SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, p_retailprice FROM reg",
)
def _(spark, d):
    reg = reg_frame(spark, d)
    return FeatureSelector("f_test", 4, REG_IDS).fit(reg, "label").transform(reg, REG_IDS)


@registry.add(
    "feature_score_rank",
    f"WITH {WIDE_SQL}, {f_test_sql('wide', CANDIDATES, 'target')} SELECT feature, round(score, 3) AS score, rank FROM f",
)
def _(spark, d):
    house = house_frame(spark, d)
    wide = FeatureEngineer().fit(house, HOUSE_FEATURES).transform(house)
    model = FeatureSelector("f_test", ids=["row_id"]).fit(wide, "target", CANDIDATES)
    return rounded(model.table(spark).drop("selected"), 3)


def _flow(house):
    flow = FeatureFlow(FeatureEngineer(), FeatureSelector("f_test", 15, ["row_id"]), ("row_id",))
    return flow.fit(house, "target", HOUSE_FEATURES)


@registry.add(
    "feature_flow",
    f"""WITH {WIDE_SQL}, {f_test_sql('wide', CANDIDATES, 'target')},
    long AS ({" UNION ALL ".join(f"SELECT row_id, '{c}' AS feature, {c}::DOUBLE AS value FROM wide" for c in CANDIDATES)})
    SELECT row_id, feature, {r("value")} AS value FROM long JOIN f USING (feature) WHERE rank <= 15""",
)
def _(spark, d):
    house = house_frame(spark, d)
    selected = _flow(house).transform(house)
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in selected.columns[1:]]
    return rounded(selected.select("row_id", F.inline(F.array(*cells))))


@registry.add(
    "feature_info",
    f"""WITH {WIDE_SQL}, {f_test_sql('wide', CANDIDATES, 'target')}
    SELECT feature, feature IN ({", ".join(f"'{c}'" for c in HOUSE_FEATURES)}) AS original, rank <= 15 AS selected, round(score, 3) AS score FROM f""",
)
def _(spark, d):
    house = house_frame(spark, d)
    return rounded(_flow(house).info(house), 3)


EXPECTED = [*HOUSE_FEATURES, "OceanDistance", "Bedrooms"]


@registry.add(
    "feature_schema_diff",
    f"WITH {HOUSE_SQL} "
    + " UNION ALL ".join(
        [f"SELECT '{c}' AS feature, 'matching' AS status, count({c}) AS n_values FROM house" for c in HOUSE_FEATURES]
        + [f"SELECT '{c}', 'missing', 0" for c in ("OceanDistance", "Bedrooms")]
        + [f"SELECT '{c}', 'extra', count({c}) FROM house" for c in ("row_id", "target")]
    ),
)
def _(spark, d):
    return selection.feature_schema_diff(house_frame(spark, d), EXPECTED)
