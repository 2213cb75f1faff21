"""Derived features as one projection; a feature exists only if its inputs do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import absolute_offset, euclidean, ratio, threshold_flag
from plumbline.operators.stats import quantiles

# The housing preset.
PLACES = {"DistanceToSF": (37.7749, -122.4194), "DistanceToLA": (34.0522, -118.2437)}
COAST_LONGITUDE = -120.0
NORTH_LATITUDE = 36.0
NEW_HOUSE_AGE, OLD_HOUSE_AGE = 10, 40
EPSILON = 1e-8
INTERACTIONS = (
    ("MedInc", "AveRooms"),
    ("MedInc", "HouseAge"),
    ("AveRooms", "AveBedrms"),
    ("Population", "AveOccup"),
    ("Latitude", "Longitude"),
)
POLYNOMIALS = ("MedInc", "AveRooms", "HouseAge")
INCOME = "MedInc"


def interactions(pairs: Sequence[tuple[str, str]]) -> dict[str, tuple[tuple[str, ...], Column]]:
    return {f"{a}_x_{b}": ((a, b), F.col(a) * F.col(b)) for a, b in pairs}


def polynomials(columns: Sequence[str], degree: int) -> dict[str, tuple[tuple[str, ...], Column]]:
    return {
        f"{c}_poly_{d}": ((c,), F.pow(F.col(c), F.lit(float(d)))) for c in columns for d in range(2, degree + 1)
    }


def quantile_flags(
    low_name: str, high_name: str, column: str, low: float | None, high: float | None
) -> dict[str, tuple[tuple[str, ...], Column]]:
    missing = F.lit(None).cast("double")
    return {
        high_name: ((column,), threshold_flag(column, ">", missing if high is None else F.lit(high))),
        low_name: ((column,), threshold_flag(column, "<", missing if low is None else F.lit(low))),
    }


def housing(available: Sequence[str], income_cut: tuple[float | None, float | None]) -> dict[str, tuple[tuple[str, ...], Column]]:
    """The housing preset: ``{name: (inputs, expression)}`` in output order."""
    density = (
        (("AveRooms", "AveOccup"), ratio("AveRooms", "AveOccup"))
        if "AveOccup" in available
        else (("AveRooms",), F.col("AveRooms"))
    )
    return {
        "RoomDensity": density,
        "BedroomRatio": (("AveBedrms", "AveRooms"), ratio("AveBedrms", "AveRooms", fill=0.0)),
        "PopulationDensity": (("Population", "AveOccup"), ratio("Population", "AveOccup", eps=EPSILON)),
        "IncomePerPerson": (("MedInc", "AveOccup"), ratio("MedInc", "AveOccup", eps=EPSILON)),
        "IsNewHouse": (("HouseAge",), threshold_flag("HouseAge", "<", NEW_HOUSE_AGE)),
        "IsOldHouse": (("HouseAge",), threshold_flag("HouseAge", ">", OLD_HOUSE_AGE)),
        **{
            name: (("Latitude", "Longitude"), euclidean("Latitude", "Longitude", lat, lon))
            for name, (lat, lon) in PLACES.items()
        },
        "CoastalProximity": (("Latitude", "Longitude"), absolute_offset("Longitude", COAST_LONGITUDE)),
        "IsNorthernCA": (("Latitude", "Longitude"), threshold_flag("Latitude", ">", NORTH_LATITUDE)),
        **quantile_flags("LowIncome", "HighIncome", INCOME, *income_cut),
    }


@dataclass(frozen=True)
class FeatureEngineerModel:
    config: "FeatureEngineer"
    income_cut: tuple[float | None, float | None]
    input_features: list[str] = field(default_factory=list)

    def definitions(self, available: Sequence[str]) -> dict[str, Column]:
        wanted: Mapping = housing(available, self.income_cut)
        if self.config.create_interactions:
            wanted = {**wanted, **interactions(INTERACTIONS)}
        if self.config.create_polynomials:
            wanted = {**wanted, **polynomials(POLYNOMIALS, self.config.degree)}
        return {name: expr for name, (inputs, expr) in wanted.items() if set(inputs) <= set(available)}

    def transform(self, df: DataFrame) -> DataFrame:
        model = self
        if self.config.scope == "batch" and INCOME in df.columns:
            model = FeatureEngineerModel(self.config, self.config.cut_income(df), self.input_features)
        derived = model.definitions(df.columns)
        return df.select("*", *[expr.alias(name) for name, expr in derived.items()])


@dataclass(frozen=True)
class FeatureEngineer:
    """Fits the income quartiles; ``scope="batch"`` takes them from each transformed frame instead."""

    create_interactions: bool = True
    create_polynomials: bool = False
    degree: int = 2
    scope: str = "fit"

    def cut_income(self, df: DataFrame) -> tuple[float | None, float | None]:
        cut = quantiles(df, [INCOME], (0.25, 0.75))[INCOME]
        return cut[0.25], cut[0.75]

    def fit(self, df: DataFrame, features: Sequence[str] | None = None) -> FeatureEngineerModel:
        cut = self.cut_income(df) if INCOME in df.columns else (None, None)
        return FeatureEngineerModel(self, cut, list(features or df.columns))
