"""Imputation and outlier capping: fitted numbers applied as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import categorical_columns, clamp, numeric_columns
from plumbline.operators.profile import iqr_bounds, outside
from plumbline.operators.stats import moments, per_column, quantiles, value_counts

STRATEGIES = ("mean", "median", "most_frequent")
OUTLIER_METHODS = ("iqr", "zscore")


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column (the smallest on ties), without gathering a column's values."""
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )
    return {r["column"]: r["mode"] for r in best.collect()}  # one row per column


@dataclass(frozen=True)
class ImputerModel:
    strategy: str
    fills: dict[str, float | str]
    complete: tuple[str, ...] = ()  # columns without a gap when fitted: they keep their type

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fills:
            return df
        return df.select(
            *[
                F.coalesce(F.col(f.name), F.lit(self.fills[f.name]).cast(self._type(f))).alias(f.name)
                if f.name in self.fills
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    def _type(self, f) -> str:
        return f.dataType.simpleString() if isinstance(self.fills[f.name], str) or f.name in self.complete else "double"


@dataclass(frozen=True)
class Imputer:
    """Fill missing numbers with the mean or median and other columns with their mode.

    A strategy meant for categories (``most_frequent``) means the median for numbers.
    A column without any value stays as it is; one without a gap is fitted too, for gaps that come later.
    """

    strategy: str = "median"
    columns: Sequence[str] | None = None
    accuracy: int | None = None

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")

    def fit(self, df: DataFrame) -> ImputerModel:
        columns = list(self.columns or df.columns)
        numeric = [c for c in numeric_columns(df) if c in columns]
        other = [c for c in categorical_columns(df) if c in columns]
        present = df.agg(
            *[F.count(c).alias(f"n_{c}") for c in columns], *[F.avg(c).alias(f"mean_{c}") for c in numeric], F.count("*").alias("rows")
        ).first()
        filled = [c for c in columns if present[f"n_{c}"]]
        complete = tuple(c for c in filled if present[f"n_{c}"] == present["rows"])
        fills: dict[str, float | str] = {}
        numbers = [c for c in numeric if c in filled]
        if self.strategy == "mean":
            fills.update({c: present[f"mean_{c}"] for c in numbers})
        elif numbers:
            cut = quantiles(df, numbers, (0.5,), {c: present[f"n_{c}"] for c in numbers}, self.accuracy)
            fills.update({c: cut[c][0.5] for c in numbers})
        fills.update(modes(df, [c for c in other if c in filled]))
        return ImputerModel(self.strategy, fills, complete)


@dataclass(frozen=True)
class CapperModel:
    method: str
    factor: float
    detect: dict[str, tuple[float, float]]
    caps: dict[str, tuple[float, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[clamp(c, *self.caps[c]).alias(c) if c in self.caps else F.col(c) for c in df.columns])

    def outliers(self, df: DataFrame) -> DataFrame:
        """Rows with at least one value beyond the detection bounds."""
        masks = [outside(c, self.detect) for c in self.detect]
        test = F.lit(False)
        for mask in masks:
            test = test | F.coalesce(mask, F.lit(False))
        return df.filter(test)

    def info(self, df: DataFrame) -> DataFrame:
        """(column, outliers, outlier_pct) from one counting pass."""
        return per_column(
            df,
            list(self.detect),
            outliers=lambda c: F.count_if(outside(c, self.detect)),
            outlier_pct=lambda c: F.try_divide(F.count_if(outside(c, self.detect)) * F.lit(100.0), F.count("*")),
        )


@dataclass(frozen=True)
class OutlierCapper:
    """Winsorise to the IQR fences, or to three standard deviations where a z-score exceeds ``factor``.

    Z-scores ignore missing values. Only columns with at least one z-score outlier are capped.
    """

    method: str = "iqr"
    factor: float = 1.5
    columns: Sequence[str] | None = None
    accuracy: int | None = None

    def __post_init__(self):
        if self.method not in OUTLIER_METHODS:
            raise ValueError(f"method must be one of {OUTLIER_METHODS}")

    def fit(self, df: DataFrame) -> CapperModel:
        columns = list(self.columns or numeric_columns(df))
        if self.method == "iqr":
            bounds = iqr_bounds(df, columns, self.factor, accuracy=self.accuracy)
            return CapperModel(self.method, self.factor, bounds, bounds)
        stats = {c: s for c, s in moments(df, columns).items() if s.std_pop}
        detect = {c: (s.mean - self.factor * s.std_pop, s.mean + self.factor * s.std_pop) for c, s in stats.items()}
        # The range shows whether any value lies beyond the bounds; no further pass is needed.
        hit = [c for c, s in stats.items() if s.min < detect[c][0] or s.max > detect[c][1]]
        caps = {c: (stats[c].mean - 3 * stats[c].std, stats[c].mean + 3 * stats[c].std) for c in hit}
        return CapperModel(self.method, self.factor, detect, caps)
