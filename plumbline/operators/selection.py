"""Feature selection: F-test, mutual information, recursive elimination, lasso."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import equal_width_bin, numeric_columns
from plumbline.functions.moments import pearson
from plumbline.operators.cart import Growth
from plumbline.operators.forest import Spec, grow_trees, packed_rows, summary
from plumbline.operators.linear import cross_products, fold_rmse, solve, total
from plumbline.operators.splitting import fold_column
from plumbline.operators.stats import moments
from plumbline.session import small_frame

METHODS = ("f_test", "mutual_info", "rfe", "lasso")


def default_k(n_features: int) -> int:
    return min(n_features, max(5, n_features // 2))


def f_scores(df: DataFrame, features: Sequence[str], label: str) -> dict[str, float | None]:
    """``r^2 / (1 - r^2) * (n - 2)`` of every feature, from one aggregation."""
    row = df.agg(
        *[pearson(f, label).alias(f"r{i}") for i, f in enumerate(features)],
        *[F.count_if(F.col(f).isNotNull() & F.col(label).isNotNull()).alias(f"n{i}") for i, f in enumerate(features)],
    ).first()
    scores: dict[str, float | None] = {}
    for i, f in enumerate(features):
        r, n = row[f"r{i}"], row[f"n{i}"]
        scores[f] = None if r is None else (float("inf") if r * r >= 1 else r * r / (1 - r * r) * (n - 2))
    return scores


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """(feature, mutual_info) in nats over equal-width bins.

    All features share one shuffle of at most ``bins**2`` partial counts per feature and task.
    """
    s = {c: m for c, m in moments(df, [*features, label]).items() if m.count}
    label_bin = equal_width_bin(label, s[label].min, s[label].max, bins)
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            equal_width_bin(f, s[f].min, s[f].max, bins).alias("xb"),
            label_bin.alias("yb"),
        )
        for f in features
        if f in s
    ]
    joint = (
        df.select(F.inline(F.array(*cells)))
        .filter("xb IS NOT NULL AND yb IS NOT NULL")
        .groupBy("feature", "xb", "yb")
        .agg(F.count("*").cast("double").alias("n"))
    )
    by = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))  # noqa: E731 - bins**2 rows per feature
    return (
        joint.select("feature", "n", by().alias("all"), by("xb").alias("nx"), by("yb").alias("ny"))
        .groupBy("feature")
        .agg(F.sum(F.col("n") / F.col("all") * F.ln(F.col("n") * F.col("all") / (F.col("nx") * F.col("ny")))).alias("mutual_info"))
    )


@dataclass(frozen=True)
class SelectorModel:
    method: str
    selected: list[str]
    scores: dict[str, float | None]
    features: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Only the selected columns (and ``keep``); the scan reads no others."""
        return df.select(*keep, *[c for c in self.selected if c not in keep])

    def ranking(self) -> list[tuple[str, float | None]]:
        """Best first: smallest elimination rank, largest score otherwise."""
        sign = 1 if self.method == "rfe" else -1
        return sorted(self.scores.items(), key=lambda i: (i[1] is None, sign * (i[1] or 0.0), i[0]))

    def table(self, spark) -> DataFrame:
        rows = [
            (f, score, rank, f in self.selected) for rank, (f, score) in enumerate(self.ranking(), start=1)
        ]
        return small_frame(spark, rows, "feature string, score double, rank bigint, selected boolean")


@dataclass(frozen=True)
class FeatureSelector:
    method: str = "f_test"
    k: int | None = None
    ids: Sequence[str] = ()
    seed: int = 42
    trees: int = 50
    depth: int | None = None
    step: int = 1
    bins: int = 10

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")

    def fit(self, df: DataFrame, label: str, features: Sequence[str] | None = None) -> SelectorModel:
        features = list(features or numeric_columns(df, (label, *self.ids)))
        k = self.k or default_k(len(features))
        scores = getattr(self, f"_{self.method}")(df, label, features, k)
        if self.method == "rfe":
            kept = {f for f, rank in scores.items() if rank == 1}
        else:
            usable = [f for f in features if scores.get(f) is not None]
            if self.method == "lasso":
                usable = [f for f in usable if scores[f] > 1e-5]
            position = {f: i for i, f in enumerate(features)}
            kept = set(sorted(usable, key=lambda f: (-scores[f], position[f]))[:k])
        return SelectorModel(self.method, [f for f in features if f in kept], scores, features)

    def _f_test(self, df, label, features, k):
        return f_scores(df, features, label)

    def _mutual_info(self, df, label, features, k):
        rows = mutual_information(df, features, label, self.bins).collect()  # one row per feature
        return {r["feature"]: r["mutual_info"] for r in rows}

    def _lasso(self, df, label, features, k):
        """Absolute coefficients at the penalty with the least cross-validated error."""
        parts = cross_products(df, features, label, fold_column(self.ids, 5, self.seed) if self.ids else None)
        everything = total(parts)
        _, with_label, _, _ = everything.centered()
        largest = float(np.max(np.abs(with_label)))
        if largest == 0:
            return {f: 0.0 for f in features}
        penalties = largest * np.logspace(0, -3, 100)
        if len(parts) > 1:
            folds = {a: fold_rmse(parts, l1=a) for a in penalties}
            weights = {f: p.n for f, p in parts.items()}
            best = min(penalties, key=lambda a: sum(s * s for s in folds[a].values()) / len(weights))
        else:
            raise ValueError("lasso selection needs ids to make folds from")
        return dict(zip(features, map(float, np.abs(solve(everything, l1=best).coefficients))))

    def _rfe(self, df, label, features, k):
        """Drop the least important feature of a forest until ``k`` are left; rank 1 is kept. The rows are packed once for all forests."""
        left = list(features)
        rank = {}
        rows = packed_rows(df, features, label, self.ids)
        how = Growth(max_depth=self.depth)
        try:
            while len(left) > k:
                use = tuple(features.index(f) for f in left)
                specs = [Spec(len(left), t, self.seed, how, bootstrap=True, use=use) for t in range(self.trees)]
                importance = summary(grow_trees(rows, specs), len(features), "forest")[2]
                drop = sorted(range(len(left)), key=lambda i: importance[use[i]])[: min(self.step, len(left) - k)]
                for i in sorted(drop, reverse=True):
                    rank[left[i]] = float(len(left) - k + 1)
                    left.pop(i)
        finally:
            rows.blocks.unpersist()
        return {f: rank.get(f, 1.0) for f in features}


@dataclass(frozen=True)
class FeatureFlowModel:
    """Engineered features followed by the selected ones, as one projection."""

    engineer: object
    selector: SelectorModel
    keep: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [c for c in self.keep if c in df.columns]
        return self.selector.transform(self.engineer.transform(df), keep)

    def info(self, df: DataFrame) -> DataFrame:
        """(feature, original, selected, score) of every candidate feature."""
        rows = [
            (f, f in self.engineer.input_features, f in self.selector.selected, score)
            for f, score in self.selector.ranking()
        ]
        return small_frame(df.sparkSession, rows, "feature string, original boolean, selected boolean, score double")


@dataclass(frozen=True)
class FeatureFlow:
    engineer: object
    selector: FeatureSelector = FeatureSelector()
    keep: tuple[str, ...] = ()

    def fit(self, df: DataFrame, label: str, features: Sequence[str] | None = None) -> FeatureFlowModel:
        features = list(features or numeric_columns(df, (label, *self.keep)))
        engineered = self.engineer.fit(df, features)
        wide = engineered.transform(df)
        candidates = numeric_columns(wide, (label, *self.keep))
        candidates = [c for c in candidates if c in features or c not in df.columns]
        return FeatureFlowModel(engineered, self.selector.fit(wide, label, candidates), self.keep)


def schema_diff(expected: Sequence[str], available: Sequence[str]) -> list[tuple[str, str]]:
    """(feature, status): ``matching``, ``missing`` from the data, or ``extra`` in it."""
    have, want = set(available), set(expected)
    return [(f, "matching" if f in have else "missing") for f in expected] + [
        (f, "extra") for f in available if f not in want
    ]


def feature_schema_diff(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The schema difference with the number of usable values of every feature in the data."""
    status = small_frame(df.sparkSession, schema_diff(expected, df.columns), "feature string, status string")
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    filled = counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_values")) for c in df.columns])
        )
    )
    return status.join(F.broadcast(filled), "feature", "left").select(  # one row per column
        "feature", "status", F.coalesce("n_values", F.lit(0)).alias("n_values")
    )


def align(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The expected columns in their order; an error names those that are missing."""
    absent = [f for f in expected if f not in df.columns]
    if absent:
        raise ValueError(f"missing features: {absent}")
    return df.select(*keep, *expected)
