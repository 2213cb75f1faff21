"""Linear models from cross-product sums: one scan serves every fold and every penalty.

The sums of all folds come from one aggregation. Leaving a fold out is a
subtraction, and a penalty only changes the small system solved from the sums, so
a whole cross-validated path costs one pass over the data.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CrossProducts:
    """Sums over rows of (1, x..., y) products, around a fixed centre."""

    center: np.ndarray
    sums: np.ndarray

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def __sub__(self, other: "CrossProducts") -> "CrossProducts":
        return CrossProducts(self.center, self.sums - other.sums)

    def centered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Covariance of x, covariance of x with y, means, label mean (population)."""
        mean = self.sums[0, 1:] / self.n
        cov = self.sums[1:, 1:] / self.n - np.outer(mean, mean)
        return cov[:-1, :-1], cov[:-1, -1], mean[:-1] + self.center[:-1], mean[-1] + self.center[-1]

    def sse(self, fit: "LinearFit") -> float:
        """Sum of squared errors of a fit on these rows."""
        shift = fit.intercept + float(fit.coefficients @ self.center[:-1]) - self.center[-1]
        w = np.concatenate([[-shift], -fit.coefficients, [1.0]])
        return max(0.0, float(w @ self.sums @ w))


@dataclass(frozen=True)
class LinearFit:
    intercept: float
    coefficients: np.ndarray

    def column(self, features: Sequence[str]) -> Column:
        """The prediction as a plain expression."""
        total = F.lit(float(self.intercept))
        for name, weight in zip(features, self.coefficients):
            total = total + F.lit(float(weight)) * F.col(name)
        return total


def cross_products(df: DataFrame, features: Sequence[str], label: str, fold: Column | None = None) -> dict[int, CrossProducts]:
    """Cross products per fold (one fold ``0`` if none is given) over complete rows."""
    names = [*features, label]
    complete = df.dropna(subset=names)
    center = np.array([v or 0.0 for v in complete.agg(*[F.avg(c) for c in names]).first()], dtype=float)
    terms = [F.lit(1.0), *[F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(names, center)]]
    pairs = [(i, j) for i in range(len(terms)) for j in range(i + 1)]
    projected = complete.select(
        (fold if fold is not None else F.lit(0)).alias("fold"), *[t.alias(f"t{i}") for i, t in enumerate(terms)]
    )
    rows = (
        projected.groupBy("fold")
        .agg(*[F.sum(F.col(f"t{i}") * F.col(f"t{j}")).alias(f"s{i}_{j}") for i, j in pairs])
        .collect()
    )  # one row per fold
    result = {}
    for r in rows:
        sums = np.zeros((len(terms), len(terms)))
        for i, j in pairs:
            sums[i, j] = sums[j, i] = r[f"s{i}_{j}"]
        result[r["fold"]] = CrossProducts(center, sums)
    return result


def total(parts: Mapping[int, CrossProducts]) -> CrossProducts:
    parts = list(parts.values())
    return CrossProducts(parts[0].center, sum(p.sums for p in parts))


def solve(products: CrossProducts, l1: float = 0.0, l2: float = 0.0, iterations: int = 10_000, tol: float = 1e-12) -> LinearFit:
    """Minimise ``mse / 2 + l1 * |w|_1 + l2 / 2 * |w|_2^2`` with a free intercept."""
    cov, with_label, means, label_mean = products.centered()
    if l1 == 0.0:
        weights = np.linalg.lstsq(cov + l2 * np.eye(len(cov)), with_label, rcond=None)[0]
    else:
        weights = np.zeros(len(cov))
        for _ in range(iterations):
            change = 0.0
            for j in range(len(cov)):
                curvature = cov[j, j] + l2
                if curvature <= 0:
                    continue
                gradient = with_label[j] - cov[j] @ weights + cov[j, j] * weights[j]
                new = np.sign(gradient) * max(abs(gradient) - l1, 0.0) / curvature
                change = max(change, abs(new - weights[j]) * np.sqrt(curvature))
                weights[j] = new
            if change < tol:
                break
        else:
            warnings.warn(f"coordinate descent still moved by {change:.3g} after {iterations} sweeps", stacklevel=2)
    return LinearFit(float(label_mean - means @ weights), weights)


def fold_rmse(
    parts: Mapping[int, CrossProducts], l1: float = 0.0, l2: float = 0.0, alpha: float | None = None, iterations: int = 10_000
) -> dict[int, float]:
    """RMSE on every fold of the fit to the others. ``alpha`` is a ridge sum-of-squares penalty."""
    everything = total(parts)
    scores = {}
    for f, held_out in sorted(parts.items()):
        rest = everything - held_out
        fit = solve(rest, l1, l2 if alpha is None else alpha / rest.n, iterations)
        scores[f] = float(np.sqrt(held_out.sse(fit) / held_out.n))
    return scores
