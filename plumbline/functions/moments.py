"""Aggregate expressions over moments, and the scalar tail probabilities they need."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.columns import col


def pearson(a: str | Column, b: str | Column) -> Column:
    """Correlation over rows where both are present; NULL when either is constant.

    ``corr`` raises on a constant column under ANSI mode, hence the guarded quotient.
    """
    a, b = col(a).cast("double"), col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def adjusted_skewness(value: str | Column) -> Column:
    """Bias-corrected sample skewness (Spark's ``skewness`` is the population one)."""
    n = F.count(col(value)).cast("double")
    return F.when(n > 2, F.skewness(col(value)) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(value: str | Column) -> Column:
    """Bias-corrected excess kurtosis (Spark's ``kurtosis`` is the population excess)."""
    n = F.count(col(value)).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col(value)) + 6))


def jarque_bera(value: str | Column) -> Column:
    n = F.count(col(value)).cast("double")
    return n / 6 * (F.pow(F.skewness(col(value)), F.lit(2.0)) + F.pow(F.kurtosis(col(value)), F.lit(2.0)) / 4)


def student_t_two_sided(t: float, dof: float) -> float:
    """P(|T| > t) through the regularised incomplete beta function (continued fraction)."""
    if dof <= 0 or math.isnan(t):
        return math.nan
    x = dof / (dof + t * t)
    return _incomplete_beta(dof / 2, 0.5, x)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x > (a + 1) / (a + b + 2):
        return 1.0 - front * _beta_fraction(b, a, 1 - x) / b
    return front * _beta_fraction(a, b, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    result = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / c
            c = c if abs(c) > tiny else tiny
            result *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return result
