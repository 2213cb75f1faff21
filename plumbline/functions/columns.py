"""Scalar column expressions; every one stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

# Bits of the md5 digest used as a row key: 13 hex digits, exact in a double too.
KEY_HEX_DIGITS = 13
KEY_SPACE = 16**KEY_HEX_DIGITS


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is how pandas marks a missing number; SQL aggregates need NULL instead."""
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType) and f.name not in exclude]


def ratio(numerator: str | Column, denominator: str | Column, fill: float | None = None, eps: float = 0.0) -> Column:
    """``numerator / (denominator + eps)``; NULL (or ``fill``) where that is undefined."""
    bottom = col(denominator) + F.lit(eps) if eps else col(denominator)
    result = F.try_divide(col(numerator).cast("double"), bottom.cast("double"))
    return result if fill is None else F.coalesce(result, F.lit(float(fill)))


def threshold_flag(value: str | Column, op: str, bound: float | Column) -> Column:
    """1 where the comparison holds, 0 where it fails or the value is missing."""
    bound = bound if isinstance(bound, Column) else F.lit(bound)
    test = col(value) < bound if op == "<" else col(value) > bound
    return F.coalesce(test.cast("int"), F.lit(0))


def euclidean(x: str | Column, y: str | Column, x0: float, y0: float) -> Column:
    return F.sqrt(F.pow(col(x) - F.lit(x0), F.lit(2.0)) + F.pow(col(y) - F.lit(y0), F.lit(2.0)))


def absolute_offset(value: str | Column, origin: float) -> Column:
    return F.abs(col(value) - F.lit(origin))


def clamp(value: str | Column, low: float | None, high: float | None) -> Column:
    """Limit to ``[low, high]`` and keep NULL as NULL (``greatest``/``least`` would not)."""
    value = col(value)
    if low is None or high is None:
        return value
    limited = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value.cast("double")))
    return F.when(value.isNotNull(), limited)


def row_key(*ids: str | Column, seed: int = 42) -> Column:
    """A uniform integer in ``[0, 16**13)`` that depends only on the row's ids and the seed.

    Unlike ``rand``, it gives the same split whatever the partitioning and however
    often a lost task is run again.
    """
    text = F.concat_ws("|", *[col(i).cast("string") for i in ids], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_HEX_DIGITS), 16, 10).cast("bigint")


def fraction_threshold(fraction: float) -> int:
    """Keys below this number are ``fraction`` of all keys."""
    return int(round(fraction * KEY_SPACE))


def equal_width_bin(value: str | Column, low: float, high: float, bins: int) -> Column:
    """0-based equal-width bin; the maximum belongs to the last bin, one bin if all are equal."""
    width = (high - low) / bins
    if width <= 0:
        return F.when(col(value).isNotNull(), F.lit(0)).cast("int")
    raw = F.floor((col(value).cast("double") - F.lit(low)) / F.lit(width))
    return F.when(col(value).isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), raw))).cast("int")
