"""Data profiling: missing values, duplicates, summaries, categories, quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import categorical_columns, numeric_columns
from plumbline.operators.stats import Moments, moments, per_column, quantiles, value_counts
from plumbline.session import small_frame

QUARTILES = (0.25, 0.5, 0.75)
DESCRIBE_DDL = (
    "column string, count bigint, mean double, std double, min double, "
    "q25 double, q50 double, q75 double, max double"
)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, missing_pct) from one pass."""
    return per_column(
        df,
        columns or df.columns,
        missing=lambda c: F.count_if(F.col(c).isNull()),
        missing_pct=lambda c: F.try_divide(F.count_if(F.col(c).isNull()) * F.lit(100.0), F.count("*")),
    )


def total_missing(df: DataFrame) -> DataFrame:
    return df.agg(sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint").alias("total_missing"))


def duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Equal rows are combined before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
        F.try_divide(F.sum(F.col("__n") - 1) * F.lit(100.0), F.sum("__n")).alias("duplicate_pct"),
    )


def dtypes(df: DataFrame) -> DataFrame:
    numeric = set(numeric_columns(df))
    rows = [
        (f.name, f.dataType.simpleString(), "numeric" if f.name in numeric else "categorical")
        for f in df.schema.fields
    ]
    return small_frame(df.sparkSession, rows, "column string, dtype string, kind string")


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, stats: dict[str, Moments] | None = None, accuracy: int | None = None
) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    stats = stats or moments(df, columns)
    cut = quantiles(df, columns, QUARTILES, {c: s.count for c, s in stats.items()}, accuracy)
    rows = [
        (c, s.count, s.mean, s.std, s.min, *[cut[c][p] for p in QUARTILES], s.max) for c, s in stats.items()
    ]
    return small_frame(df.sparkSession, rows, DESCRIBE_DDL)


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, counts: dict[str, int] | None = None, accuracy: int | None = None
) -> dict[str, tuple[float, float]]:
    """``{column: (q25 - factor * iqr, q75 + factor * iqr)}``; columns without values are left out."""
    cut = quantiles(df, list(columns), (0.25, 0.75), counts, accuracy)
    bounds = {}
    for c in columns:
        q1, q3 = cut[c][0.25], cut[c][0.75]
        if q1 is not None:
            bounds[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


def outside(column: str, bounds: dict[str, tuple[float, float]]) -> Column:
    if column not in bounds:
        return F.lit(False)
    low, high = bounds[column]
    return (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    """(column, outliers) outside the IQR fences, all columns in one counting pass."""
    columns = list(columns or numeric_columns(df))
    bounds = iqr_bounds(df, columns, factor)
    return per_column(df, columns, outliers=lambda c: F.count_if(outside(c, bounds)))


def categorical(df: DataFrame, columns: Sequence[str] | None = None, top: int = 5) -> DataFrame:
    """Distinct values, mode and the ``top`` most frequent values of every categorical column.

    The rank filter becomes a group limit below the shuffle, so a column with very
    many values sends only ``top`` rows per task to the task that ranks it.
    """
    columns = list(columns or categorical_columns(df))
    counts = value_counts(df, columns)
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    unique = counts.groupBy("column").agg(F.count("*").alias("n_unique"))
    return (
        ranked.join(F.broadcast(unique), "column")  # one row per column
        .select("column", "n_unique", F.col("rank").cast("bigint").alias("rank"), "value", "n")
    )


def min_max_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(
        df,
        columns,
        min=lambda c: F.min(c).cast("double"),
        max=lambda c: F.max(c).cast("double"),
        mean=lambda c: F.avg(c),
    )


def target_stats(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.avg(label).alias("mean"), F.min(label).alias("min"), F.max(label).alias("max"), F.stddev_samp(label).alias("std")
    )


def _long(df: DataFrame, section: str, metrics: Sequence[str], column: str | None = "column") -> DataFrame:
    """Rows of a wide summary as (section, column, metric, value)."""
    name = F.col(column) if column else F.lit("*")
    return df.select(
        F.lit(section).alias("section"),
        name.alias("column"),
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def overview(df: DataFrame) -> DataFrame:
    """Shape, missing values, duplicates, numeric summary and categories as one long table."""
    numeric, other = numeric_columns(df), categorical_columns(df)
    parts = [
        _long(shape(df), "shape", ["n_rows", "n_cols"], None),
        _long(missing(df), "missing", ["missing", "missing_pct"]),
        _long(total_missing(df), "missing", ["total_missing"], None),
        _long(duplicates(df), "duplicates", ["duplicates", "duplicate_pct"], None),
    ]
    if numeric:
        parts.append(_long(describe(df, numeric), "numeric", ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]))
    if other:
        parts.append(
            categorical(df, other).select(
                F.lit("categorical").alias("section"),
                "column",
                F.inline(
                    F.array(
                        F.struct(
                            F.concat(F.lit("top:"), F.col("value")).alias("metric"), F.col("n").cast("double").alias("value")
                        ),
                        F.struct(
                            F.when(F.col("rank") == 1, F.lit("n_unique")).alias("metric"),
                            F.col("n_unique").cast("double").alias("value"),
                        ),
                    )
                ),
            ).filter(F.col("metric").isNotNull())
        )
    return _union(parts)


def quality_report(df: DataFrame) -> DataFrame:
    """Shape, missing values, duplicates, numeric summary and IQR outliers as one long table."""
    numeric = numeric_columns(df)
    stats = moments(df, numeric)
    counts = {c: s.count for c, s in stats.items()}
    cut = quantiles(df, numeric, QUARTILES, counts)
    bounds = {
        c: (q[0.25] - 1.5 * (q[0.75] - q[0.25]), q[0.75] + 1.5 * (q[0.75] - q[0.25]))
        for c, q in cut.items()
        if q[0.25] is not None
    }
    summary = small_frame(
        df.sparkSession,
        [(c, s.count, s.mean, s.std, s.min, *[cut[c][p] for p in QUARTILES], s.max) for c, s in stats.items()],
        DESCRIBE_DDL,
    )
    outliers = per_column(df, numeric, outliers=lambda c: F.count_if(outside(c, bounds)))
    return _union(
        [
            _long(shape(df), "shape", ["n_rows", "n_cols"], None),
            _long(missing(df), "missing", ["missing", "missing_pct"]),
            _long(duplicates(df), "duplicates", ["duplicates"], None),
            _long(summary, "numeric", ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
            _long(outliers, "outliers_iqr", ["outliers"]),
        ]
    )
