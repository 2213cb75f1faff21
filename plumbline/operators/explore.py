"""Exploratory tables: what a histogram, box, Q-Q, correlation or map plot is drawn from."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import equal_width_bin, numeric_columns, row_key
from plumbline.functions.moments import pearson
from plumbline.operators import profile
from plumbline.operators.stats import moments, per_column, quantiles, spread, unpivot
from plumbline.session import small_frame


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """(column, bin, lower, upper, n) with equal-width bins; empty bins are kept."""
    spark = df.sparkSession
    stats = moments(df, columns)
    stats = {c: s for c, s in stats.items() if s.count}
    binned = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), equal_width_bin(c, s.min, s.max, bins).alias("bin"))
                    for c, s in stats.items()
                ]
            )
        )
    )
    counts = binned.filter(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count("*").alias("n"))
    edges = [
        (c, b, s.min + b * (s.max - s.min) / bins, s.min + (b + 1) * (s.max - s.min) / bins)
        for c, s in stats.items()
        for b in range(bins)
    ]
    grid = small_frame(spark, edges, "column string, bin int, lower double, upper double")
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", F.col("bin").cast("bigint").alias("bin"), "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")
    )


def kde_grid(df: DataFrame, column: str, points: int = 200, bins: int = 512) -> DataFrame:
    """Gaussian density on a grid over the data range, with Scott's bandwidth.

    The kernel sum runs over bin counts (at most ``bins``), never over the rows.
    """
    spark = df.sparkSession
    s = moments(df, [column])[column]
    counts = df.groupBy(equal_width_bin(column, s.min, s.max, bins).alias("bin")).agg(F.count("*").alias("n"))
    weights = [(r["bin"], r["n"]) for r in counts.filter("bin IS NOT NULL").collect()]  # at most `bins` rows
    width = (s.max - s.min) / bins
    bandwidth = s.std * s.count ** (-0.2)
    centers = F.array(
        *[
            F.struct(F.lit(s.min + (b + 0.5) * width).alias("x"), F.lit(float(n)).alias("w"))
            for b, n in sorted(weights)
        ]
    )
    step = (s.max - s.min) / (points - 1)
    grid = spark.range(points).select(
        F.col("id").alias("point"), (F.lit(s.min) + F.col("id") * F.lit(step)).alias("x")
    )
    kernel = F.aggregate(
        centers,
        F.lit(0.0),
        lambda total, c: total + c["w"] * F.exp(F.lit(-0.5) * F.pow((F.col("x") - c["x"]) / F.lit(bandwidth), F.lit(2.0))),
    )
    return grid.withColumn("density", kernel / F.lit(s.count * bandwidth * math.sqrt(2 * math.pi)))


def box_stats(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the fences) and number of fliers."""
    cut = quantiles(df, list(columns), profile.QUARTILES)
    bounds = {
        c: (q[0.25] - whis * (q[0.75] - q[0.25]), q[0.75] + whis * (q[0.75] - q[0.25])) for c, q in cut.items()
    }
    measured = per_column(
        df,
        columns,
        whisker_low=lambda c: F.min(F.when(~profile.outside(c, bounds), F.col(c))).cast("double"),
        whisker_high=lambda c: F.max(F.when(~profile.outside(c, bounds), F.col(c))).cast("double"),
        fliers=lambda c: F.count_if(profile.outside(c, bounds)),
    )
    quartiles = small_frame(
        df.sparkSession,
        [(c, q[0.25], q[0.5], q[0.75]) for c, q in cut.items()],
        "column string, q25 double, median double, q75 double",
    )
    return quartiles.join(F.broadcast(measured), "column")  # one row per column


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full Pearson matrix in long form (row, col, column_a, column_b, r), pairwise complete.

    Each unordered pair is measured once, all pairs in one pass. Deviations are only
    measured per pair where a column has gaps; others share one per column.
    """
    columns = list(columns or numeric_columns(df))
    stats = moments(df, columns)
    whole = {c for c in columns if stats[c].missing == 0}

    def measure(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0 if stats[a].std_pop else None).cast("double")
        if {a, b} <= whole:
            return F.try_divide(F.covar_pop(a, b), F.lit((stats[a].std_pop or 0.0) * (stats[b].std_pop or 0.0)))
        return pearson(a, b)

    wide = df.agg(
        F.count("*").alias("n"),
        *[measure(columns[i], columns[j]).alias(f"r_{i}_{j}") for i in range(len(columns)) for j in range(i + 1)],
    )
    cells = [
        F.struct(
            F.lit(i).alias("row"),
            F.lit(j).alias("col"),
            F.lit(columns[i]).alias("column_a"),
            F.lit(columns[j]).alias("column_b"),
            F.col(f"r_{max(i, j)}_{min(i, j)}").alias("r"),
        )
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return wide.select(F.inline(F.array(*cells)))


def lower_triangle(matrix: DataFrame) -> DataFrame:
    return matrix.filter(F.col("row") > F.col("col"))


def target_correlations(df: DataFrame, label: str, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, r, rank) by absolute correlation with the label, strongest first."""
    features = list(features or numeric_columns(df, (label,)))
    wide = df.agg(*[pearson(f, label).alias(f"r__{i}") for i, f in enumerate(features)])
    order = Window.orderBy(F.desc_nulls_last(F.abs("r")), F.asc("feature"))  # one row per feature
    return (
        unpivot(wide, features, ["r"])
        .withColumnRenamed("column", "feature")
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
    )


def top_correlated(df: DataFrame, label: str | None, k: int = 8, include_label: bool = True) -> DataFrame:
    """The columns a pair plot shows: the ``k`` most correlated, or the first ``k`` without a label."""
    numeric = numeric_columns(df)
    if label is None or label not in numeric or len(numeric) <= k:
        rows = [(c, i) for i, c in enumerate(numeric[:k], start=1)]
        return small_frame(df.sparkSession, rows, "feature string, rank bigint")
    ranked = target_correlations(df, label).select("feature", "rank")
    if include_label:
        first = small_frame(df.sparkSession, [(label, 0)], "feature string, rank bigint")
        ranked = first.unionByName(ranked).select("feature", (F.col("rank") + 1).alias("rank"))
    return ranked.filter(F.col("rank") <= k)


def high_correlations(df: DataFrame, label: str, threshold: float = 0.7) -> DataFrame:
    return target_correlations(df, label).filter(F.abs("r") > threshold)


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles against normal ones, with the least-squares line on every row."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    cut = quantiles(df, [column], probs)[column]
    rows = [(i, NormalDist().inv_cdf(p), cut[p]) for i, p in enumerate(probs, start=1)]
    table = small_frame(df.sparkSession, rows, "point bigint, theoretical double, ordered double")
    whole = Window.partitionBy()  # `points` rows
    return table.select(
        "point",
        "theoretical",
        "ordered",
        F.regr_slope("ordered", "theoretical").over(whole).alias("slope"),
        F.regr_intercept("ordered", "theoretical").over(whole).alias("intercept"),
        F.corr("ordered", "theoretical").over(whole).alias("r"),
    )


def scatter_sample(df: DataFrame, ids: Sequence[str], columns: Sequence[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """A reproducible sample of ``n`` rows: the smallest row keys (a top-n, not a sort)."""
    keyed = df.select(*ids, *columns, row_key(*ids, seed=seed).alias("__key"))
    return keyed.orderBy("__key", *ids).limit(n).drop("__key")


def geo_grid(df: DataFrame, lat: str, lon: str, label: str, cell: float = 1.0) -> DataFrame:
    """Rows and mean label per map cell; combined before the shuffle."""
    return df.groupBy(
        F.floor(F.col(lat) / F.lit(cell)).cast("bigint").alias("lat_cell"),
        F.floor(F.col(lon) / F.lit(cell)).cast("bigint").alias("lon_cell"),
    ).agg(F.count("*").alias("n"), F.avg(label).alias("mean_label"))


def percent_at_or_below(population: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """For single inputs: share of the population at or below one value per column."""
    return per_column(
        population,
        list(values),
        score=lambda c: F.lit(float(values[c])),
        percentile=lambda c: F.avg((F.col(c) <= F.lit(float(values[c]))).cast("double")) * 100,
    )


def percentile_of_score(
    population: DataFrame, scores: DataFrame, columns: Sequence[str], buckets: int = 512
) -> DataFrame:
    """For many inputs: (column, value, percentile) for every distinct value scored.

    Both sides are cut into ranges at sketched quantiles and reduced to distinct
    values with counts. Running counts are taken inside a range and the totals of
    the ranges before it are added, so neither a global sort nor a comparison of
    every score with every row takes place.
    """
    spark = population.sparkSession
    probs = [i / buckets for i in range(1, buckets)]
    edges = population.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 1000).alias(c) for c in columns]).first()
    ranges = Bucketizer(
        inputCols=list(columns),
        outputCols=[f"__bucket_{c}" for c in columns],
        splitsArray=[[-math.inf, *sorted({0.0, *(edges[c] or ())}), math.inf] for c in columns],
        handleInvalid="keep",
    )

    def tally(df: DataFrame) -> DataFrame:
        cells = [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"__bucket_{c}").cast("int").alias("bucket"),
                F.col(c).cast("double").alias("value"),
            )
            for c in columns
        ]
        return ranges.transform(df.select(*columns)).select(F.inline(F.array(*cells))).filter("value IS NOT NULL")

    totals: dict[str, dict[int, int]] = {c: {} for c in columns}
    for r in tally(population).groupBy("column", "bucket").count().collect():  # at most columns x (buckets + 1) rows
        totals[r["column"]][r["bucket"]] = r["count"]
    before = small_frame(
        spark,
        [
            (c, b, sum(n for other, n in totals[c].items() if other < b), sum(totals[c].values()))
            for c in columns
            for b in range(buckets + 2)
        ],
        "column string, bucket int, before bigint, total bigint",
    )
    values = (
        tally(population)
        .withColumn("n", F.lit(1))
        .unionByName(tally(scores).withColumn("n", F.lit(0)))
        .groupBy("column", "bucket", "value")
        .agg(F.sum("n").alias("n"), F.max(F.col("n") == 0).alias("asked"))
    )
    running = F.sum("n").over(Window.partitionBy("column", "bucket").orderBy("value"))
    return (
        values.withColumn("running", running)
        .filter("asked")
        .join(F.broadcast(before), ["column", "bucket"])
        .select(
            "column",
            "value",
            F.try_divide((F.col("before") + F.col("running")) * F.lit(100.0), F.col("total")).alias("percentile"),
        )
    )


def insights(df: DataFrame, label: str | None = None) -> DataFrame:
    """(rule, subject, value, message): missing values, strongest predictor, high correlations, outliers."""
    numeric = numeric_columns(df)
    facts = df.agg(
        sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).cast("double").alias("missing"),
        *([pearson(c, label).alias(f"r_{c}") for c in numeric if c != label] if label else []),
    ).first()
    rows: list[tuple[str, str, float, str]] = []
    n_missing = facts["missing"]
    rows.append(
        ("missing", "*", n_missing, f"{n_missing:.0f} values are missing" if n_missing else "no value is missing")
    )
    if label:
        found = {c: facts[f"r_{c}"] for c in numeric if c != label and facts[f"r_{c}"] is not None}
        if found:
            best = min(found, key=lambda c: (-abs(found[c]), c))
            rows.append(("strongest_predictor", best, found[best], f"{best} correlates most with {label}: {found[best]:.3f}"))
        rows += [
            ("high_correlation", c, r, f"{c} correlates above 0.7 with {label}: {r:.3f}")
            for c, r in sorted(found.items())
            if abs(r) > 0.7
        ]
    bounds = profile.iqr_bounds(df, numeric)
    counted = df.agg(*[F.count_if(profile.outside(c, bounds)).alias(c) for c in numeric]).first().asDict()
    total = sum(counted.values())
    if total:
        most = min(counted, key=lambda c: (-counted[c], c))
        rows.append(("total_outliers", "*", float(total), f"{total} values lie outside the IQR fences"))
        rows.append(("most_outliers", most, float(counted[most]), f"{most} has the most: {counted[most]}"))
    return small_frame(df.sparkSession, rows, "rule string, subject string, value double, message string")



def report(df: DataFrame, path: str, label: str | None = None, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Write every exploratory table under ``path`` and list them as (artifact, rows)."""
    numeric = numeric_columns(df)
    features = [c for c in numeric if c != label]
    cached = spread(df)
    try:
        tables = {
            "overview": profile.overview(cached),
            "distribution": histogram(cached, features),
            "correlation_matrix": lower_triangle(correlations(cached, numeric)),
            "outliers": box_stats(cached, numeric),
            "scatter_matrix_columns": top_correlated(cached, label),
            "insights": insights(cached, label),
        }
        if label:
            tables["target_stats"] = profile.target_stats(cached, label)
            tables["target_qq"] = qq_points(cached, label)
            tables["target_density"] = kde_grid(cached, label)
            tables["feature_relationships"] = target_correlations(cached, label).filter("rank <= 6")
        if label and lat in df.columns and lon in df.columns:
            tables["geography"] = geo_grid(cached, lat, lon, label)
        rows = []
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
            rows.append((name, df.sparkSession.read.parquet(f"{path}/{name}").count()))
    finally:
        cached.unpersist()
    return small_frame(df.sparkSession, rows, "artifact string, n_rows bigint")
