"""Registered queries: profiling and exploration."""

from __future__ import annotations

import math
from statistics import NormalDist


from plumbline.operators import explore, profile
from plumbline.plans.frames import (
    HOUSE_FEATURES,
    HOUSE_SQL,
    HOUSE_X_SQL,
    NULL_DOCS_SQL,
    REG_FEATURES,
    REG_SQL,
    Registry,
    describe_sql,
    fences_sql,
    house_frame,
    null_docs,
    r,
    reg_frame,
    rounded,
    sql_key,
    table,
)
from plumbline.session import scratch_path

registry = Registry()
REG_COLUMNS = [*REG_FEATURES, "label"]
DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
DOC_NUMERIC = ["doc_id", "n_chars", "quality", "toxic"]
SCORE_COLUMNS = ["MedInc", "HouseAge", "AveRooms", "Population"]
INPUT = {"MedInc": 3.87, "HouseAge": 28.6, "AveRooms": 5.43, "Population": 3119.0}


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


@registry.add("profile_shape", f"WITH {NULL_DOCS_SQL} SELECT count(*) AS n_rows, 6::BIGINT AS n_cols FROM docs")
def _(spark, d):
    return profile.shape(null_docs(spark, d))


@registry.add(
    "profile_missing",
    f"WITH {NULL_DOCS_SQL} "
    + union(
        f"SELECT '{c}' AS \"column\", (count(*) - count({c})) AS missing, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM docs"
        for c in DOC_COLUMNS
    ),
)
def _(spark, d):
    return rounded(profile.missing(null_docs(spark, d)))


@registry.add(
    "profile_total_missing",
    f"WITH {NULL_DOCS_SQL} SELECT ({' + '.join(f'count(*) - count({c})' for c in DOC_COLUMNS)})::BIGINT AS total_missing FROM docs",
)
def _(spark, d):
    return profile.total_missing(null_docs(spark, d))


@registry.add(
    "profile_duplicates",
    """SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS duplicates, round(sum(n - 1) * 100.0::DOUBLE / sum(n), 6) AS duplicate_pct
       FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)""",
)
def _(spark, d):
    return rounded(profile.duplicates(table(spark, d, "events").select("user_id", "event_type")))


@registry.add(
    "profile_describe",
    f"WITH {REG_SQL}, t AS ({union(describe_sql('reg', c) for c in REG_COLUMNS)}) "
    'SELECT column_name AS "column", n AS "count", round(mean, 8) AS mean, round(std, 8) AS std, round(lo, 8) AS "min", '
    'round(q25, 8) AS q25, round(q50, 8) AS q50, round(q75, 8) AS q75, round(hi, 8) AS "max" FROM t',
)
def _(spark, d):
    return rounded(profile.describe(reg_frame(spark, d), REG_COLUMNS), 8)


@registry.add(
    "profile_iqr_outliers",
    f"WITH {REG_SQL} "
    + union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers FROM reg, ({fences_sql('reg', c)})"
        for c in REG_COLUMNS
    ),
)
def _(spark, d):
    return profile.iqr_outliers(reg_frame(spark, d), REG_COLUMNS)


@registry.add(
    "profile_categorical",
    f"""WITH {NULL_DOCS_SQL},
    counts AS ({union(f"SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM docs WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("lang", "source"))}),
    ranked AS (SELECT *, count(*) OVER (PARTITION BY col) AS n_unique,
                      row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rank FROM counts)
    SELECT col AS "column", n_unique, rank, value, n FROM ranked WHERE rank <= 5""",
)
def _(spark, d):
    return profile.categorical(null_docs(spark, d))


@registry.add(
    "profile_min_max_mean",
    f"WITH {HOUSE_X_SQL} "
    + union(
        f"SELECT '{c}' AS \"column\", round(min({c}), 6) AS \"min\", round(max({c}), 6) AS \"max\", round(avg({c}), 6) AS mean FROM house"
        for c in HOUSE_FEATURES
    ),
)
def _(spark, d):
    return rounded(profile.min_max_mean(house_frame(spark, d, label=False), HOUSE_FEATURES))


@registry.add(
    "target_quick_stats",
    f'WITH {HOUSE_SQL} SELECT round(avg(target), 6) AS mean, round(min(target), 6) AS "min", round(max(target), 6) AS "max", '
    "round(stddev_samp(target), 6) AS std FROM house",
)
def _(spark, d):
    return rounded(profile.target_stats(house_frame(spark, d), "target"))


def histogram_sql(source: str, columns, bins: int) -> str:
    return union(
        f"""SELECT '{c}' AS "column", b AS bin, {r(f"lo + b * (hi - lo) / {bins}")} AS lower,
               {r(f"lo + (b + 1) * (hi - lo) / {bins}")} AS upper, coalesce(n, 0) AS n
        FROM (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {source}), (SELECT unnest(range({bins})) AS b)
        LEFT JOIN (SELECT greatest(0, least({bins - 1}, floor(({c} - lo) / ((hi - lo) / {bins}))))::BIGINT AS hb, count(*) AS n
                   FROM {source}, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {source}) GROUP BY hb) ON hb = b"""
        for c in columns
    )


@registry.add("histogram", histogram_sql("events", ["value", "user_id"], 50))
def _(spark, d):
    return rounded(explore.histogram(table(spark, d, "events"), ["value", "user_id"], 50))


@registry.add(
    "kde_grid",
    f"""WITH m AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2::DOUBLE) AS bw FROM events),
    bins AS (SELECT greatest(0, least(511, floor((value - lo) / ((hi - lo) / 512)))) AS b, count(*) AS w FROM events, m GROUP BY b),
    centers AS (SELECT lo + (b + 0.5::DOUBLE) * ((hi - lo) / 512) AS c, w FROM bins, m),
    grid AS (SELECT i AS point, lo + i * ((hi - lo) / 199) AS x FROM m, (SELECT unnest(range(200)) AS i))
    SELECT point, round(x, 6) AS x, round(sum(w * exp(-0.5::DOUBLE * pow((x - c) / bw, 2))) / (any_value(n) * any_value(bw) * {math.sqrt(2 * math.pi)!r}::DOUBLE), 9) AS density
    FROM grid, centers, m GROUP BY point, x""",
)
def _(spark, d):
    return rounded(explore.kde_grid(table(spark, d, "events"), "value"), {"density": 9})


@registry.add(
    "box_stats",
    union(
        f"""SELECT '{c}' AS "column", round(q25, 6) AS q25, round(q50, 6) AS median, round(q75, 6) AS q75,
             round(min({c}::DOUBLE) FILTER (WHERE {c} >= flo AND {c} <= fhi), 6) AS whisker_low,
             round(max({c}::DOUBLE) FILTER (WHERE {c} >= flo AND {c} <= fhi), 6) AS whisker_high,
             count(*) FILTER (WHERE {c} < flo OR {c} > fhi) AS fliers
        FROM events, ({describe_sql("events", c)}), (SELECT lo AS flo, hi AS fhi FROM ({fences_sql("events", c)})) GROUP BY q25, q50, q75"""
        for c in ("value", "user_id")
    ),
)
def _(spark, d):
    return rounded(explore.box_stats(table(spark, d, "events"), ["value", "user_id"]))


def corr_sql(source: str, pairs) -> str:
    return union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM {source}" for a, b in pairs
    )


@registry.add("corr_matrix", f"WITH {REG_SQL} {corr_sql('reg', [(a, b) for a in REG_COLUMNS for b in REG_COLUMNS])}")
def _(spark, d):
    return rounded(explore.correlations(reg_frame(spark, d), REG_COLUMNS).select("column_a", "column_b", "r"))


@registry.add(
    "corr_lower_triangle",
    f"WITH {REG_SQL} {corr_sql('reg', [(a, b) for i, a in enumerate(REG_COLUMNS) for b in REG_COLUMNS[:i]])}",
)
def _(spark, d):
    lower = explore.lower_triangle(explore.correlations(reg_frame(spark, d), REG_COLUMNS))
    return rounded(lower.select("column_a", "column_b", "r"))


def target_corr_sql(view: str, source: str, features, label: str) -> str:
    rows = union(f"SELECT '{f}' AS feature, corr({f}, {label}) AS r FROM {source}" for f in features)
    return f"WITH {view}, c AS ({rows}), k AS (SELECT feature, r, row_number() OVER (ORDER BY abs(r) DESC, feature) AS rank FROM c) "


@registry.add(
    "target_corr_rank", target_corr_sql(REG_SQL, "reg", REG_FEATURES, "label") + "SELECT feature, round(r, 6) AS r, rank FROM k"
)
def _(spark, d):
    return rounded(explore.target_correlations(reg_frame(spark, d), "label", REG_FEATURES))


@registry.add(
    "top_k_corr_features",
    target_corr_sql(HOUSE_SQL, "house", HOUSE_FEATURES, "target")
    + "SELECT feature, rank + 1 AS rank FROM k WHERE rank <= 7 UNION ALL SELECT 'target', 1",
)
def _(spark, d):
    return explore.top_correlated(house_frame(spark, d).drop("row_id"), "target", 8)


@registry.add(
    "high_corr_filter",
    target_corr_sql(REG_SQL, "reg", REG_FEATURES, "label") + "SELECT feature, round(r, 6) AS r, rank FROM k WHERE abs(r) > 0.7",
)
def _(spark, d):
    return rounded(explore.high_correlations(reg_frame(spark, d).drop("l_orderkey", "l_linenumber"), "label"))


_QQ = [i / 100 for i in range(1, 100)]


@registry.add(
    "qq_points",
    f"""WITH z AS (SELECT unnest(range(1, 100)) AS point, unnest([{", ".join(f"{NormalDist().inv_cdf(p)!r}::DOUBLE" for p in _QQ)}]) AS theoretical,
                   unnest((SELECT quantile_cont(value, [{", ".join(map(repr, _QQ))}]) FROM events)) AS ordered)
    SELECT point, {r("theoretical")} AS theoretical, {r("ordered")} AS ordered,
           round(regr_slope(ordered, theoretical) OVER (), 6) AS slope, round(regr_intercept(ordered, theoretical) OVER (), 6) AS intercept,
           round(corr(ordered, theoretical) OVER (), 6) AS r FROM z""",
)
def _(spark, d):
    return rounded(explore.qq_points(table(spark, d, "events"), "value"))


@registry.add(
    "scatter_sample",
    f"WITH {HOUSE_SQL} SELECT row_id, round(MedInc, 8) AS MedInc, round(target, 8) AS target FROM house "
    f"ORDER BY {sql_key('row_id')}, row_id LIMIT 1000",
)
def _(spark, d):
    return rounded(explore.scatter_sample(house_frame(spark, d), ["row_id"], ["MedInc", "target"]), 8)


@registry.add(
    "geo_grid",
    f"""WITH {HOUSE_SQL} SELECT floor(Latitude / 0.5::DOUBLE)::BIGINT AS lat_cell, floor(Longitude / 0.5::DOUBLE)::BIGINT AS lon_cell,
         count(*) AS n, round(avg(target), 6) AS mean_label FROM house GROUP BY 1, 2""",
)
def _(spark, d):
    return rounded(explore.geo_grid(house_frame(spark, d), "Latitude", "Longitude", "target", 0.5))


@registry.add(
    "percentile_of_score",
    f"WITH {HOUSE_X_SQL} "
    + union(
        f"""SELECT DISTINCT '{c}' AS "column", round({c}, 8) AS value,
            round(count(*) OVER (ORDER BY {c} RANGE UNBOUNDED PRECEDING) * 100.0::DOUBLE / count(*) OVER (), 6) AS percentile FROM house"""
        for c in SCORE_COLUMNS
    ),
)
def _(spark, d):
    house = house_frame(spark, d, label=False)
    return rounded(explore.percentile_of_score(house, house, SCORE_COLUMNS), {"value": 8})


@registry.add(
    "percentile_of_input",
    f"WITH {HOUSE_X_SQL} "
    + union(
        f"SELECT '{c}' AS \"column\", {v!r}::DOUBLE AS score, round(avg(({c} <= {v!r}::DOUBLE)::INT) * 100, 6) AS percentile FROM house"
        for c, v in INPUT.items()
    ),
)
def _(spark, d):
    return rounded(explore.percent_at_or_below(house_frame(spark, d, label=False), INPUT))


def long_sql(section: str, source: str, metrics: dict[str, str], column: str) -> str:
    return union(
        f"SELECT '{section}' AS section, '{column}' AS \"column\", '{m}' AS metric, {r(f'({e})::DOUBLE')} AS value FROM {source}"
        for m, e in metrics.items()
    )


def numeric_long_sql(source: str, columns) -> str:
    names = {"count": "n", "mean": "mean", "std": "std", "min": "lo", "q25": "q25", "q50": "q50", "q75": "q75", "max": "hi"}
    return union(long_sql("numeric", f"({describe_sql(source, c)})", names, c) for c in columns)


def missing_long_sql(source: str, columns) -> str:
    return union(
        long_sql("missing", source, {"missing": f"count(*) - count({c})", "missing_pct": f"(count(*) - count({c})) * 100.0 / count(*)"}, c)
        for c in columns
    )


def duplicates_sql(source: str, columns) -> str:
    return f"(SELECT count(*) AS n FROM {source} GROUP BY {', '.join(columns)})"


SHAPE_LONG = long_sql("shape", "docs", {"n_rows": "count(*)", "n_cols": "6"}, "*").replace("(6)::DOUBLE", "any_value(6::DOUBLE)")
TOP_SQL = """SELECT 'categorical', col, 'top:' || value, n::DOUBLE FROM ranked WHERE rank <= 5
UNION ALL SELECT 'categorical', col, 'n_unique', n_unique::DOUBLE FROM ranked WHERE rank = 1"""


@registry.add(
    "eda_overview",
    f"""WITH {NULL_DOCS_SQL},
    counts AS ({union(f"SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM docs WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("lang", "source"))}),
    ranked AS (SELECT *, count(*) OVER (PARTITION BY col) AS n_unique, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rank FROM counts)
    {SHAPE_LONG} UNION ALL {missing_long_sql("docs", DOC_COLUMNS)}
    UNION ALL {long_sql("missing", "docs", {"total_missing": " + ".join(f"count(*) - count({c})" for c in DOC_COLUMNS)}, "*")}
    UNION ALL {long_sql("duplicates", duplicates_sql("docs", DOC_COLUMNS), {"duplicates": "sum(n - 1)", "duplicate_pct": "sum(n - 1) * 100.0 / sum(n)"}, "*")}
    UNION ALL {numeric_long_sql("docs", DOC_NUMERIC)} UNION ALL {TOP_SQL}""",
)
def _(spark, d):
    return rounded(profile.overview(null_docs(spark, d)))


@registry.add(
    "quality_report",
    f"""WITH {NULL_DOCS_SQL} {SHAPE_LONG} UNION ALL {missing_long_sql("docs", DOC_COLUMNS)}
    UNION ALL {long_sql("duplicates", duplicates_sql("docs", DOC_COLUMNS), {"duplicates": "sum(n - 1)"}, "*")}
    UNION ALL {numeric_long_sql("docs", DOC_NUMERIC)}
    UNION ALL """
    + union(
        long_sql("outliers_iqr", f"docs, ({fences_sql('docs', c)})", {"outliers": f"count(*) FILTER (WHERE {c} < lo OR {c} > hi)"}, c)
        for c in DOC_NUMERIC
    ),
)
def _(spark, d):
    return rounded(profile.quality_report(null_docs(spark, d)))


@registry.add(
    "eda_insights",
    target_corr_sql(REG_SQL, "reg", REG_FEATURES, "label")
    + f""", o AS ({union(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n FROM reg, ({fences_sql('reg', c)})" for c in REG_COLUMNS)})
    SELECT 'missing' AS rule, '*' AS subject, ({" + ".join(f"count(*) - count({c})" for c in REG_COLUMNS)})::DOUBLE AS value FROM reg
    UNION ALL SELECT 'strongest_predictor', feature, round(r, 6) FROM k WHERE rank = 1
    UNION ALL SELECT 'high_correlation', feature, round(r, 6) FROM k WHERE abs(r) > 0.7
    UNION ALL SELECT 'total_outliers', '*', sum(n)::DOUBLE FROM o HAVING sum(n) > 0
    UNION ALL (SELECT 'most_outliers', col, n::DOUBLE FROM o WHERE n > 0 ORDER BY n DESC, col LIMIT 1)""",
)
def _(spark, d):
    found = explore.insights(reg_frame(spark, d).drop("l_orderkey", "l_linenumber"), "label")
    return rounded(found.select("rule", "subject", "value"))


@registry.add("eda_report")
def _(spark, d):
    house = house_frame(spark, d).drop("row_id")
    return explore.report(house, scratch_path(spark, "eda"), "target")


