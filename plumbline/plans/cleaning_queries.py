"""Registered queries: imputation, outliers, scaling, splits and the whole preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import cleaning, splitting
from plumbline.operators.scaling import Scaler
from plumbline.plans.frames import (
    DIRTY_SQL,
    HOUSE_FEATURES,
    HOUSE_SQL,
    HOUSE_X_SQL,
    NULL_EVENTS_SQL,
    REG_FEATURES,
    REG_SQL,
    TEST_KEYS,
    Registry,
    dirty_house,
    fences_sql,
    house_frame,
    null_events,
    r,
    reg_frame,
    rounded,
    sql_fold,
    sql_key,
    table,
)
from plumbline.plans.preprocess import Preprocessor

registry = Registry()
REG_COLUMNS = [*REG_FEATURES, "label"]
MODE_SQL = "(SELECT event_type AS m FROM ev WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)"


def impute_sql(fill: str) -> str:
    return (
        f"WITH {NULL_EVENTS_SQL} SELECT event_id, round(coalesce(value, f), 6) AS value, coalesce(event_type, m) AS event_type "
        f"FROM ev, (SELECT {fill} AS f FROM ev), {MODE_SQL}"
    )


def _impute(spark, d, strategy):
    events = null_events(spark, d)
    return rounded(cleaning.Imputer(strategy, ["value", "event_type"]).fit(events).transform(events))


@registry.add("impute_mean", impute_sql("avg(value)"))
def _(spark, d):
    return _impute(spark, d, "mean")


@registry.add("impute_median", impute_sql("quantile_cont(value, 0.5)"))
def _(spark, d):
    return _impute(spark, d, "median")


@registry.add("impute_strategy_fallback", impute_sql("quantile_cont(value, 0.5)"))
def _(spark, d):
    return _impute(spark, d, "most_frequent")


@registry.add(
    "impute_mode", f"WITH {NULL_EVENTS_SQL} SELECT event_id, coalesce(event_type, m) AS event_type FROM ev, {MODE_SQL}"
)
def _(spark, d):
    events = null_events(spark, d).select("event_id", "event_type")
    return cleaning.Imputer(columns=["event_type"]).fit(events).transform(events)


@registry.add("impute_noop", "SELECT event_id, value, event_type FROM events")
def _(spark, d):
    events = table(spark, d, "events").select("event_id", "value", "event_type")
    return cleaning.Imputer().fit(events).transform(events)


@registry.add("iqr_detect", f"SELECT event_id, value FROM events, ({fences_sql('events', 'value')}) WHERE value < lo OR value > hi")
def _(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return cleaning.OutlierCapper("iqr", columns=["value"]).fit(events).outliers(events)


@registry.add(
    "iqr_cap",
    f"WITH {NULL_EVENTS_SQL} SELECT event_id, CASE WHEN value IS NOT NULL THEN round(greatest(lo, least(hi, value)), 6) END AS value "
    f"FROM ev, ({fences_sql('ev', 'value')})",
)
def _(spark, d):
    events = null_events(spark, d).select("event_id", "value")
    return rounded(cleaning.OutlierCapper("iqr", columns=["value"]).fit(events).transform(events))


@registry.add(
    "zscore_detect",
    "SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) WHERE abs(value - m) / s > 2.5",
)
def _(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return cleaning.OutlierCapper("zscore", 2.5, ["value"]).fit(events).outliers(events)


@registry.add(
    "zscore_cap",
    "SELECT event_id, round(greatest(m - 3 * s, least(m + 3 * s, value)), 6) AS value "
    "FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)",
)
def _(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return rounded(cleaning.OutlierCapper("zscore", 1.5, ["value"]).fit(events).transform(events))


@registry.add(
    "outlier_info",
    f"WITH {REG_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers, "
        f"round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*), 6) AS outlier_pct FROM reg, ({fences_sql('reg', c)})"
        for c in REG_COLUMNS
    ),
)
def _(spark, d):
    reg = reg_frame(spark, d)
    return rounded(cleaning.OutlierCapper("iqr", columns=REG_COLUMNS).fit(reg).info(reg))


def scale_sql(center: str, scale: str, fit: str = "house", where: str = "") -> str:
    params = ", ".join(f"{center.format(c=c)} AS c_{c}, {scale.format(c=c)} AS s_{c}" for c in HOUSE_FEATURES)
    columns = ", ".join(r(f"({c} - c_{c}) / s_{c}") + f" AS {c}" for c in HOUSE_FEATURES)
    return f"WITH {HOUSE_X_SQL} SELECT row_id, {columns} FROM house, (SELECT {params} FROM {fit}) {where}"


def _scale(spark, d, method):
    house = house_frame(spark, d, label=False)
    return rounded(Scaler(method, HOUSE_FEATURES).fit(house).transform(house))


@registry.add("scale_standard", scale_sql("avg({c})", "stddev_pop({c})"))
def _(spark, d):
    return _scale(spark, d, "standard")


@registry.add("scale_robust", scale_sql("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
def _(spark, d):
    return _scale(spark, d, "robust")


@registry.add("scale_minmax", scale_sql("min({c})", "(max({c}) - min({c}))"))
def _(spark, d):
    return _scale(spark, d, "minmax")


HOUSE_KEY = sql_key("row_id")


@registry.add(
    "fit_train_apply_test",
    scale_sql("avg({c})", "stddev_pop({c})", f"house WHERE {HOUSE_KEY} >= {TEST_KEYS}", f"WHERE {HOUSE_KEY} < {TEST_KEYS}"),
)
def _(spark, d):
    house = house_frame(spark, d, label=False)
    is_test = splitting.test_flag(["row_id"])
    return rounded(Scaler("standard", HOUSE_FEATURES).fit(house.filter(~is_test)).transform(house.filter(is_test)))


@registry.add(
    "split_random",
    f"""SELECT event_id, CASE WHEN row_number() OVER (ORDER BY {sql_key('event_id')}, event_id) <= ceil(0.2 * count(*) OVER ())
        THEN 'test' ELSE 'train' END AS split FROM events""",
)
def _(spark, d):
    return splitting.split_exact(table(spark, d, "events").select("event_id"), ["event_id"])


@registry.add(
    "split_threshold",
    f"SELECT event_id, CASE WHEN {sql_key('event_id')} < {TEST_KEYS} THEN 'test' ELSE 'train' END AS split, "
    f"{sql_fold('event_id')}::INTEGER AS fold FROM events",
)
def _(spark, d):
    is_test = splitting.test_flag(["event_id"])
    return table(spark, d, "events").select(
        "event_id", splitting.split_column(is_test).alias("split"), splitting.fold_column(["event_id"]).alias("fold")
    )


@registry.add(
    "split_stratified",
    f"""WITH {HOUSE_SQL},
    b AS (SELECT row_id, greatest(0, least(9, ceil((target - lo) / ((hi - lo) / 10)) - 1)) AS bin
          FROM house, (SELECT min(target) AS lo, max(target) AS hi FROM house))
    SELECT row_id, CASE WHEN row_number() OVER (PARTITION BY bin ORDER BY {HOUSE_KEY}, row_id) <= ceil(0.2 * count(*) OVER (PARTITION BY bin))
        THEN 'test' ELSE 'train' END AS split FROM b""",
)
def _(spark, d):
    house = house_frame(spark, d).select("row_id", "target")
    return splitting.split_stratified(house, ["row_id"], "target").select("row_id", "split")


DIRTY_FEATURES = ["MedInc", "HouseAge", "AveOccup"]
DIRTY_ALL = [*DIRTY_FEATURES, "target"]
PREPARED_SQL = f"""WITH {DIRTY_SQL},
med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in DIRTY_ALL)} FROM dirty),
filled AS (SELECT row_id, {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in DIRTY_ALL)} FROM dirty, med),
fence AS (SELECT {", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in DIRTY_ALL)} FROM filled),
capped AS (SELECT row_id, {", ".join(
    f"greatest(a_{c} - 1.5::DOUBLE * (b_{c} - a_{c}), least(b_{c} + 1.5::DOUBLE * (b_{c} - a_{c}), {c})) AS {c}" for c in DIRTY_ALL
)} FROM filled, fence),
parted AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {HOUSE_KEY}, row_id) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM capped),
par AS (SELECT {", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in DIRTY_FEATURES)} FROM parted WHERE split = 'train')
SELECT row_id, split, {", ".join(f"round({c}, 8) AS {c}" for c in DIRTY_ALL)},
       {", ".join(r(f"({c} - c_{c}) / s_{c}", 8) + f" AS {c}_scaled" for c in DIRTY_FEATURES)} FROM parted, par"""


@registry.add("preprocess_end_to_end", PREPARED_SQL)
def _(spark, d):
    return rounded(Preprocessor().run(dirty_house(spark, d), ["row_id"], "target").data, 8)


@registry.add("preprocess_sizes", f"SELECT split, count(*) AS n FROM ({PREPARED_SQL}) GROUP BY split")
def _(spark, d):
    prepared = Preprocessor(scaling="robust", outliers="zscore", factor=3.0).run(dirty_house(spark, d), ["row_id"], "target")
    return prepared.data.groupBy("split").agg(F.count("*").alias("n"))
