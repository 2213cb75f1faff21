"""Views over the stored tables that the registered queries run on, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plumbline.functions.columns import KEY_HEX_DIGITS, fraction_threshold
from plumbline.operators.splitting import split_column, test_flag

Query = Callable[[SparkSession, str], DataFrame]

REG_IDS = ["l_orderkey", "l_linenumber"]
REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
HOUSE_FEATURES = "MedInc HouseAge AveRooms AveBedrms Population AveOccup Latitude Longitude".split()
ONE_FEATURE_MODELS = {"by_quantity": "l_quantity", "by_price": "p_retailprice", "by_discount": "l_discount"}


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, key: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[key] = fn
            if sql is not None:
                self.oracle[key] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int | Mapping[str, int] = 6) -> DataFrame:
    """Doubles rounded for comparison; other columns as they are."""
    places = digits if isinstance(digits, Mapping) else {}
    default = 6 if places else digits
    return df.select(
        *[
            F.round(f.name, places.get(f.name, default)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expr: str, digits: int = 6) -> str:
    """SQL rounding that gives plain zero where a tiny negative would give minus zero."""
    return f"CASE WHEN abs({expr}) < {0.5 * 10.0 ** -digits!r}::DOUBLE THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END"


def sql_key(*ids: str, seed: int = 42) -> str:
    text = ", ".join(f"CAST({i} AS VARCHAR)" for i in ids)
    return f"('0x' || substr(md5(concat_ws('|', {text}, '{seed}')), 1, {KEY_HEX_DIGITS}))::BIGINT"


def sql_fold(*ids: str, folds: int = 5) -> str:
    return f"(({sql_key("'fold'", *ids)} * {folds}) >> {4 * KEY_HEX_DIGITS})"


TEST_KEYS = fraction_threshold(0.2)


def reg_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part with a label that depends on four of the five features."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    lines = table(spark, sf_dir, "lineitem")
    label = F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        *REG_IDS,
        "l_quantity",
        "l_discount",
        "l_tax",
        "p_retailprice",
        F.col("p_size").cast("double").alias("p_size"),
        label.alias("label"),
    )


REG_SQL = """reg AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, p_retailprice, CAST(p_size AS DOUBLE) AS p_size,
         l_quantity * p_retailprice * (1 - l_discount) * (1 + l_tax) / 1000 AS label
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def reg_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg_frame(spark, sf_dir).withColumn("split", split_column(test_flag(REG_IDS)))


REG_SPLIT_SQL = f"""{REG_SQL},
s AS (SELECT *, {sql_key(*REG_IDS)} AS row_key,
        CASE WHEN {sql_key(*REG_IDS)} < {TEST_KEYS} THEN 'test' ELSE 'train' END AS split,
        {sql_fold(*REG_IDS)} AS fold FROM reg)"""


def house_frame(spark: SparkSession, sf_dir: str, label: bool = True) -> DataFrame:
    """The housing columns from orders; only the label needs the customer table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    columns: list[Column] = [
        order.alias("row_id"),
        (F.col("o_totalprice") / 50000).alias("MedInc"),
        (order % 52 + 1).cast("double").alias("HouseAge"),
        (cust % 8 + 3).cast("double").alias("AveRooms"),
        (cust % 3 + 1).cast("double").alias("AveBedrms"),
        (order % 4900 + 100).cast("double").alias("Population"),
        (cust % 5 + 2).cast("double").alias("AveOccup"),
        (F.lit(32.0) + (order % 1000) / F.lit(100.0)).alias("Latitude"),
        (F.lit(-124.0) + (cust % 1000) / F.lit(100.0)).alias("Longitude"),
    ]
    if not label:
        return orders.select(*columns)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    target = (
        F.lit(0.5)
        + F.lit(0.3) * (F.col("o_totalprice") / 50000)
        + F.lit(0.02) * (cust % 8 + 3).cast("double")
        + F.col("c_acctbal") / 10000
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(*columns, target.alias("target"))


_HOUSE_COLUMNS = """o_orderkey AS row_id, o_totalprice / 50000 AS MedInc,
         CAST(o_orderkey % 52 + 1 AS DOUBLE) AS HouseAge, CAST(o_custkey % 8 + 3 AS DOUBLE) AS AveRooms,
         CAST(o_custkey % 3 + 1 AS DOUBLE) AS AveBedrms, CAST(o_orderkey % 4900 + 100 AS DOUBLE) AS Population,
         CAST(o_custkey % 5 + 2 AS DOUBLE) AS AveOccup,
         CAST(32 AS DOUBLE) + (o_orderkey % 1000) / CAST(100 AS DOUBLE) AS Latitude,
         CAST(-124 AS DOUBLE) + (o_custkey % 1000) / CAST(100 AS DOUBLE) AS Longitude"""
HOUSE_X_SQL = f"house AS (SELECT {_HOUSE_COLUMNS} FROM orders)"
HOUSE_SQL = f"""house AS (
  SELECT {_HOUSE_COLUMNS},
         CAST(0.5 AS DOUBLE) + CAST(0.3 AS DOUBLE) * (o_totalprice / 50000)
         + CAST(0.02 AS DOUBLE) * CAST(o_custkey % 8 + 3 AS DOUBLE) + c_acctbal / 10000 AS target
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def dirty_house(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A housing table with missing values, outliers and a category."""
    row = F.col("row_id")
    return house_frame(spark, sf_dir).select(
        "row_id",
        F.when(row % 17 != 0, F.when(row % 97 == 0, F.col("MedInc") * 10).otherwise(F.col("MedInc"))).alias("MedInc"),
        "HouseAge",
        F.when(row % 23 != 0, F.col("AveOccup")).alias("AveOccup"),
        F.when(row % 101 == 0, F.col("target") + 20).otherwise(F.col("target")).alias("target"),
    )


DIRTY_SQL = f"""{HOUSE_SQL},
dirty AS (
  SELECT row_id, CASE WHEN row_id % 17 <> 0 THEN CASE WHEN row_id % 97 = 0 THEN MedInc * 10 ELSE MedInc END END AS MedInc,
         HouseAge, CASE WHEN row_id % 23 <> 0 THEN AveOccup END AS AveOccup,
         CASE WHEN row_id % 101 = 0 THEN target + 20 ELSE target END AS target
  FROM house)"""


def null_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


NULL_DOCS_SQL = """docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def null_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(e % 17 != 0, F.col("value")).alias("value"),
        F.when(e % 23 != 0, F.col("event_type")).alias("event_type"),
    )


NULL_EVENTS_SQL = """ev AS (
  SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN value END AS value,
         CASE WHEN event_id % 23 <> 0 THEN event_type END AS event_type
  FROM events)"""


def one_feature_fits(train: DataFrame, features: Sequence[str], label: str = "label") -> dict[str, tuple[float, float]]:
    """(intercept, slope) of the label on each feature alone, in one pass."""
    row = train.agg(
        *[F.regr_intercept(label, f).alias(f"a_{f}") for f in features], *[F.regr_slope(label, f).alias(f"b_{f}") for f in features]
    ).first()
    return {f: (row[f"a_{f}"], row[f"b_{f}"]) for f in features}


def prediction_columns(df: DataFrame, fits: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.select(
        "*",
        *[
            (F.lit(fits[f][0]) + F.lit(fits[f][1]) * F.col(f)).alias(f"pred_{name}")
            for name, f in ONE_FEATURE_MODELS.items()
        ],
    )


def scored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reg_frame with a split and the predictions of three one-feature models fitted on train."""
    data = reg_split(spark, sf_dir)
    return prediction_columns(data, one_feature_fits(data.filter("split = 'train'"), list(ONE_FEATURE_MODELS.values())))


def pred_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long predictions table: (ids, model, split, y_true, y_pred)."""
    cells = [F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").alias("y_pred")) for m in ONE_FEATURE_MODELS]
    return scored_frame(spark, sf_dir).select(*REG_IDS, "split", F.col("label").alias("y_true"), F.inline(F.array(*cells)))


SCORED_SQL = f"""{REG_SPLIT_SQL},
co AS (SELECT {", ".join(f"regr_intercept(label, {f}) AS a_{m}, regr_slope(label, {f}) AS b_{m}" for m, f in ONE_FEATURE_MODELS.items())}
       FROM s WHERE split = 'train'),
scored AS (SELECT s.*, {", ".join(f"a_{m} + b_{m} * {f} AS pred_{m}" for m, f in ONE_FEATURE_MODELS.items())} FROM s, co)"""
PRED_SQL = f"""{SCORED_SQL},
preds AS ({" UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{m}' AS model, split, fold, row_key, label AS y_true, pred_{m} AS y_pred, label - pred_{m} AS e FROM scored" for m in ONE_FEATURE_MODELS)})"""


def describe_sql(source: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS n, avg({column}) AS mean, stddev_samp({column}) AS std, "
        f"min({column})::DOUBLE AS lo, quantile_cont({column}::DOUBLE, 0.25) AS q25, quantile_cont({column}::DOUBLE, 0.5) AS q50, "
        f"quantile_cont({column}::DOUBLE, 0.75) AS q75, max({column})::DOUBLE AS hi FROM {source}"
    )


def fences_sql(source: str, column: str, factor: float = 1.5) -> str:
    """One row (lo, hi) of IQR fences."""
    return (
        f"SELECT q1 - {factor}::DOUBLE * (q3 - q1) AS lo, q3 + {factor}::DOUBLE * (q3 - q1) AS hi FROM "
        f"(SELECT quantile_cont({column}::DOUBLE, 0.25) AS q1, quantile_cont({column}::DOUBLE, 0.75) AS q3 FROM {source})"
    )
