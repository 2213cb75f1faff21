"""Reading, landing and describing feature tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from plumbline.functions.columns import nan_to_null
from plumbline.session import path_exists, small_frame

# The housing table and what its columns mean.
HOUSING_COLUMNS = {
    "MedInc": "median income in the block group",
    "HouseAge": "median house age in the block group",
    "AveRooms": "average rooms per household",
    "AveBedrms": "average bedrooms per household",
    "Population": "block group population",
    "AveOccup": "average household members",
    "Latitude": "block group latitude",
    "Longitude": "block group longitude",
}
LABEL = "target"
HOUSING_SCHEMA = StructType(
    [StructField("row_id", LongType())] + [StructField(c, DoubleType()) for c in [*HOUSING_COLUMNS, LABEL]]
)


def _read_csv(spark: SparkSession, path: str, schema: StructType | str | None) -> DataFrame:
    if schema is None:
        raise ValueError("csv needs a schema: inferring one would read the data twice")
    return spark.read.schema(schema).option("header", True).csv(path)


def _read_columnar(fmt: str) -> Callable[[SparkSession, str, StructType | str | None], DataFrame]:
    def read(spark, path, schema):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.format(fmt).load(path)

    return read


READERS: dict[str, Callable[[SparkSession, str, StructType | str | None], DataFrame]] = {
    "csv": _read_csv,
    "parquet": _read_columnar("parquet"),
    "orc": _read_columnar("orc"),
    "json": _read_columnar("json"),
}


def load(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    provider: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Read a table; if nothing is stored at ``path``, land what ``provider`` gives there first.

    Missing numbers are NULL in the result, never NaN.
    """
    if fmt not in READERS:
        raise ValueError(f"format must be one of {tuple(READERS)}")
    if provider is not None and not path_exists(spark, path):
        land(provider(), path, fmt)
    return nan_to_null(READERS[fmt](spark, path, schema))


def land(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table once; an existing one is replaced."""
    if fmt not in READERS:
        raise ValueError(f"format must be one of {tuple(READERS)}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def split_features_label(df: DataFrame, label: str = LABEL, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(row_id, label)


def attach_label(features: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    return features.join(labels, row_id, "inner")


def sink_all(df: DataFrame, path: str, label: str = LABEL, row_id: str = "row_id") -> dict[str, str]:
    """Write the combined table as CSV and features and label as Parquet, from one cached frame."""
    paths = {"combined_csv": f"{path}/combined", "features": f"{path}/features", "label": f"{path}/label"}
    cached = df.persist()
    try:
        features, labels = split_features_label(cached, label, row_id)
        land(cached, paths["combined_csv"], "csv")
        land(features, paths["features"])
        land(labels, paths["label"])
    finally:
        cached.unpersist()
    return paths


def dataset_info(df: DataFrame, descriptions: Mapping[str, str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """(feature, dtype, description, n_samples, n_features)."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    rows = [(f.name, f.dataType.simpleString(), (descriptions or {}).get(f.name, "")) for f in fields]
    table = small_frame(df.sparkSession, rows, "feature string, dtype string, description string")
    n = df.count()  # a footer read for a stored table
    return table.select("*", F.lit(n).cast("bigint").alias("n_samples"), F.lit(len(fields)).cast("bigint").alias("n_features"))
