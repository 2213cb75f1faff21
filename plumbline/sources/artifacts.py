"""Storing and loading fitted models, parameters, results and the manifest."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.cleaning import CapperModel, ImputerModel
from plumbline.operators.engineering import FeatureEngineer, FeatureEngineerModel
from plumbline.operators.forest import TreeModel
from plumbline.operators.kernel import KernelModel
from plumbline.operators.neighbors import NearestNeighbors, NeighborModel, Partition
from plumbline.operators.regression import Regressor
from plumbline.operators.scaling import ScalerModel
from plumbline.operators.selection import FeatureFlowModel, SelectorModel
from plumbline.session import drop_path, move_path, path_exists, scratch_path, shared_folder, small_frame

MANIFEST_DDL = (
    "model string, path string, cv_rmse double, test_rmse double, test_r2 double, "
    "feature_names array<string>, original_features array<string>"
)


def save_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def load_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_model(regressor: Regressor, path: str, metadata: DataFrame | None = None) -> None:
    """The model through its own writer, what it reads as a one-row table, results as JSON.

    A neighbour model is its training table, a forest its table of trees, with their settings beside them.
    """
    spark = SparkSession.active()
    if isinstance(regressor.model, NeighborModel):
        regressor.model.points.write.mode("overwrite").parquet(f"{path}/points")
        settings = small_frame(spark, [(json.dumps(_neighbor_settings(regressor.model)),)], "settings string")
        settings.write.mode("overwrite").parquet(f"{path}/neighbors")
    elif isinstance(regressor.model, TreeModel):
        regressor.model.save(f"{path}/forest")
    elif isinstance(regressor.model, KernelModel):
        regressor.model.save(f"{path}/kernel")
    else:
        regressor.model.write().overwrite().save(f"{path}/model")
    row = (regressor.name, regressor.label, list(regressor.features))
    small_frame(spark, [row], "name string, label string, features array<string>").write.mode("overwrite").parquet(f"{path}/reads")
    if metadata is not None:
        save_results(metadata, f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> Regressor:
    row = spark.read.parquet(f"{path}/reads").first()
    if path_exists(spark, f"{path}/neighbors"):
        model = _load_neighbors(spark, path)
    elif path_exists(spark, f"{path}/forest"):
        model = TreeModel.load(spark, f"{path}/forest")
    elif path_exists(spark, f"{path}/kernel"):
        model = KernelModel.load(spark, f"{path}/kernel")
    else:
        model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
    return Regressor(row["name"], model, list(row["features"]), row["label"])


def _neighbor_settings(model: NeighborModel) -> dict:
    """Everything but the points: JSON keeps doubles, infinities and NaN as they are."""
    config = {f.name: getattr(model.config, f.name) for f in dataclasses.fields(model.config)}
    config |= {"features": list(config["features"]), "ids": list(config["ids"])}
    tree = None if model.partition is None else dataclasses.asdict(model.partition)
    boxes = [None if b is None else b.tolist() for b in (model.low, model.high)]
    return {"config": config, "n": model.n, "partition": tree, "boxes": boxes}


def _load_neighbors(spark: SparkSession, path: str) -> NeighborModel:
    kept = json.loads(spark.read.parquet(f"{path}/neighbors").first()[0])
    tree = None if kept["partition"] is None else Partition(**kept["partition"])
    boxes = [None if b is None else np.array(b, dtype=float) for b in kept["boxes"]]
    points = spark.read.parquet(f"{path}/points")
    return NeighborModel(NearestNeighbors(**kept["config"]), points, kept["n"], tree, *boxes)


_KINDS = {
    c.__name__: c for c in (ImputerModel, CapperModel, ScalerModel, SelectorModel, FeatureEngineer, FeatureEngineerModel, FeatureFlowModel)
}


def _pack(value):
    if dataclasses.is_dataclass(value):
        fields = {f.name: _pack(getattr(value, f.name)) for f in dataclasses.fields(value)}
        return {"kind": type(value).__name__, **fields}
    if isinstance(value, dict):
        return {k: _pack(v) for k, v in value.items()}
    return [_pack(v) for v in value] if isinstance(value, (list, tuple)) else value


def _unpack(value):
    if isinstance(value, dict) and "kind" in value:
        fields = {k: _unpack(v) for k, v in value.items() if k != "kind"}
        return _KINDS[value["kind"]](**fields)
    if isinstance(value, dict):
        return {k: _unpack(v) for k, v in value.items()}
    return [_unpack(v) for v in value] if isinstance(value, list) else value


def save_fitted(spark: SparkSession, path: str, **parts) -> None:
    """Fitted transformers as named parameter rows."""
    rows = [(name, type(part).__name__, json.dumps(_pack(part))) for name, part in parts.items()]
    small_frame(spark, rows, "name string, kind string, params string").coalesce(1).write.mode("overwrite").parquet(path)


def load_fitted(spark: SparkSession, path: str) -> dict:
    return {r["name"]: _unpack(json.loads(r["params"])) for r in spark.read.parquet(path).collect()}


def write_manifest(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    small_frame(spark, rows, MANIFEST_DDL).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).json(path)


def load_all(spark: SparkSession, manifest_path: str) -> dict[str, Regressor]:
    """Every model of the manifest whose files are there; nothing without a manifest."""
    if not path_exists(spark, manifest_path):
        return {}
    rows = read_manifest(spark, manifest_path).collect()  # one row per model
    return {r["model"]: load_model(spark, r["path"]) for r in rows if path_exists(spark, r["path"])}


def missing_artifacts(spark: SparkSession, manifest: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required models that the manifest does not list, or whose files are not where it says."""
    listed = {r["model"]: r["path"] for r in manifest.select("model", "path").collect()}  # one row per model
    gone = [(name,) for name in required if name not in listed or not path_exists(spark, listed[name])]
    return small_frame(spark, gone, "model string")


def ensure_artifacts(spark: SparkSession, manifest_path: str, required: Sequence[str], retrain: Callable[[], None]) -> bool:
    """Run ``retrain`` if the manifest or one of its required models is missing; True if it ran."""
    stale = not path_exists(spark, manifest_path) or bool(
        missing_artifacts(spark, read_manifest(spark, manifest_path), required).head(1)
    )
    if stale:
        retrain()
    return stale


def fingerprint(frames: Sequence[DataFrame], *more) -> str:
    """A text that changes with the files of the tables read, or with anything else given."""
    seen = []
    for df in frames:
        files = df.select(*[f"_metadata.{m}" for m in ("file_path", "file_size", "file_modification_time")]).distinct()
        seen.append(tuple(files.agg(F.count("*"), F.bit_xor(F.xxhash64(*files.columns))).first()))
    return hashlib.sha256(json.dumps([seen, more], sort_keys=True, default=str).encode()).hexdigest()[:24]


def published(spark: SparkSession, name: str, mark: str, build: Callable[[str], None]) -> str:
    """Where ``name`` is stored for a fingerprint in the shared folder; ``build(path)`` stores it if no process has.

    It is built in a folder of its own and renamed when it is whole, so a reader never sees a part of it, and of two
    processes that build it at once one is kept.
    """
    path = f"{shared_folder(spark)}/published/{mark}/{name}"
    if not path_exists(spark, path):
        draft = scratch_path(spark, f"draft-{name}")
        build(draft)
        if not move_path(spark, draft, path):
            drop_path(spark, draft)
    return path
