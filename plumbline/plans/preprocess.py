"""The whole preparation of a table as one lazy projection with fitted parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import numeric_columns
from plumbline.operators.cleaning import CapperModel, Imputer, ImputerModel, OutlierCapper
from plumbline.operators.profile import quality_report
from plumbline.operators.scaling import Scaler, ScalerModel
from plumbline.operators.splitting import split_column, split_exact, split_stratified, test_flag
from plumbline.session import small_frame


@dataclass(frozen=True)
class Prepared:
    """``data`` has a ``split`` column and scaled columns beside the unscaled ones."""

    data: DataFrame
    imputer: ImputerModel
    capper: CapperModel | None
    scaler: ScalerModel
    outlier_info: DataFrame | None
    info: DataFrame
    quality: DataFrame | None = None

    @property
    def train(self) -> DataFrame:
        return self.data.filter("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.data.filter("split = 'test'")


@dataclass(frozen=True)
class Preprocessor:
    """impute -> cap -> split -> scale, each fitted and then applied as expressions.

    ``fit_on="all"`` takes fills and fences from every row before the split, and caps
    the label too; ``fit_on="train"`` and ``cap_label=False`` avoid that leakage.
    ``split`` is ``exact`` (size to the row), ``stratified`` or ``threshold`` (no pass).
    """

    scaling: str = "standard"
    imputation: str = "median"
    outliers: str | None = "iqr"
    factor: float = 1.5
    test_size: float = 0.2
    seed: int = 42
    split: str = "exact"
    fit_on: str = "all"
    cap_label: bool = True
    accuracy: int | None = None

    def run(self, df: DataFrame, ids: Sequence[str], label: str, report_quality: bool = False) -> Prepared:
        features = numeric_columns(df, (label, *ids))
        if self.fit_on == "train":
            df = self._split(df, ids, label)
        fitting = df.filter("split = 'train'") if self.fit_on == "train" else df
        cleanable = [c for c in df.columns if c not in ids and c != "split"]
        imputer = Imputer(self.imputation, cleanable, self.accuracy).fit(fitting)
        filled = imputer.transform(df)
        capper, outlier_info, capped = None, None, filled
        if self.outliers:
            columns = [*features, label] if self.cap_label else features
            capper = OutlierCapper(self.outliers, self.factor, columns, self.accuracy).fit(imputer.transform(fitting))
            outlier_info, capped = capper.info(filled), capper.transform(filled)
        if self.fit_on != "train":
            capped = self._split(capped, ids, label)
        scaler = Scaler(self.scaling, features, "_scaled", self.accuracy).fit(capped.filter("split = 'train'"))
        info = small_frame(
            df.sparkSession,
            [(self.scaling, self.outliers, self.test_size, len(df.columns), len(features))],
            "scaling_method string, outlier_method string, test_size double, n_columns bigint, n_features bigint",
        )
        quality = quality_report(df.drop(*ids)) if report_quality else None
        return Prepared(scaler.transform(capped), imputer, capper, scaler, outlier_info, info, quality)

    def _split(self, df: DataFrame, ids: Sequence[str], label: str) -> DataFrame:
        if self.split == "exact":
            return split_exact(df, ids, self.test_size, self.seed)
        if self.split == "stratified":
            return split_stratified(df, ids, label, self.test_size, seed=self.seed)
        if self.split != "threshold":
            raise ValueError("split must be 'exact', 'stratified' or 'threshold'")
        return df.select("*", split_column(test_flag(ids, self.test_size, self.seed)).alias("split"))


def sizes(prepared: Prepared) -> DataFrame:
    return prepared.data.groupBy("split").agg(F.count("*").alias("n"))
