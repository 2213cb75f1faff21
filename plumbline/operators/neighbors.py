"""Exact k-nearest-neighbour regression.

A small training side (checked by count) is broadcast and queries are answered in
place. A larger one is cut into leaves of a k-d partition. Every distinct query
vector is first answered in its own leaf, then sent only to the leaves that can
still hold something nearer; each (query, leaf) meeting returns at most ``k`` rows.
Ties in distance go to the smaller hash of the rows' ids: results depend neither on row order nor on labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import KEY_SPACE, fraction_threshold, row_key
from plumbline.session import scratch_path, small_frame

CHUNK_CELLS = 4_000_000  # distances held at once


def powers(difference: np.ndarray, p: float) -> np.ndarray:
    return np.square(difference) if p == 2 else np.abs(difference) ** p


def nearest(queries: np.ndarray, points: np.ndarray, k: int, p: float = 2) -> tuple[np.ndarray, np.ndarray]:
    """Distances (to the power ``p``) and positions of the k nearest points; ``points`` come in the order of ties."""
    k = min(k, len(points))
    distance, found = np.empty((len(queries), k)), np.empty((len(queries), k), dtype=np.int64)
    if k == 0:
        return distance, found
    step = max(1, CHUNK_CELLS // max(1, len(points)))
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        d2 = np.zeros((len(block), len(points)))
        for j in range(points.shape[1]):
            d2 += powers(block[:, j : j + 1] - points[None, :, j], p)
        order = np.argpartition(d2, k - 1, axis=1)[:, :k]
        furthest = np.take_along_axis(d2, order, axis=1).max(axis=1)
        tied = np.flatnonzero((d2 <= furthest[:, None]).sum(axis=1) > k)
        order[tied] = np.argsort(d2[tied], axis=1, kind="stable")[:, :k]
        distance[start : start + step] = np.take_along_axis(d2, order, axis=1)
        found[start : start + step] = order
    return distance, found


def averaged(distance: np.ndarray, labels: np.ndarray, weights: str, p: float) -> np.ndarray:
    """The prediction of each row of neighbours: plain, or by inverse distance (equal vectors alone, if there are any)."""
    if not labels.shape[1]:
        return np.full(len(labels), np.nan)
    if weights == "uniform":
        return labels.mean(axis=1)
    with np.errstate(divide="ignore"):
        share = 1.0 / distance ** (1 / p)
    equal = np.isinf(share).any(axis=1)
    share[equal] = np.isinf(share[equal])
    return (share * labels).sum(axis=1) / share.sum(axis=1)


@dataclass
class Partition:
    """A k-d partition: inner nodes (feature, cut, left, right) and boxes of the leaves below."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    @classmethod
    def build(cls, sample: np.ndarray, leaf_rows: float) -> "Partition":
        tree = cls()

        def grow(rows: np.ndarray) -> int:
            node = len(tree.feature)
            for values in (tree.feature, tree.left, tree.right, tree.leaf):
                values.append(-1)
            tree.cut.append(math.nan)
            spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(1)
            if len(rows) > leaf_rows and spread.max() > 0:
                j = int(np.argmax(spread / tree_scale))
                cut = float(np.median(rows[:, j]))
                below = rows[:, j] < cut
                if not below.any():
                    cut = float(np.min(rows[rows[:, j] > cut, j])) if (rows[:, j] > cut).any() else cut
                    below = rows[:, j] < cut
                if below.any() and not below.all():
                    tree.feature[node], tree.cut[node] = j, cut
                    tree.left[node], tree.right[node] = grow(rows[below]), grow(rows[~below])
                    return node
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            return node

        tree_scale = np.maximum(np.ptp(sample, axis=0), 1e-300) if len(sample) else np.ones(sample.shape[1])
        grow(sample)
        return tree

    def assign(self, points: np.ndarray) -> np.ndarray:
        result = np.zeros(len(points), dtype=np.int32)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                result[rows] = self.leaf[node]
                continue
            below = points[rows, self.feature[node]] < self.cut[node]
            stack += [(self.left[node], rows[below]), (self.right[node], rows[~below])]
        return result

    def boxes(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounding boxes of all nodes from those of the leaves (empty leaves have inverted ones)."""
        n = len(self.feature)
        lows, highs = np.full((n, low.shape[1]), np.inf), np.full((n, low.shape[1]), -np.inf)
        for node in reversed(range(n)):  # children come after their parent
            if self.leaf[node] >= 0:
                lows[node], highs[node] = low[self.leaf[node]], high[self.leaf[node]]
            else:
                below = [self.left[node], self.right[node]]
                lows[node], highs[node] = lows[below].min(axis=0), highs[below].max(axis=0)
        return lows, highs

    def reach(self, points: np.ndarray, radius2: np.ndarray, own: np.ndarray, lows, highs, p: float = 2) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs for the other leaves that the ball of each query touches."""
        rows_out, leaf_out = [], []
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not np.all(lows[node] <= highs[node]):
                continue
            gap = np.maximum(0.0, np.maximum(lows[node] - points[rows], points[rows] - highs[node]))
            rows = rows[powers(gap, p).sum(axis=1) <= radius2[rows]]
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                rows = rows[own[rows] != self.leaf[node]]
                rows_out.append(rows)
                leaf_out.append(np.full(len(rows), self.leaf[node], dtype=np.int32))
            else:
                stack += [(self.left[node], rows), (self.right[node], rows)]
        if not rows_out:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
        return np.concatenate(rows_out), np.concatenate(leaf_out)


@dataclass(frozen=True)
class NearestNeighbors:
    k: int
    features: Sequence[str]
    label: str
    ids: Sequence[str]
    weights: str = "uniform"
    p: float = 2
    broadcast_rows: int = 10_000
    leaf_rows: int = 512
    sample_rows: int = 100_000
    queries_per_group: int = 50_000

    def __post_init__(self):
        if not self.ids:
            raise ValueError("the rows' ids are needed to break ties")
        if self.weights not in ("uniform", "distance") or self.p < 1:
            raise ValueError("weights must be uniform or distance, p at least 1")

    def fit(self, df: DataFrame) -> "NeighborModel":
        names = [f"x{i}" for i in range(len(self.features))]
        points = df.select(
            *[F.col(f).cast("double").alias(n) for f, n in zip(self.features, names)],
            F.col(self.label).cast("double").alias("label"),
            row_key(*self.ids).cast("double").alias("tie"),
        ).dropna()
        # Of equal vectors only the k first in the order of ties can ever be used.
        rank = F.row_number().over(Window.partitionBy(*names).orderBy("tie", "label"))
        points = points.withColumn("copy", rank).filter(F.col("copy") <= self.k)
        stored = scratch_path(df.sparkSession, "neighbors")
        points.write.parquet(stored)
        points = df.sparkSession.read.parquet(stored)
        n = points.count()
        if n <= self.broadcast_rows:
            return NeighborModel(self, points, n)
        share = min(1.0, self.sample_rows / n)
        in_sample = row_key(*names, "copy", seed=7) < F.lit(min(KEY_SPACE, fraction_threshold(share)))
        sample = points.filter(in_sample).select(*names).toPandas().to_numpy()  # about sample_rows rows
        partition = Partition.build(sample, max(8.0, self.leaf_rows * share))
        placed = points.mapInPandas(
            _placer(partition, names), ", ".join(f"{n} double" for n in names) + ", label double, tie double, leaf int"
        )
        leaves = scratch_path(df.sparkSession, "neighbor-leaves")
        placed.repartition("leaf").write.parquet(leaves)
        placed = df.sparkSession.read.parquet(leaves)
        low, high = np.full((partition.leaves, len(names)), np.inf), np.full((partition.leaves, len(names)), -np.inf)
        extents = placed.groupBy("leaf").agg(*[F.min(n) for n in names], *[F.max(n) for n in names])
        for row in extents.collect():  # one row per leaf
            low[row[0]], high[row[0]] = row[1 : 1 + len(names)], row[1 + len(names) :]
        return NeighborModel(self, placed, n, partition, *partition.boxes(low, high))


def _placer(partition: Partition, names: Sequence[str]):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[*names, "label", "tie"]].copy()
            out["leaf"] = partition.assign(batch[list(names)].to_numpy(dtype=float))
            yield out

    return place


@dataclass(frozen=True)
class NeighborModel:
    config: NearestNeighbors
    points: DataFrame
    n: int
    partition: Partition | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    @property
    def k(self) -> int:
        return self.config.k

    def transform(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        features = list(self.config.features)
        names = [f"x{i}" for i in range(len(features))]
        vectors = df.select(*[F.col(f).cast("double").alias(n) for f, n in zip(features, names)]).dropna().distinct()
        answers = (self._broadcast if self.partition is None else self._partitioned)(vectors, names)
        keys = [f"__{n}" for n in names]
        keyed = df.select("*", *[F.col(f).cast("double").alias(key) for f, key in zip(features, keys)])
        answers = answers.select(*[F.col(n).alias(key) for n, key in zip(names, keys)], F.col("prediction").alias(column))
        return keyed.join(answers, keys, "left").drop(*keys)

    def _broadcast(self, vectors: DataFrame, names: list[str]) -> DataFrame:
        table = self.points.select(*names, "label", "tie").toPandas().sort_values(["tie", "label"], kind="stable")  # n <= broadcast_rows
        shared = vectors.sparkSession.sparkContext.broadcast((table[names].to_numpy(), table["label"].to_numpy()))
        k, weights, p = self.config.k, self.config.weights, self.config.p

        def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            points, labels = shared.value
            for batch in batches:
                distance, found = nearest(batch[names].to_numpy(dtype=float), points, k, p)
                yield batch.assign(prediction=averaged(distance, labels[found], weights, p))

        return vectors.mapInPandas(answer, ", ".join(f"{n} double" for n in names) + ", prediction double")

    def _partitioned(self, vectors: DataFrame, names: list[str]) -> DataFrame:
        spark = vectors.sparkSession
        partition, low, high, k, p = self.partition, self.low, self.high, self.config.k, self.config.p
        vector_ddl = ", ".join(f"{n} double" for n in names)

        def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(leaf=partition.assign(batch[names].to_numpy(dtype=float)))

        first = self._meet(vectors.mapInPandas(home, f"{vector_ddl}, leaf int"), names)
        stored = scratch_path(spark, "neighbor-first")
        first.write.parquet(stored)
        first = spark.read.parquet(stored)

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                points = batch[names].to_numpy(dtype=float)
                rows, leaves = partition.reach(
                    points, batch["radius"].to_numpy(dtype=float), batch["leaf"].to_numpy(), low, high, p
                )
                out = batch[names].iloc[rows].copy()
                out["leaf"] = leaves
                yield out

        # The k-th distance in the own leaf bounds the search; fewer than k points there bound nothing.
        radius = first.groupBy(*names, "leaf").agg(
            F.when(F.count("*") >= k, F.max("distance")).otherwise(F.lit(math.inf)).alias("radius")
        )
        empty = vectors.mapInPandas(home, f"{vector_ddl}, leaf int").join(radius, [*names, "leaf"], "left")
        probes = empty.withColumn("radius", F.coalesce("radius", F.lit(math.inf))).mapInPandas(probe, f"{vector_ddl}, leaf int")
        found = first.unionByName(self._meet(probes, names))
        order = Window.partitionBy(*names).orderBy("distance", "tie", "label")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if self.config.weights == "uniform":
            return best.groupBy(*names).agg(F.avg("label").alias("prediction"))
        share = F.try_divide(F.lit(1.0), F.pow("distance", F.lit(1.0 / p)))
        near = F.avg(F.when(F.col("distance") == 0, F.col("label")))
        return best.groupBy(*names).agg(F.coalesce(near, F.sum(share * F.col("label")) / F.sum(share)).alias("prediction"))

    def _meet(self, queries: DataFrame, names: list[str]) -> DataFrame:
        """The k nearest points of each (query, leaf); leaves with many queries are met in several groups."""
        spark, k, p = queries.sparkSession, self.config.k, self.config.p
        load = queries.groupBy("leaf").count().collect()  # one row per leaf
        groups = small_frame(
            spark,
            [(r["leaf"], max(1, math.ceil(r["count"] / self.config.queries_per_group))) for r in load],
            "leaf int, parts int",
        )
        asked = queries.join(F.broadcast(groups), "leaf").withColumn(
            "part", F.pmod(F.xxhash64(*names), F.col("parts")).cast("int")
        )
        held = self.points.join(F.broadcast(groups), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            right = right.sort_values(["tie", "label"], kind="stable")
            if not len(left) or not len(right):
                return pd.DataFrame(columns=[*names, "leaf", "distance", "tie", "label"])
            distance, at = nearest(left[names].to_numpy(), right[names].to_numpy(), k, p)
            width = distance.shape[1]
            out = left[[*names, "leaf"]].loc[left.index.repeat(width)].reset_index(drop=True)
            at = at.ravel()
            return out.assign(distance=distance.ravel(), tie=right["tie"].to_numpy()[at], label=right["label"].to_numpy()[at])

        return (
            asked.select(*names, "leaf", "part")
            .groupBy("leaf", "part")
            .cogroup(held.select(*names, "label", "tie", "leaf", "part").groupBy("leaf", "part"))
            .applyInPandas(meet, ", ".join(f"{n} double" for n in names) + ", leaf int, distance double, tie double, label double")
        )
