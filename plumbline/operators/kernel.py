"""Epsilon-insensitive regression in the RBF kernel, in the span of landmarks.

Landmarks are drawn by distributed k-means++: each round draws rows with chances in proportion to their squared distance from the
landmarks so far, by hashes of their ids. The fit then needs one scan a step: each task returns the cross products of its
rows' kernel values, and the driver solves for as many weights as there are landmarks. All folds of a
cross-validation share the scans, each with landmarks, width and weights that its held-out rows have no part in.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import row_key
from plumbline.operators.splitting import require_folds
from plumbline.operators.stats import spread
from plumbline.session import small_frame

#: Rounds of drawing; each draws as many rows as there are landmarks.
ROUNDS = 4
#: Scans at most, and the relative gain of the objective below which there is no further one.
STEPS, TOLERANCE = 60, 1e-5
#: Tasks that add up what all others return.
ADDERS = 32
#: Eigenvalues of the landmarks' kernel below this share of the largest are taken as zero.
FLAT = 1e-9
#: Values of some rows that are worked on together, so that they stay in a core's cache.
CACHED_VALUES = 32_768
PREDICTION = "prediction"


def _runs(n: int, width: int) -> Iterator[slice]:
    """Runs of ``n`` rows that hold ``CACHED_VALUES`` values of ``width`` columns, or one row."""
    step = max(1, CACHED_VALUES // max(1, width))
    return (slice(a, a + step) for a in range(0, n, step))


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Distances of all rows to all centres, from differences: exact zeros for equal points."""
    found = np.zeros((len(x), len(centers)))
    for run in _runs(*found.shape):
        off = np.empty_like(found[run])
        for j in range(x.shape[1]):
            np.subtract(x[run, j, None], centers[None, :, j], out=off)
            off *= off
            found[run] += off
    return found


def kernel_values(x: np.ndarray, centers: np.ndarray, gamma: float) -> np.ndarray:
    """The kernel of all rows and all centres."""
    found = np.empty((len(x), len(centers)))
    for run in _runs(*found.shape):
        off = squared_distances(x[run], centers)
        off *= -gamma
        np.exp(off, out=found[run])
    return found


def nearest_centers(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row (the first of equal ones) and its squared distance."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x))
    for run in _runs(len(x), len(centers)):
        off = squared_distances(x[run], centers)
        at[run], far[run] = off.argmin(axis=1), off.min(axis=1)
    return at, far


@dataclass
class View:
    """One model of a joint fit: the fold it does not see and what is known of it so far."""

    held_out: int
    gamma: float
    mean: float
    scale: float  # deviation of the labels
    centers: np.ndarray
    root: np.ndarray | None = None
    beta: np.ndarray | None = None

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """Kernel values in an orthonormal basis of the landmarks' span, and a one for the intercept."""
        found = np.ones((len(x), self.root.shape[1] + 1))
        np.matmul(kernel_values(x, self.centers, self.gamma), self.root, out=found[:, :-1])
        return found


@dataclass(frozen=True)
class Rows:
    """Complete rows, cached as ``key, fold, y, x0, x1, ...``, and the number of tasks that scan them."""

    frame: DataFrame
    tasks: int


Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _opened(batch: pa.RecordBatch, d: int) -> Block:
    key, fold, y, *x = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3 + d))
    return key, fold, y, np.column_stack(x) if d else np.empty((len(key), 0))


def _added(rows: Rows, d: int, width: int, part: Callable[[Block], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over all blocks of rows: by task, by adder where there are many, and of at most ``ADDERS`` results on the driver."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + part(_opened(batch, d)), True
        if seen:
            slot = TaskContext.get().partitionId() % ADDERS
            yield pa.record_batch([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "body"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width), False
        for batch in batches:
            for body in batch.column("body"):
                total, seen = total + np.frombuffer(body.as_py()), True
        if seen:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["body"])

    sums = rows.frame.mapInArrow(first, "slot int, body binary")
    if rows.tasks > ADDERS:
        sums = sums.repartition(ADDERS, "slot").mapInArrow(again, "body binary")
    return sum((np.frombuffer(r["body"]) for r in sums.collect()), np.zeros(width))


def _chances(keys: np.ndarray, turn: int) -> np.ndarray:
    """Uniform numbers in ``(0, 1]`` by a hash of the row's key and the round."""
    mixed = keys.astype(np.uint64) ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(factor)
    return ((mixed >> np.uint64(11)).astype(np.float64) + 1.0) / 2.0**53


def _drawn(rows: Rows, d: int, views: Sequence[View], size: int, turn: int) -> list[np.ndarray]:
    """``size`` rows for each view, without replacement, with chances by squared distance from its centres."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty((0, 2 + d)) for _ in views]
        for batch in batches:
            key, fold, _, x = _opened(batch, d)
            waiting = -np.log(_chances(key, turn))
            for v, view in enumerate(views):
                far = nearest_centers(x, view.centers)[1] if len(view.centers) else np.ones(len(x))
                use = (fold != view.held_out) & (far > 0)
                asked = np.column_stack([waiting[use] / far[use], key[use], x[use]])
                both = np.concatenate([best[v], asked])
                best[v] = both[np.lexsort((both[:, 1], both[:, 0]))[:size]]
        for v, found in enumerate(best):
            columns = [pa.array(np.full(len(found), v), pa.int32()), *[pa.array(found[:, i]) for i in range(2 + d)]]
            yield pa.record_batch(columns, ["view", "rank", "key", *[f"x{i}" for i in range(d)]])

    names = ["rank", "key", *[f"x{i}" for i in range(d)]]
    found = rows.frame.mapInArrow(draw, "view int, " + ", ".join(f"{n} double" for n in names))
    groups = [["view", F.pmod(F.col("key"), F.lit(float(ADDERS)))], ["view"]]
    for part in groups[rows.tasks <= ADDERS :]:
        found = found.withColumn("n", F.row_number().over(Window.partitionBy(*part).orderBy("rank", "key"))).where(F.col("n") <= size).drop("n")
    table = found.toPandas()  # views times `size` rows
    return [table.loc[table["view"] == v, names[2:]].to_numpy() for v in range(len(views))]


def thinned(points: np.ndarray, weights: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` of the drawn points by weighted k-means++, then moved to the means of what is nearest to them."""
    if len(points) <= size:
        return points
    rng, chosen = np.random.default_rng(seed), []
    far = np.ones(len(points))
    for _ in range(size):
        chance = weights * far
        if chance.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=chance / chance.sum())))
        near = squared_distances(points, points[chosen[-1:]])[:, 0]
        far = near if len(chosen) == 1 else np.minimum(far, near)
    centers = points[chosen]
    for _ in range(10):
        nearest = squared_distances(points, centers).argmin(axis=1)
        for c in np.unique(nearest):
            mass = weights[nearest == c]
            if mass.sum() > 0:
                centers[c] = (points[nearest == c] * mass[:, None]).sum(axis=0) / mass.sum()
    return np.unique(centers, axis=0)


def place_landmarks(rows: Rows, d: int, views: Sequence[View], size: int, seed: int) -> None:
    """Gives every view its landmarks: all distinct rows where there are no more than ``size``."""
    for turn in range(ROUNDS):
        drawn = _drawn(rows, d, views, size, turn)
        for view, more in zip(views, drawn):
            view.centers = np.unique(np.concatenate([view.centers, more]), axis=0)
        if not any(map(len, drawn)):
            break
    ends = np.cumsum([len(v.centers) for v in views])

    def nearest(block: Block) -> np.ndarray:
        _, fold, _, x = block
        found = []
        for view in views:
            at = nearest_centers(x[fold != view.held_out], view.centers)[0]
            found.append(np.bincount(at, minlength=len(view.centers)).astype(float))
        return np.concatenate(found)

    if any(len(v.centers) > size for v in views):
        counts = _added(rows, d, int(ends[-1]), nearest)
        for view, end in zip(views, ends):
            view.centers = thinned(view.centers, counts[end - len(view.centers) : end], size, seed)
    for view in views:
        values, vectors = np.linalg.eigh(np.exp(-view.gamma * squared_distances(view.centers, view.centers)))
        kept = values > FLAT * values[-1]
        view.root = vectors[:, kept] / np.sqrt(values[kept])
        view.beta = np.append(np.zeros(int(kept.sum())), view.mean)


def settle(rows: Rows, d: int, views: Sequence[View], cost: float, epsilon: float) -> None:
    """Weights that minimise ``|w|^2 / 2 + cost * sum(max(0, |y - f| - epsilon))``.

    Each side of the loss lies below a parabola that touches it at the present residual; the
    minimum of the parabolas' sum never has a higher loss and is a linear solve.
    """
    sizes = [len(v.beta) for v in views]
    ends = np.cumsum([s * s + s + 1 for s in sizes])
    before, done = [np.inf] * len(views), [False] * len(views)
    for step in range(STEPS):
        still = [v for v, stopped in zip(views, done) if not stopped]
        soft = max(0.4**step * 0.1, 1e-5)

        def products(block: Block) -> np.ndarray:
            _, fold, y, x = block
            found = np.zeros(int(ends[-1]))
            for view, size, end in zip(views, sizes, ends):
                if not any(view is s for s in still):
                    continue
                use = fold != view.held_out
                phi, label = view.mapped(x[use]), y[use]
                off = label - phi @ view.beta
                least = max(soft * view.scale, 1e-12)
                over, under = (0.5 / np.maximum(np.abs(off - side), least) for side in (epsilon, -epsilon))
                gram = (phi * (over + under)[:, None]).T @ phi
                aim = phi.T @ (over * (label - epsilon) + under * (label + epsilon))
                loss = np.maximum(np.abs(off) - epsilon, 0.0).sum()
                found[end - size * size - size - 1 : end] = np.concatenate([gram.ravel(), aim, [loss]])
            return found

        total = _added(rows, d, int(ends[-1]), products)
        for i, (view, size, end) in enumerate(zip(views, sizes, ends)):
            if done[i]:
                continue
            part = total[end - size * size - size - 1 : end]
            gram, aim, loss = part[: size * size].reshape(size, size), part[size * size : -1], part[-1]
            now = 0.5 * float(view.beta[:-1] @ view.beta[:-1]) + cost * loss
            done[i] = soft <= 1e-5 and before[i] - now <= TOLERANCE * max(now, 1e-12)
            before[i] = now
            if not done[i]:
                ridge = np.diag(np.append(np.ones(size - 1), 0.0))
                view.beta = np.linalg.lstsq(ridge + cost * gram, cost * aim, rcond=None)[0]
        if all(done):
            break


@dataclass(frozen=True)
class KernelModel:
    """``intercept + sum(weight * exp(-gamma * |x - landmark|^2))``: bounded by the number of landmarks, whatever the rows."""

    features: list[str]
    centers: list[list[float]]
    weights: list[float]
    intercept: float
    gamma: float

    def transform(self, df: DataFrame) -> DataFrame:
        centers, weights = np.array(self.centers).reshape(-1, len(self.features)), np.array(self.weights)
        gamma, intercept = self.gamma, self.intercept

        @F.pandas_udf("double")
        def predicted(*x: pd.Series) -> pd.Series:
            values = np.column_stack([c.to_numpy(dtype=float) for c in x])
            return pd.Series(kernel_values(values, centers, gamma) @ weights + intercept)

        return df.withColumn(PREDICTION, predicted(*[F.col(f).cast("double") for f in self.features]))

    def save(self, path: str) -> None:
        small_frame(SparkSession.active(), [(json.dumps(dataclasses.asdict(self)),)], "settings string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "KernelModel":
        return cls(**json.loads(spark.read.parquet(path).first()[0]))


@dataclass(frozen=True)
class KernelEstimator:
    """Fits one kernel model, or those of all folds together.

    ``C`` and ``epsilon`` are those of support vector regression; ``gamma`` is a number, ``auto`` (one by the number of features)
    or ``scale`` (that, by the variance of all feature values); ``components`` is the number of landmarks. With no
    fewer landmarks than distinct rows the fit is that of the whole kernel. Rows that lack a value have no part in it.
    """

    params: Mapping[str, Any]
    features: Sequence[str]
    label: str
    ids: Sequence[str] = ()
    seed: int = 42

    def _rows(self, df: DataFrame, fold: str | None) -> Rows:
        complete = df.dropna(subset=[*self.features, self.label])
        frame = spread(
            complete.select(
                row_key(*(self.ids or self.features), seed=self.seed).alias("key"),
                (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
                F.col(self.label).cast("double").alias("y"),
                *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(self.features)],
            )
        )
        return Rows(frame, frame.rdd.getNumPartitions())

    def _views(self, rows: Rows, held: Sequence[int]) -> list[View]:
        d = len(self.features)
        names = ["y", *[f"x{i}" for i in range(d)]]
        found = rows.frame.groupBy("fold").agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.avg, F.var_pop)]).collect()  # one row per fold
        if held != [-1]:
            require_folds([r["fold"] for r in found], len(held))
        return [self._view(h, [r for r in found if r["fold"] != h], names) for h in held]

    def _view(self, held_out: int, parts: Sequence, names: Sequence[str]) -> View:
        if not parts:
            raise ValueError("a kernel model needs rows that have all features and a label")
        share = np.array([r["n"] for r in parts], dtype=float)
        share /= share.sum()
        means, variances = (np.array([[r[f"{kind}_{c}"] for c in names] for r in parts]) for kind in ("avg", "var_pop"))
        mean = share @ means
        variance = share @ (variances + (means - mean) ** 2)
        spread_of_all = float((variance[1:] + (mean[1:] - mean[1:].mean()) ** 2).mean())
        gamma, d = self.params["gamma"], len(self.features)
        if gamma == "scale":
            gamma = 1.0 / (d * spread_of_all) if spread_of_all > 0 else 1.0
        elif gamma == "auto":
            gamma = 1.0 / d
        return View(held_out, float(gamma), float(mean[0]), float(np.sqrt(variance[0])), np.empty((0, d)))

    def _fitted(self, rows: Rows, held: Sequence[int]) -> list[View]:
        views, d = self._views(rows, held), len(self.features)
        place_landmarks(rows, d, views, self.params["components"], self.seed)
        settle(rows, d, views, float(self.params["C"]), float(self.params["epsilon"]))
        return views

    def fit(self, df: DataFrame) -> KernelModel:
        rows = self._rows(df, None)
        try:
            view = self._fitted(rows, [-1])[0]
        finally:
            rows.frame.unpersist()
        weights = view.root @ view.beta[:-1]
        return KernelModel(list(self.features), view.centers.tolist(), weights.tolist(), float(view.beta[-1]), view.gamma)

    def fold_rmse(self, df: DataFrame, fold: str, folds: int) -> list[float]:
        """The error on each fold of the model of all others."""
        rows, d = self._rows(df, fold), len(self.features)
        try:
            views = self._fitted(rows, list(range(folds)))

            def errors(block: Block) -> np.ndarray:
                _, of, y, x = block
                found = np.zeros(2 * folds)
                for view in views:
                    held = of == view.held_out
                    off = y[held] - view.mapped(x[held]) @ view.beta
                    found[2 * view.held_out :][:2] = off @ off, held.sum()
                return found

            sums = _added(rows, d, 2 * folds, errors).reshape(folds, 2)
        finally:
            rows.frame.unpersist()
        return [float(np.sqrt(e / n)) for e, n in sums]
