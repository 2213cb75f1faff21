"""Regression trees, forests and boosting grown on Spark, and scoring with them.

Nodes with many rows are split by histograms: each task routes its rows through what is known of the trees and returns
sums by (tree, node, feature, bin), one shuffle adds them up, and one task for each node picks the cut; as many trees share these
scans as a task can hold the sums of. Once a node's rows fit a
task they are sent to one, which grows the rest of the tree with exact cuts. A table that fits as a whole
is copied to a few tasks, each of which grows a share of the trees. A model is a table of packed trees, never one object on the driver.
"""

from __future__ import annotations

import dataclasses
import json
import struct
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType, StructField, StructType, UserDefinedType, VariantType
from pyspark.storagelevel import StorageLevel

from plumbline.operators.cart import Growth, Tree, grow
from plumbline.operators.jvm import over_partitions
from plumbline.operators.splitting import require_folds
from plumbline.operators.stats import spread
from plumbline.session import release, scratch_path, small_frame

#: Values (rows times features) of a node that one task finishes.
LOCAL_VALUES = 2_000_000
#: Bins of a feature in large nodes.
BINS = 256
#: Bytes of a model that a task holds at once; a smaller model is broadcast.
GROUP_BYTES = 32 << 20
#: Rows that one copy of a group of trees scores.
BLOCK_ROWS = 250_000
#: Rows that are finished at a time, over all trees (about 50 bytes and 8 for each feature in a shuffle).
WAVE_ROWS = 20_000_000
#: Histograms of nodes that a task sums up before it sends them (about 8 KB for each feature).
HELD_HISTOGRAMS = 2_000
#: Histograms of all partitions that the driver adds up itself, so that a level takes one short job.
GATHERED_HISTOGRAMS = 2_000
#: Tasks that the nodes of a wave are finished in, at most.
MOST_TASKS = 2_000
#: Rounds of boosting after which predictions are written.
SETTLED_ROUNDS = 10
#: Boosted models (as of several folds) that share the scans of their rows.
BOOSTED_TOGETHER = 5
PREDICTION, UNLIMITED = "prediction", 30
MODEL_DDL = "fit int, tree int, node int, body binary, gains array<double>, nodes long, depth int"
_POISSON = np.exp(-1.0) * np.cumsum(1.0 / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 16.0)])))


@dataclass(frozen=True)
class Spec:
    """One tree: the model ``fit`` it belongs to, the fold it does not see, and how it grows."""

    fit: int
    tree: int
    seed: int
    how: Growth
    held_out: int = -1
    bootstrap: bool = False
    share: float = 1.0  # of the rows
    use: tuple[int, ...] | None = None  # features; all if None
    inner: bool = False  # keep the value of every node

    def weights(self, keys: np.ndarray, folds: np.ndarray) -> np.ndarray:
        """How often each row counts, by a hash of its key: the same wherever the row is."""
        weight = (folds != self.held_out).astype(np.float64)
        if self.bootstrap or self.share < 1:
            mixed = keys ^ np.uint64(self.salt)
            for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(factor)
            drawn = (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53
            weight *= np.searchsorted(_POISSON, drawn, "right") if self.bootstrap else drawn < self.share
        return weight

    @property
    def salt(self) -> int:
        return (self.seed * 1_000_003 + self.tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)

    def message(self, top: Tree) -> bytes:
        """All of it, with the upper part of its tree, for the loops on the JVM."""
        how, draw = self.how, 1 if self.bootstrap else 2 if self.share < 1 else 0
        depth = -1 if how.max_depth is None else how.max_depth
        head = struct.pack("<iiiiQdiiiidd", self.fit, self.tree, self.held_out, draw, self.salt, self.share, depth, how.min_leaf, how.min_split, self.inner, *how.penalty)
        return head + _array(self.use or (), np.int32) + _text(top.packed())

    def rng(self, node: int = 0) -> np.random.Generator:
        return np.random.default_rng([self.seed, self.fit + 1, self.tree + 1, node])


def _text(raw: bytes) -> bytes:
    return struct.pack("<i", len(raw)) + raw


def _array(values, kind) -> bytes:
    return _text(np.asarray(values, kind).tobytes())


def _plan(specs: Sequence[Spec], tops: Sequence[Tree]) -> bytes:
    return b"".join([_array(_POISSON, np.float64), struct.pack("<i", len(specs)), *(s.message(t) for s, t in zip(specs, tops))])


@dataclass
class Rows:
    """Blocks of complete rows, packed: ``n, keys, folds, y, x``. Labels are centred."""

    blocks: DataFrame
    n: int
    features: list[str]
    center: float
    edges: list[np.ndarray] | None = None  # of the bins of each feature, once they are known
    labels: int = 1  # sets of labels in a block
    parts: int | None = None  # of the blocks, once they are counted
    with_values: Callable[[], DataFrame] | None = None  # the same blocks, where these hold the bins of values alone
    source: DataFrame | None = None  # blocks of the same rows that have their values, if these have not

    @property
    def local(self) -> bool:
        return self.n * max(1, len(self.features)) <= LOCAL_VALUES


def _block(keys, folds, y, x) -> dict[str, Any]:
    return {"n": len(y), "keys": keys.tobytes(), "folds": folds.astype(np.int32).tobytes(), "y": y.tobytes(), "x": np.ascontiguousarray(x).tobytes()}


BLOCK_SCHEMA = pa.schema([("n", pa.int64()), ("keys", pa.binary()), ("folds", pa.binary()), ("y", pa.binary()), ("x", pa.binary())])
BLOCK_DDL = "n long, keys binary, folds binary, y binary, x binary"
CODED_DDL = f"{BLOCK_DDL}, codes binary"
VISIT_SCHEMA = pa.schema([("__group", pa.int32()), ("__block", pa.int32()), ("ids", pa.binary()), ("fits", pa.binary()), ("x", pa.binary())])


def _opened(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for r in table.select(BLOCK_SCHEMA.names).to_pylist():
        x = np.frombuffer(r["x"]).reshape(r["n"], -1)
        yield np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["folds"], np.int32), np.frombuffer(r["y"]), x


def packed_rows(df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str] = (), fold: str | None = None) -> Rows:
    """The complete rows of a table, cached; ids (or else all values) decide which trees a row is drawn for."""
    names = [*features, label]
    complete = df.dropna(subset=names)
    key = F.xxhash64(*(ids or names))
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]
    flat = complete.select(key.alias("key"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), *values)
    n, center = flat.agg(F.count("*"), F.avg(f"v{len(features)}")).first()
    center, d = center or 0.0, len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().astype(np.int64).view(np.uint64)
            x = np.column_stack([batch.column(f"v{i}").to_numpy() for i in range(d)]) if d else np.empty((len(keys), 0))
            one = _block(keys, batch.column("fold").to_numpy(), batch.column(f"v{d}").to_numpy() - center, x)
            yield pa.RecordBatch.from_pylist([one] if len(keys) else [], BLOCK_SCHEMA)

    return Rows(spread(flat.mapInArrow(pack, BLOCK_DDL)), n, list(features), center)


def _whole(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All rows of some blocks, in one order wherever they came from."""
    parts = [np.concatenate(p) for p in zip(*_opened(table))]
    order = np.lexsort((parts[2], parts[0]))
    return tuple(p[order] for p in parts)


def _row(spec: Spec, node: int, tree: Tree, gains: np.ndarray, base: int = 0) -> dict:
    return {"fit": spec.fit, "tree": spec.tree, "node": node, "body": tree.packed(), "gains": gains.tolist(), "nodes": len(tree.feature), "depth": base + tree.depth}


MODEL_SCHEMA = pa.schema([("fit", pa.int32()), ("tree", pa.int32()), ("node", pa.int32()), ("body", pa.binary()), ("gains", pa.list_(pa.float64())), ("nodes", pa.int64()), ("depth", pa.int32())])


def _grown(spec: Spec, x, y, weight, how: Growth, node: int = 0, base: int = 0) -> dict:
    use = list(range(x.shape[1])) if spec.use is None else list(spec.use)
    tree, found = grow(x[:, use], y, weight, how, spec.rng(node), spec.inner)
    if spec.use is not None:
        tree = dataclasses.replace(tree, feature=np.where(tree.feature >= 0, np.array([*use, -1], np.int16)[tree.feature], -1))
    gains = np.zeros(x.shape[1])
    gains[use] = found
    return _row(spec, node, tree, gains, base)


def grow_trees(rows: Rows, specs: Sequence[Spec]) -> DataFrame:
    """The trees as a table (``MODEL_DDL``), written to the shared folder."""
    spark = rows.blocks.sparkSession
    path = scratch_path(spark, "trees")
    if not rows.n:
        raise ValueError("no complete row to grow a tree on")
    if rows.local:
        found = _grow_whole(rows, list(specs))
        found.write.parquet(path)
    else:
        per_wave = max(1, WAVE_ROWS // rows.n)
        beside = min(2, per_wave)  # waves of half the size, two at a time: the last tasks of one do not leave cores idle
        per_wave, paths = per_wave // beside, []
        open_nodes = -(-rows.n * max(1, len(rows.features)) // LOCAL_VALUES)  # of a tree at one level, at most
        together = max(1, HELD_HISTOGRAMS // open_nodes)  # trees whose tops grow in the same scans
        for first in range(0, len(specs), together):
            group = list(specs[first : first + together])
            tops = grow_tops(rows, group)
            paths.append(f"{path}/tops-{first}")
            small_frame(spark, [tuple(_row(s, -1, t.tree(), t.gains).values()) for s, t in zip(group, tops)], MODEL_DDL).write.parquet(paths[-1])

            def finished(start: int, group=group, tops=tops, first=first) -> str:
                wave, part = slice(start, start + per_wave), f"{path}/trees-{first + start}"  # of its own: writers to one folder would clear each other's files
                _finish(rows, group[wave], tops[wave]).write.parquet(part)
                release(spark)
                return part

            with ThreadPoolExecutor(beside) as pool:
                paths += pool.map(finished, range(0, len(group), per_wave))
        return spark.read.parquet(*paths)
    return spark.read.parquet(path)


def _grow_whole(rows: Rows, specs: list[Spec]) -> DataFrame:
    groups = min(len(specs), 2 * rows.blocks.sparkSession.sparkContext.defaultParallelism)

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        keys, folds, y, x = _whole(table)
        return pa.Table.from_pylist([_grown(s, x, y, s.weights(keys, folds), s.how) for s in specs[group::groups]], MODEL_SCHEMA)

    dealt = rows.blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return dealt.repartition(groups, "group").groupBy("group").applyInArrow(run, MODEL_DDL)


@dataclass
class Top:
    """The upper part of a tree, as far as histograms have grown it."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    state: list[str] = field(default_factory=lambda: ["open"])  # open, inner, leaf, or rest (a task finishes it)
    gains: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int16), np.array(self.cut), np.array(self.child, np.int32), np.array(self.value))

    def nodes(self, state: str) -> list[int]:
        return [i for i, s in enumerate(self.state) if s == state]

    def split(self, node: int, found: Mapping, how: Growth, fits: float) -> None:
        self.value[node] = how.value(found["s"], found["w"]) if found["w"] else 0.0
        if found["feature"] < 0:
            self.state[node], self.cut[node] = "leaf", self.value[node]
            return
        self.feature[node], self.cut[node], self.child[node], self.state[node] = found["feature"], found["cut"], len(self.cut), "inner"
        self.gains[found["feature"]] += max(0.0, found["gain"])
        for side in ("left", "right"):
            c, w, s = (found[f"{side}_{m}"] for m in "cws")
            deep = how.max_depth is not None and self.depth[node] + 1 >= how.max_depth
            value = how.value(s, w)
            state = "leaf" if deep else ("rest" if c <= fits else "open")
            first = -1 if state == "rest" else 0  # tells a leaf of the top from one that a task goes on with
            for column, v in zip((self.feature, self.cut, self.child, self.value, self.depth, self.state), (-1, value, first, value, self.depth[node] + 1, state)):
                column.append(v)


SPLIT_DDL = (
    "spec int, node int, feature int, cut double, gain double, w double, s double, c double, "
    "left_w double, left_s double, left_c double, right_w double, right_s double, right_c double"
)
_SPLIT_NAMES = [part.split()[0] for part in SPLIT_DDL.split(", ")]


def feature_edges(flat: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """At most ``BINS - 1`` quantiles of each column, for each key."""
    shares = [i / BINS for i in range(1, BINS)]
    return flat.groupBy(*keys).agg(*[F.array_distinct(F.percentile_approx(c, shares, 10 * BINS)).alias(c) for c in columns], *more)


def table_edges(rows: Rows) -> list[np.ndarray]:
    d = len(rows.features)
    columns = [f"v{f}" for f in range(d)]
    found = feature_edges(rows.blocks.mapInArrow(_flat_rows(d), ", ".join(f"{c} double" for c in columns)), columns).first()
    return [np.array(found[c] if found[c] else [], float) for c in columns]


def _flat_rows(d: int, specs: list[Spec] | None = None, tops: list[Tree] | None = None, stuck: list[set[int]] | None = None):
    """Over blocks: the features of each row, and with trees given, for each tree and node of ``stuck``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, folds, _, x in _opened(batch):
                if specs is None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[:, f])) for f in range(d)], names=[f"v{f}" for f in range(d)])
                    continue
                for k, (spec, top, nodes) in enumerate(zip(specs, tops, stuck)):
                    at, _ = top.leaves(x)
                    here = np.flatnonzero(np.isin(at, list(nodes)) & (spec.weights(keys, folds) > 0)) if nodes else []
                    if len(here):
                        place = [pa.array(np.full(len(here), k, np.int32)), pa.array(at[here].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays([*place, *[pa.array(x[here, f]) for f in range(d)]], names=["spec", "node", *[f"v{f}" for f in range(d)]])

    return run


SUMS_DDL = "spec int, node int, sums binary"


def histograms(rows: Rows, specs: list[Spec], tops: list[Tree], opened: list[list[int]], edges: list[dict[int, list[np.ndarray]]]) -> DataFrame:
    """``spec, node, sums``: weight, sum, sum of squares and rows by feature and bin, summed over each partition."""
    common = [e for e in edges[0][-1]]
    given = [_plan(specs, tops), _edges(common)]
    for top, nodes, own in zip(tops, opened, edges):
        mine = {node: found for node, found in own.items() if node >= 0 and node in nodes}
        given += [_array(nodes, np.int32), struct.pack("<i", len(mine)), *(struct.pack("<i", node) + _edges(found) for node, found in mine.items())]
        given.append(_array([] if len(own) > 1 else _last_bins(top, common), np.int32))
    return over_partitions(rows.blocks, "Histograms", SUMS_DDL, b"".join(given), rows.labels)


def _edges(found: list[np.ndarray]) -> bytes:
    return struct.pack("<i", len(found)) + b"".join(_array(e, np.float64) for e in found)


def _last_bins(tree: Tree, edges: list[np.ndarray]) -> list[int]:
    """For each node, the last bin on its left: a cut is an edge of the table's bins, unless a node had bins of its own."""
    return [int(np.searchsorted(edges[f], c, "left")) if f >= 0 else 0 for f, c in zip(tree.feature.tolist(), tree.cut.tolist())]


def added(tables: Sequence[bytes]) -> np.ndarray:
    """The sum of the histograms of one node."""
    total = np.frombuffer(tables[0]).copy()
    for raw in tables[1:]:
        total += np.frombuffer(raw)
    return total


def _by_feature(total: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(moment, feature, bin) of a histogram that holds, for each feature, one bin more than it has edges."""
    sums, at = np.zeros((4, len(edges), max(map(len, edges), default=0) + 1)), 0
    for f, e in enumerate(edges):
        sums[:, f, : len(e) + 1] = total[4 * at : 4 * (at + len(e) + 1)].reshape(-1, 4).T
        at += len(e) + 1
    return sums


def best_cut(specs: list[Spec], edges: list[dict[int, list[np.ndarray]]], d: int):
    """For the histogram of one node: its best cut (feature -1 where its label does not vary, -2 where it does but no bins differ)."""

    def run(k: int, node: int, total: np.ndarray) -> dict:
        spec, how = specs[k], specs[k].how
        mine = edges[k].get(node) or edges[k][-1]
        sums = _by_feature(total, mine)
        w, s, q, c = (float(v.sum()) for v in sums[:, 0])
        out = dict.fromkeys(_SPLIT_NAMES, 0.0) | {"spec": k, "node": node, "feature": -1, "w": w, "s": s, "c": c}
        use = list(range(d)) if spec.use is None else list(spec.use)
        if how.tried is not None and how.tried < len(use):
            use = sorted(spec.rng(node).permutation(use)[: how.tried].tolist())
        best = -np.inf
        varies = q - s * s / w > 1e-14 * q and c >= how.min_split
        for f in use if varies else ():
            left_w, left_s, _, left_c = np.cumsum(sums[:, f], axis=1)
            fine = np.flatnonzero((left_c >= how.min_leaf) & (c - left_c >= how.min_leaf) & (sums[3, f] > 0) & (left_c < c))
            fine = fine[fine < len(mine[f])]
            if not len(fine):
                continue
            strength = how.strength(left_s[fine], left_w[fine]) + how.strength(s - left_s[fine], w - left_w[fine])
            i = int(np.argmax(strength))
            b, gain = fine[i], float(strength[i] - how.strength(np.array(s), np.array(w)))
            if strength[i] > best * (1 + 1e-12) and (how.penalty == (0.0, 0.0) or gain > 1e-9 * q):
                best = float(strength[i])
                left = {"left_w": left_w[b], "left_s": left_s[b], "left_c": left_c[b]}
                out |= {"feature": f, "cut": float(mine[f][b]), "gain": gain, **left, "right_w": w - left_w[b], "right_s": s - left_s[b], "right_c": c - left_c[b]}
        if varies and out["feature"] < 0:
            out["feature"] = -2  # the label varies, but no bin tells its rows apart
        return out

    return run


def best_cuts(sums: DataFrame, specs: list[Spec], edges: list[dict[int, list[np.ndarray]]], d: int, most: int) -> list[dict]:
    """The best cut of each open node: on the driver where the histograms of all partitions are few, else by a task for each node."""
    cut = best_cut(specs, edges, d)
    if most <= GATHERED_HISTOGRAMS:
        tables: dict[tuple[int, int], list[bytes]] = {}
        for r in sums.collect():
            tables.setdefault((r["spec"], r["node"]), []).append(r["sums"])
        return [cut(k, node, added(raw)) for (k, node), raw in sorted(tables.items())]

    def run(table: pa.Table) -> pa.Table:
        found = cut(table.column("spec")[0].as_py(), table.column("node")[0].as_py(), added(table.column("sums").to_pylist()))
        return pa.Table.from_pylist([found], pa.schema([(n, pa.int32() if n in ("spec", "node", "feature") else pa.float64()) for n in _SPLIT_NAMES]))

    return [r.asDict() for r in sums.groupBy("spec", "node").applyInArrow(run, SPLIT_DDL).collect()]  # one row per open node


def grow_tops(rows: Rows, specs: list[Spec], fits: float | None = None) -> list[Top]:
    """Trees as far as nodes hold more than ``fits`` rows (what a task finishes, unless given), level by level.

    Where the bins of the whole table do not tell a node's rows apart, it gets quantiles of its own.
    What stays on the driver is a few numbers for each node that is too large for a task.
    """
    d = len(rows.features)
    fits = LOCAL_VALUES / max(1, d) if fits is None else fits
    if rows.edges is None:
        rows.edges = table_edges(rows)
    if rows.parts is None:
        rows.parts = rows.blocks.rdd.getNumPartitions()
    edges: list[dict[int, list[np.ndarray]]] = [{-1: rows.edges} for _ in specs]
    tops = [Top(gains=np.zeros(d)) for _ in specs]
    for t, s in zip(tops, specs):
        if s.how.max_depth == 0:
            t.state[0] = "rest" if rows.n <= fits else "open"
    while any(t.nodes("open") for t in tops):
        trees, opened = [t.tree() for t in tops], [t.nodes("open") for t in tops]
        found = best_cuts(histograms(rows, specs, trees, opened, edges), specs, edges, d, rows.parts * sum(map(len, opened)))
        stuck: list[dict[int, dict]] = [{} for _ in specs]
        for r in found:
            k, node, result = r["spec"], r["node"], dict(r)
            if r["feature"] == -2 and node not in edges[k]:
                stuck[k][node] = result
                continue
            if specs[k].how.max_depth is not None and tops[k].depth[node] >= specs[k].how.max_depth:
                result["feature"] = -1
            tops[k].split(node, result | {"feature": max(-1, result["feature"])}, specs[k].how, fits)
        for k, t in enumerate(tops):  # a tree without a row is a leaf
            met = {r["node"] for r in found if r["spec"] == k}
            for node in set(opened[k]) - met:
                t.state[node] = "leaf"
        for (k, node), own in _own_edges(rows, specs, trees, stuck).items():
            use = range(d) if specs[k].use is None else specs[k].use
            if any(len(own[f]) for f in use):
                edges[k][node] = own
            else:  # its rows agree in all values
                tops[k].split(node, stuck[k][node] | {"feature": -1}, specs[k].how, fits)
        if rows.with_values is not None and any(len(own) > 1 for own in edges):
            rows = dataclasses.replace(rows, blocks=rows.with_values(), with_values=None, source=None)
    return tops


def _own_edges(rows: Rows, specs: list[Spec], trees: list[Tree], stuck: list[dict[int, dict]]) -> dict[tuple[int, int], list[np.ndarray]]:
    """Quantiles of the values of nodes whose rows no bin of the table tells apart; none for a feature that they agree in.

    Rows that one task could hold are looked at on the driver; more of them give approximate quantiles.
    """
    if not any(stuck):
        return {}
    d, source = len(rows.features), rows.blocks if rows.source is None else rows.source
    columns = [f"v{f}" for f in range(d)]
    if sum(r["c"] for nodes in stuck for r in nodes.values()) * d > LOCAL_VALUES:
        flat = source.mapInArrow(_flat_rows(d, specs, trees, [set(nodes) for nodes in stuck]), f"spec int, node int, {', '.join(f'{c} double' for c in columns)}")
        found = feature_edges(flat, columns, ["spec", "node"], [F.min(c).alias(f"least_{c}") for c in columns] + [F.max(c).alias(f"most_{c}") for c in columns]).collect()
        agree = lambda r, c: r[f"least_{c}"] == r[f"most_{c}"]
        return {(r["spec"], r["node"]): [np.array([] if agree(r, c) or not r[c] else r[c], float) for c in columns] for r in found}
    plan = _plan(specs, trees) + b"".join(_array(list(nodes), np.int32) for nodes in stuck)
    values: dict[tuple[int, int], list[np.ndarray]] = {}
    for r in over_partitions(source, "Values", "spec int, node int, x binary", plan).collect():
        values.setdefault((r["spec"], r["node"]), []).append(np.frombuffer(r["x"]).reshape(-1, d))
    out = {}
    for key, parts in values.items():
        x = np.sort(np.concatenate(parts), axis=0)
        at = np.ceil(np.arange(1, BINS) / BINS * len(x)).astype(int) - 1
        out[key] = [np.unique(x[at, f]) if x[0, f] < x[-1, f] else np.array([]) for f in range(d)]
    return out


PART_DDL = "spec int, node int, n long, keys binary, y binary, x binary, w binary"


def _finish(rows: Rows, specs: list[Spec], tops: list[Top]) -> DataFrame:
    """The subtrees of all nodes that fit a task: rows go to the task of their (tree, node)."""
    trees, rest = [t.tree() for t in tops], [t.nodes("rest") for t in tops]
    plan = _plan(specs, trees)
    parts = over_partitions(rows.blocks, "Route", PART_DDL, plan + b"".join(_array(r, np.int32) for r in rest))
    tasks = min(MOST_TASKS, max(1, 3 * sum(map(len, rest))))  # so many that few nodes share one
    parts = parts.repartition(tasks, "spec", "node")
    if any(s.how.tried is not None and s.how.tried < len(rows.features) for s in specs):  # draws of features are NumPy's
        return parts.groupBy("spec", "node").applyInArrow(_finished_by_draws(specs, [t.depth for t in tops]), MODEL_DDL)
    depths = b"".join(_array(t.depth, np.int32) for t in tops)
    return over_partitions(parts.sortWithinPartitions("spec", "node"), "Finish", MODEL_DDL, _plan(specs, trees) + depths, len(rows.features))


def _finished_by_draws(specs: list[Spec], depths: list[list[int]]):
    def finish(table: pa.Table) -> pa.Table:
        k, node = table.column("spec")[0].as_py(), table.column("node")[0].as_py()
        spec, base = specs[k], depths[k][node]
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        keys, y, weight = joined("keys", np.uint64), joined("y", np.float64), joined("w", np.uint8)
        x = joined("x", np.float64).reshape(len(y), -1)
        order = np.lexsort((y, keys))
        left = None if spec.how.max_depth is None else spec.how.max_depth - base
        how = dataclasses.replace(spec.how, max_depth=left)
        return pa.Table.from_pylist([_grown(spec, x[order], y[order], weight[order], how, node, base)], MODEL_SCHEMA)

    return finish


# Boosting


@dataclass(frozen=True)
class Boost:
    """One boosted model: rounds of trees on the residuals, each from a share of the rows and of the features."""

    fit: int
    rounds: int
    rate: float
    how: Growth
    seed: int
    held_out: int = -1
    share: float = 1.0
    columns: float = 1.0

    def spec(self, tree: int, d: int) -> Spec:
        use = None
        if self.columns < 1:
            drawn = np.random.default_rng([self.seed, 7, tree]).permutation(d)[: max(1, int(self.columns * d))]
            use = tuple(sorted(drawn.tolist()))
        return Spec(self.fit, tree, self.seed, self.how, self.held_out, share=self.share, use=use)


def boost_trees(rows: Rows, boosts: Sequence[Boost]) -> DataFrame:
    """The trees of boosted models as a table; predictions start at the mean of the table's label."""
    spark, d = rows.blocks.sparkSession, len(rows.features)
    path = scratch_path(spark, "boosted")
    if not rows.n:
        raise ValueError("no complete row to grow a tree on")
    if rows.local:
        boosts, groups = list(boosts), len(boosts)

        def run(table: pa.Table) -> pa.Table:
            boost = boosts[table.column("group")[0].as_py()]
            keys, folds, y, x = _whole(table)
            mean = float(y[folds != boost.held_out].mean())
            left, out = y - mean, [_start(boost, mean, d)]
            for i in range(boost.rounds):
                spec = boost.spec(i, d)
                out.append(_grown(spec, x, left, spec.weights(keys, folds), spec.how))
                tree = Tree.unpacked(out[-1]["body"])
                left -= boost.rate * tree.cut[tree.leaves(x)[0]]
            return pa.Table.from_pylist(out, MODEL_SCHEMA)

        dealt = rows.blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        dealt.repartition(groups, "group").groupBy("group").applyInArrow(run, MODEL_DDL).write.parquet(path)
        return spark.read.parquet(path)
    rows.edges = table_edges(rows) if rows.edges is None else rows.edges
    found: list[dict] = []
    of_rounds: dict[int, list[Boost]] = {}
    for boost in boosts:
        of_rounds.setdefault(boost.rounds, []).append(boost)
    for same in of_rounds.values():
        for first in range(0, len(same), BOOSTED_TOGETHER):
            found += _boost(rows, same[first : first + BOOSTED_TOGETHER])
    small_frame(spark, [tuple(tree.values()) for tree in found], MODEL_DDL).write.parquet(path)
    release(spark)
    return spark.read.parquet(path)


def _boost(rows: Rows, boosts: Sequence[Boost]) -> list[dict]:
    """The trees of models of equally many rounds, grown by histograms: a few numbers for each node, which the driver holds anyway.

    Each scan of the rows serves a level of all models. What is left of their labels is cached for a round, beside the bins of the values;
    the values come along only once a node has needed bins of its own.
    """
    spark, d = rows.blocks.sparkSession, len(rows.features)
    out = [_start(b, _mean_without(rows, b.held_out), d) for b in boosts]
    grown = [[Tree.unpacked(o["body"])] for o in out]
    rates = [b.rate for b in boosts]
    binned = lambda trees: [(t, _last_bins(t, rows.edges)) for t in trees]
    lean, blocks, last = True, rows.blocks, binned(t[0] for t in grown)
    held: list[DataFrame] = []

    def kept(table: DataFrame) -> DataFrame:
        held.append(table.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    def with_values() -> DataFrame:
        nonlocal lean, blocks
        lean = False
        taken = [(k, t) for k, trees in enumerate(grown) for t in trees]
        blocks = kept(_taken_off(rows.blocks, rows.edges, binned(t for _, t in taken), [rates[k] for k, _ in taken], [k for k, _ in taken], len(boosts), False))
        return blocks

    try:
        for i in range(boosts[0].rounds):
            specs = [b.spec(i, d) for b in boosts]
            if i and i % SETTLED_ROUNDS == 0:  # so that a lost block is not made again from the first round
                settled = scratch_path(spark, "residuals")
                blocks.write.parquet(settled)
                blocks = spark.read.parquet(settled)
            blocks = kept(_residuals(last, rates)(blocks, rows.edges, lean))
            had = dataclasses.replace(rows, blocks=blocks, labels=len(boosts), parts=None if i == 0 else parts, with_values=with_values if lean else None, source=rows.blocks)
            tops = grow_tops(had, specs, fits=0)
            parts = had.parts
            while len(held) > 1:
                held.pop(0).unpersist()
            trees = [t.tree() for t in tops]
            last = binned(trees) if lean else [(t, []) for t in trees]
            for k, tree in enumerate(trees):
                grown[k].append(tree)
                out.append(_row(specs[k], 0, tree, tops[k].gains))
    finally:
        for table in held:
            table.unpersist()
    return out


def _start(boost: Boost, mean: float, d: int) -> dict:
    """Where predictions start, as a tree of one leaf: the mean of the rows that the model sees."""
    leaf = Tree(np.array([-1], np.int16), np.array([mean / boost.rate]), np.array([0], np.int32))
    return _row(Spec(boost.fit, -1, boost.seed, boost.how), 0, leaf, np.zeros(d))


def _mean_without(rows: Rows, fold: int) -> float:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, folds, y, _ in _opened(batch):
                seen = y[folds != fold]
                yield pa.RecordBatch.from_pydict({"n": [len(seen)], "s": [float(seen.sum())]})

    n, total = rows.blocks.mapInArrow(sums, "n long, s double").agg(F.sum("n"), F.sum("s")).first()
    return total / n


def _taken_off(blocks: DataFrame, edges: list[np.ndarray], trees: Sequence[tuple[Tree, list[int]]], rates: Sequence[float], of: Sequence[int], sets: int, lean: bool) -> DataFrame:
    """Blocks with what trees leave of their set of labels, in their order; a tree goes by bins where it has one for each node."""
    whole = Spec(0, 0, 0, Growth())
    plan = [_plan([whole] * len(trees), [t for t, _ in trees]), _edges(edges), _array(rates, np.float64), _array(of, np.int32)]
    return over_partitions(blocks, "Residuals", CODED_DDL, b"".join([*plan, *(_array(bins, np.int32) for _, bins in trees)]), sets, int(lean))


def _residuals(trees: Sequence[tuple[Tree, list[int]]], rates: Sequence[float]):
    """What one round leaves of the labels: a tree for each model."""
    return lambda blocks, edges, lean: _taken_off(blocks, edges, trees, rates, range(len(trees)), len(trees), lean)


# Scoring


def tree_values(parts: Mapping[int, Tree], x: np.ndarray, cuts: tuple[int, ...]) -> np.ndarray:
    """Values of one tree for each row, whole and cut at each depth; 0 where the parts given do not hold the row's leaf.

    ``parts`` holds the tree as 0, or its top as -1 (-2 if another task counts the top's own leaves) and subtrees by node.
    """
    out = np.zeros((len(x), 1 + len(cuts)))
    top = parts.get(-1) or parts.get(-2)
    if top is None:
        leaf, at = parts[0].leaves(x, cuts)
        out[:, 0] = parts[0].cut[leaf]
        for i, a in enumerate(at):
            out[:, i + 1] = parts[0].value[a]
        return out
    leaf, at = top.leaves(x, cuts)
    below = [n for n in parts if n >= 0]
    own = top.child[leaf] == 0 if -1 in parts else np.zeros(len(x), bool)  # leaves of the top that no task finished
    out[own, 0] = top.cut[leaf[own]]
    for i, a in enumerate(at):
        out[own, i + 1] = top.value[a[own]]
    depths = top.depths() if below else None
    for node in below:
        here = np.flatnonzero(leaf == node)
        if not len(here):
            continue
        sub, base = parts[node], int(depths[node])
        end, inside = sub.leaves(x[here], tuple(max(c - base, 0) for c in cuts))
        out[here, 0] = sub.cut[end]
        for i, c in enumerate(cuts):
            out[here, i + 1] = top.value[at[i][here]] if c < base else sub.value[inside[i]]
    return out


def _scores(bodies: Sequence[tuple[int, int, int, bytes]], x: np.ndarray, fits: np.ndarray, cuts: tuple[int, ...]) -> np.ndarray:
    """For each row: the sum over its fit's trees, the sum of squares, and the sums cut at each depth."""
    trees: dict[tuple[int, int], dict[int, Tree]] = {}
    for fit, tree, node, body in bodies:
        trees.setdefault((fit, tree), {})[node] = Tree.unpacked(body)
    out = np.zeros((len(x), 2 + len(cuts)))
    for fit in {f for f, _ in trees}:
        here = np.flatnonzero(fits == fit)
        if not len(here):
            continue
        for (f, _), parts in trees.items():
            if f == fit:
                values = tree_values(parts, x[here], cuts)
                out[here, 0] += values[:, 0]
                out[here, 1] += np.square(values[:, 0])
                out[here, 2:] += values[:, 1:]
    return out


def part_sizes(trees: DataFrame, inner: bool) -> list[tuple[int, int, int, int]]:
    """``(fit, tree, node, bytes)`` of each part in order, by its number of nodes: no part is read for it."""
    found = trees.select("fit", "tree", "node", "nodes").collect()  # one row per part
    return sorted((r["fit"], r["tree"], r["node"], Tree.packed_bytes(r["nodes"], inner)) for r in found)


def grouped_parts(sizes: Sequence[tuple[int, int, int, int]], tops: Sequence[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """``(fit, tree, node, group)`` of each part: groups of about ``GROUP_BYTES`` of the parts that lie alike in their trees, from left to right.

    Trees of the same rows part them alike at first, so a row ends in parts of few groups rather than in one group for each few trees.
    """
    size_of = {part[:3]: part[3] for part in sizes if part[2] >= 0}
    lies = dict.fromkeys(size_of, 0.5)  # the share of its tree to the left of a part's middle
    for fit, tree, _, body in tops:
        top, order, below = Tree.unpacked(body), [], [0]
        while below:
            node = below.pop()
            if top.feature[node] >= 0:
                below += [int(top.child[node]) + 1, int(top.child[node])]
            elif (fit, tree, node) in size_of:
                order.append((fit, tree, node))
        ends = np.cumsum([0, *(size_of[part] for part in order)])
        lies.update(zip(order, ((ends[1:] + ends[:-1]) / (2 * ends[-1])).tolist()))
    out, total = [], 0
    for part in sorted(size_of, key=lambda p: (p[0], lies[p], p[1:])):
        out.append((*part, total // GROUP_BYTES))
        total += size_of[part]
    return out


def _on_all_cores(rows: DataFrame, key: str) -> DataFrame:
    """Rows that few files hold, dealt out by a key: each goes through the tops of all trees."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)


def score(df: DataFrame, features: Sequence[str], trees: DataFrame, fit: Column | None = None, cuts: Sequence[int] = ()) -> DataFrame:
    """The rows with ``__s0``, the sum of their fit's trees, ``__q``, the sum of squares, and ``__s1``... cut at each depth.

    A model of at most ``GROUP_BYTES`` is broadcast and scored in the scan. A larger one is cut into groups of
    that size, which meet the rows that end in them: a row goes through the tops of its trees where it is, then travels to the groups
    that hold its leaves, and a group is copied once for each ``BLOCK_ROWS`` rows of its own. A group holds parts of all trees that lie alike.
    """
    spark, cuts = df.sparkSession, tuple(cuts)
    names = ["__s0", "__q", *[f"__s{i + 1}" for i in range(len(cuts))]]
    fit = F.lit(0) if fit is None else fit
    sizes = part_sizes(trees, bool(cuts))
    values = [F.col(f).cast("double") for f in features]
    if sum(size for *_, size in sizes) <= GROUP_BYTES:
        held = spark.sparkContext.broadcast([tuple(r) for r in trees.select("fit", "tree", "node", "body").collect()])

        @F.pandas_udf(", ".join(f"{n} double" for n in names))
        def scored(fits: pd.Series, *x: pd.Series) -> pd.DataFrame:
            rows = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in x])
            return pd.DataFrame(_scores(held.value, rows, fits.to_numpy(), cuts), columns=names)

        found = df.withColumn("__found", scored(fit.cast("int"), *values))
        return found.select(*df.columns, *[F.col("__found").getField(n).alias(n) for n in names])
    tops = [tuple(r) for r in trees.where("node = -1").select("fit", "tree", "node", "body").collect()]  # a few numbers for each node that no task fits
    place = grouped_parts(sizes, tops)
    routes = _Routes(spark.sparkContext.broadcast((tops, place)))
    alone = len({s[:2] for s in sizes}) == len({s[0] for s in sizes})
    plain = all(isinstance(df.schema[f].dataType, NumericType) for f in features if f in df.columns) and set(features) <= set(df.columns)
    meet = _met_alone if alone and plain and not any(isinstance(f.dataType, (UserDefinedType, VariantType)) for f in df.schema) else _met_by_row
    return meet(df, list(features), values, trees, fit, routes, place, names, cuts)


@dataclass(frozen=True)
class _Routes:
    """Which groups of parts a row meets: it goes through the tops, which every task holds, and on to one part of each tree."""

    held: Any  # a broadcast: the tops, and the group of each part

    def groups(self, fits: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(group, rows)``: group -1 holds the leaves of the tops themselves."""
        tops, place = self.held.value
        of_tree: dict[tuple[int, int], dict[int, int]] = {}
        for fit, tree, node, group in place:
            of_tree.setdefault((fit, tree), {})[node] = group
        above = {(fit, tree): Tree.unpacked(body) for fit, tree, _, body in tops}
        met: dict[int, np.ndarray] = {}
        for fit in np.unique(fits).tolist():
            here = np.flatnonzero(fits == fit)
            for key in {k for k in (*of_tree, *above) if k[0] == fit}:
                parts, top = of_tree.get(key, {}), above.get(key)
                if top is None:
                    met.setdefault(parts[0], np.zeros(len(x), bool))[here] = True
                    continue
                group_of = np.full(len(top.feature), -1)
                group_of[list(parts)] = list(parts.values())
                found = group_of[top.leaves(x[here])[0]]
                for group in np.unique(found).tolist():
                    met.setdefault(group, np.zeros(len(x), bool))[here[found == group]] = True
        for group, rows in met.items():
            yield group, np.flatnonzero(rows)

    def message(self) -> bytes:
        """The tops, for the loops on the JVM."""
        tops = self.held.value[0]
        return struct.pack("<i", len(tops)) + b"".join(struct.pack("<ii", fit, tree) + _text(body) for fit, tree, _, body in tops)

    def bodies(self, parts: Sequence[tuple[int, int, int, bytes]], own: bool) -> list[tuple[int, int, int, bytes]]:
        """The parts of a group with the tops above them, or the tops alone for their own leaves."""
        tops = self.held.value[0]
        if own:
            return list(tops)
        wanted = {(fit, tree) for fit, tree, *_ in parts}
        return [*parts, *((fit, tree, -2, body) for fit, tree, _, body in tops if (fit, tree) in wanted)]


def _dealt_parts(trees: DataFrame, place: list[tuple], blocks: Mapping[int, int]) -> DataFrame:
    """Each part as often as there are blocks of rows for its group."""
    rows = [(*p, blocks[p[3]]) for p in place if p[3] in blocks]  # one row per part
    places = F.broadcast(small_frame(trees.sparkSession, rows, "fit int, tree int, node int, __group int, blocks int"))
    given = trees.select("fit", "tree", "node", "body").join(places, ["fit", "tree", "node"])
    return given.select("fit", "tree", "node", "body", "__group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("__block"))


def _parts(table: pa.Table) -> list[tuple[int, int, int, bytes]]:
    return list(zip(*(table.column(c).to_pylist() for c in ("fit", "tree", "node", "body"))))


def _met_alone(df, features, values, trees, fit, routes: _Routes, place, names, cuts) -> DataFrame:
    """Models of one tree each: a row meets one group, so it goes there with all its columns and comes back scored."""
    @F.pandas_udf("int")
    def group_of(fits: pd.Series, *x: pd.Series) -> pd.Series:
        out = np.full(len(fits), -1, np.int32)
        for group, rows in routes.groups(fits.to_numpy(), np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in x])):
            out[rows] = group
        return pd.Series(out)

    asking = df.withColumn("__fit", fit.cast("int")).where(F.col("__fit").isNotNull())
    asking = asking.withColumn("__group", group_of("__fit", *values))
    counts = asking.groupBy("__group").count().collect()  # one row per group
    blocks = {r["__group"]: 1 + r["count"] // BLOCK_ROWS for r in counts}
    if not blocks:
        return df.select("*", *[F.lit(None).cast("double").alias(n) for n in names])
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(F.array(*[F.lit(blocks.get(g, 1)) for g in range(-1, max(blocks) + 1)]), F.col("__group") + 1))
    asking = asking.withColumn("__block", block.cast("int"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = left.drop_columns(["__fit", "__group", "__block"])
        x = [left.column(f).cast(pa.float64(), safe=False).to_numpy() for f in features]
        own = bool(len(left)) and left.column("__group")[0].as_py() == -1
        found = _scores(routes.bodies(_parts(right), own), np.column_stack(x), left.column("__fit").to_numpy(), cuts)
        for i, n in enumerate(names):
            kept = kept.append_column(n, pa.array(found[:, i]))
        return kept

    scored = StructType([*df.schema.fields, *[StructField(n, DoubleType()) for n in names]])
    parts = _dealt_parts(trees, place, blocks)
    tasks = max(sum(blocks.values()), asking.sparkSession.sparkContext.defaultParallelism)
    met = asking.repartition(tasks, "__group", "__block").groupBy("__group", "__block")
    return met.cogroup(parts.repartition(tasks, "__group", "__block").groupBy("__group", "__block")).applyInArrow(meet, scored)


def _met_by_row(df, features, values, trees, fit, routes: _Routes, place, names, cuts) -> DataFrame:
    """Forests: a row meets several groups, and what they give is added up."""
    spark, d = df.sparkSession, len(values)
    path = scratch_path(spark, "scored-rows")  # written: the row numbers must not change between two reads
    df.withColumn("__row", F.monotonically_increasing_id()).withColumn("__fit", fit.cast("int")).write.parquet(path)
    rows = spark.read.parquet(path)
    flat = rows.where(F.col("__fit").isNotNull()).select("__row", "__fit", *[v.alias(f"v{i}") for i, v in enumerate(values)])
    flat = _on_all_cores(flat, "__row")

    def opened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = [batch.column(f"v{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(d)]
        return batch.column("__row").to_numpy(), batch.column("__fit").to_numpy(), np.column_stack(x)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            _, fits, x = opened(batch)
            for group, here in routes.groups(fits, x):
                total[group] = total.get(group, 0) + len(here)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["g", "n"])

    counts = flat.mapInArrow(counted, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()  # one row per group
    blocks = {r["g"]: 1 + r["n"] // BLOCK_ROWS for r in counts}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fits, x = opened(batch)
            out = []
            for group, here in routes.groups(fits, x):
                block = int(int(ids[here[0]]) * 0x9E3779B1 % 2**32 * blocks[group] >> 32)
                out.append({"__group": group, "__block": block, "ids": ids[here].tobytes(), "fits": fits[here].astype(np.int32).tobytes(), "x": x[here].tobytes()})
            yield pa.RecordBatch.from_pylist(out, VISIT_SCHEMA)

    schema = pa.schema([("__of", pa.int64()), *[(n, pa.float64()) for n in names]])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(left.column(c).to_pylist()), kind)
        own = bool(len(left)) and left.column("__group")[0].as_py() == -1
        found = _scores(routes.bodies(_parts(right), own), joined("x", np.float64).reshape(-1, d), joined("fits", np.int32), cuts)
        return pa.table([pa.array(joined("ids", np.int64)), *[pa.array(found[:, i]) for i in range(len(names))]], schema)

    asking = flat.mapInArrow(sent, "__group int, __block int, ids binary, fits binary, x binary")
    tasks = max(sum(blocks.values()), spark.sparkContext.defaultParallelism)
    parts = _dealt_parts(trees, place, blocks)
    if not cuts:  # a part is held while the rows go past it
        empty = [F.lit(None).cast("binary").alias(c) for c in ("ids", "fits", "x")]
        given = parts.select("__group", "__block", F.lit(0).alias("kind"), "fit", "tree", "node", "body", *empty)
        none = [F.lit(-1).alias(c) for c in ("fit", "tree", "node")]
        visits = asking.select("__group", "__block", F.lit(1).alias("kind"), *none, F.lit(None).cast("binary").alias("body"), "ids", "fits", "x")
        both = given.union(visits).repartition(tasks, "__group", "__block").sortWithinPartitions("__group", "__block", "kind")
        met = over_partitions(both, "Meet", "__of long, " + ", ".join(f"{n} double" for n in names), routes.message())
        sums = met.groupBy("__of").agg(*[F.sum(n).alias(n) for n in names])
        return rows.join(sums, F.col("__row") == F.col("__of")).select(*df.columns, *names)
    parts = parts.repartition(tasks, "__group", "__block")
    met = asking.repartition(tasks, "__group", "__block").groupBy("__group", "__block").cogroup(parts.groupBy("__group", "__block"))
    met = met.applyInArrow(meet, "__of long, " + ", ".join(f"{n} double" for n in names))
    sums = met.groupBy("__of").agg(*[F.sum(n).alias(n) for n in names])
    return rows.join(sums, F.col("__row") == F.col("__of")).select(*df.columns, *names)


@dataclass(frozen=True)
class TreeModel:
    """A fitted tree, forest or boosted model: a table of packed trees, and how their values add up."""

    kind: str  # tree, forest or boosted
    table: DataFrame
    features: list[str]
    n_trees: int
    offset: float
    scale: float
    max_depth: int | None
    nodes: int
    depth: int
    importances: list[float]

    def scored(self, df: DataFrame) -> DataFrame:
        return score(df, self.features, self.table).withColumn(PREDICTION, F.lit(self.offset) + F.lit(self.scale) * F.col("__s0"))

    def getMaxDepth(self) -> int:  # noqa: N802 - named as in Spark's own tree models
        """The depth asked for; the deepest of Spark's own trees stands for no limit."""
        return UNLIMITED if self.max_depth is None else self.max_depth

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return self.n_trees

    @property
    def trees(self) -> list["TreeModel"]:
        """Each tree of a forest as a model of its own."""
        alone = {"kind": "tree", "n_trees": 1, "scale": 1.0}
        return [dataclasses.replace(self, table=self.table.where(F.col("tree") == t), **alone) for t in range(self.n_trees)]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scored(df).drop("__s0", "__q")

    def with_spread(self, df: DataFrame) -> DataFrame:
        """The prediction and ``prediction_std``, the deviation of the trees' values."""
        n = float(self.n_trees)
        variance = F.col("__q") / n - F.pow(F.col("__s0") / n, F.lit(2.0))
        return self.scored(df).withColumn("prediction_std", F.sqrt(F.greatest(F.lit(0.0), variance))).drop("__s0", "__q")

    def settings(self) -> dict[str, Any]:
        return {f.name: getattr(self, f.name) for f in dataclasses.fields(self) if f.name != "table"}

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/trees")
        spark = self.table.sparkSession
        small_frame(spark, [(json.dumps(self.settings()),)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeModel":
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()[0])
        return cls(table=spark.read.parquet(f"{path}/trees"), **settings)


def _tried(rule: str | None, d: int) -> int | None:
    return {"sqrt": max(1, int(d**0.5)), "log2": max(1, int(np.log2(max(d, 1))))}.get(rule or "all")


def growth(params: Mapping[str, Any], d: int, penalty: tuple[float, float] = (0.0, 0.0)) -> Growth:
    depth = params.get("max_depth")
    if depth is not None and depth < 0:
        raise ValueError("max_depth must be None or at least 0")
    return Growth(depth, params.get("min_samples_leaf", 1), params.get("min_samples_split", 2), _tried(params.get("max_features"), d), penalty)


@dataclass(frozen=True)
class TreeEstimator:
    """Grows the trees of one or several models of the same rows together."""

    kind: str
    params: Mapping[str, Any]
    features: Sequence[str]
    label: str
    ids: Sequence[str] = ()
    seed: int = 42

    def _grown(self, rows: Rows, folds: Sequence[int], inner: bool = False, first_fit: int = 0) -> DataFrame:
        return grow_models(rows, [(self.kind, self.params, self.seed, first_fit + i, f, inner) for i, f in enumerate(folds)])

    @property
    def n_trees(self) -> int:
        return 1 if self.kind == "tree" else self.params["n_estimators"]

    @property
    def scale(self) -> float:
        return self.params["learning_rate"] if self.kind == "boosted" else 1.0 / self.n_trees

    def fit(self, df: DataFrame) -> TreeModel:
        rows = packed_rows(df, self.features, self.label, self.ids)
        try:
            table = self._grown(rows, [-1])
        finally:
            rows.blocks.unpersist()
        return TreeModel(self.kind, table, list(self.features), self.n_trees, rows.center, self.scale, self.params.get("max_depth"), *summary(table, len(rows.features), self.kind))

    def fold_rmse(self, df: DataFrame, fold: str, folds: int) -> list[float]:
        """The error on each fold of the model of all others: the trees of all folds grow together."""
        return fold_errors(df, self.features, self.label, self.ids, fold, folds, [(self.kind, self.params, self.scale, ())], self.seed)[0][0]


def grow_models(rows: Rows, models: Sequence[tuple[str, Mapping, int, int, int, bool]]) -> DataFrame:
    """The trees of models ``(kind, params, seed, fit, held-out fold, inner values)`` of one kind, tree or boosted."""
    d, specs, boosts = len(rows.features), [], []
    for kind, params, seed, fit, held_out, inner in models:
        if kind == "boosted":
            how = growth(params, d, (params.get("reg_alpha", 0.0), params.get("reg_lambda", 0.0)))
            if how.max_depth is None:
                raise ValueError("boosted trees need a max_depth")
            boosts.append(Boost(fit, params["n_estimators"], params["learning_rate"], how, seed, held_out, params.get("subsample", 1.0), params.get("colsample", 1.0)))
            continue
        trees = 1 if kind == "tree" else params["n_estimators"]
        specs += [Spec(fit, t, seed, growth(params, d), held_out, bootstrap=kind == "forest", inner=inner) for t in range(trees)]
    return boost_trees(rows, boosts) if boosts else grow_trees(rows, specs)


def fold_errors(df, features, label, ids, fold: str, folds: int, models: Sequence[tuple[str, Mapping, float, tuple[int, ...]]], seed: int) -> list[list[list[float]]]:
    """For each model ``(kind, params, scale, depth cuts)``: the RMSE on each fold, whole and cut at each depth.

    All models and folds grow from one cached table; a tree cut at a depth is the tree grown to that depth.
    """
    rows = packed_rows(df, features, label, ids, fold)
    cuts = models[0][3]
    try:
        plans = [(kind, params, seed, m * folds + f, f, bool(c)) for m, (kind, params, _, c) in enumerate(models) for f in range(folds)]
        table = grow_models(rows, plans)
    finally:
        rows.blocks.unpersist()
    names = [*features, label]
    held = df.dropna(subset=names).select(*features, F.col(label).cast("double").alias("__y"), F.col(fold).cast("int").alias("__fold"))
    held = held.withColumn("__model", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))))
    found = score(held, features, table, F.col("__model") * folds + F.col("__fold"), cuts)
    scale = F.get(F.array(*[F.lit(float(s)) for _, _, s, _ in models]), F.col("__model"))
    off = [F.col("__y") - F.lit(rows.center) - scale * F.col(f"__s{i}") for i in range(1 + len(cuts))]
    sums = found.groupBy("__model", "__fold").agg(*[F.sqrt(F.avg(e * e)).alias(f"e{i}") for i, e in enumerate(off)]).collect()  # models times folds
    require_folds({r["__fold"] for r in sums}, folds)
    errors = {(r["__model"], r["__fold"]): [r[f"e{i}"] for i in range(1 + len(cuts))] for r in sums}
    return [[[errors[m, f][i] for f in range(folds)] for i in range(1 + len(cuts))] for m in range(len(models))]


def summary(table: DataFrame, d: int, kind: str) -> tuple[int, int, list[float]]:
    """Nodes, depth and the importance of each feature (of a forest: the mean of its trees' shares of gain)."""
    gain = [F.sum(F.get("gains", F.lit(i))).alias(f"g{i}") for i in range(d)]
    tops = F.count_if(F.col("node") > 0)  # a subtree's root is its top's leaf
    by_tree = table.where("tree >= 0").groupBy("tree").agg((F.sum("nodes") - tops).alias("nodes"), F.max("depth").alias("depth"), *gain)
    whole = sum((F.col(f"g{i}") for i in range(d)), F.lit(0.0))
    part = lambda i: F.col(f"g{i}") if kind == "boosted" else F.when(whole > 0, F.col(f"g{i}") / whole).otherwise(0.0)
    row = by_tree.agg(F.sum("nodes").alias("nodes"), F.max("depth").alias("depth"), *[F.sum(part(i)).alias(f"p{i}") for i in range(d)]).first()
    shares = [row[f"p{i}"] or 0.0 for i in range(d)]
    return row["nodes"], row["depth"], [s / (sum(shares) or 1.0) for s in shares]
