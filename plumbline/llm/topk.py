"""Exact inner-product search with ball trees.

Vectors are cut by space into cells, by hyperplanes fitted to a bounded sample, and each cell into shards of bounded
size. A task builds the ball tree of a shard once; the trees are kept as rows. A query knows an upper bound for
every cell and visits shards in waves, from the best bound on; the k-th score found so far goes along, and shards
whose bound does not reach it are not visited. Within a shard a query visits nodes by their upper bound, best
first, and ends when no bound reaches its k-th best score.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import settle
from plumbline.session import small_frame

#: Vectors in a shard, the numbers they may hold together (the memory of a task), and vectors in a leaf.
SHARD_ROWS, SHARD_VALUES, LEAF_ROWS = 2048, 1 << 20, 128
#: Cells at most, the numbers that their cuts may hold, and sampled vectors for each cell.
CELLS, CUT_VALUES, SAMPLED = 1024, 1 << 20, 16
#: Shards that a query has visited after each wave but the last, which visits all that are left.
WAVES = (1, 9)
#: Tasks of a wave at most; beyond them a task takes several shards, one after the other.
TASKS = 10_000
FOUND = "query_id long, vec_id long, score long"


def whole(vecs: list[list[float]]) -> np.ndarray:
    return np.floor(256.0 * np.asarray(vecs, dtype=np.float64))


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(rows).sum(axis=-1))


def bounds(centres: np.ndarray, radii: np.ndarray, longest: float | np.ndarray, query: np.ndarray, length: float) -> np.ndarray:
    """No inner product of the query with a vector of a ball is above the ball's bound; beyond doubles it is infinite."""
    slack = 1e-9 * (longest * length + length) + 1e-6  # what rounding can take from a bound
    top = centres @ query + radii * length + slack
    return np.where(np.isfinite(top), top, np.inf)


class BallTree:
    """Integer vectors of one length, with their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows, self.nodes = ids, rows, []
        with np.errstate(over="ignore", invalid="ignore"):
            self.longest = float(lengths(rows).max(initial=0))
            balls: list[tuple[np.ndarray, float]] = []
            self._grow(np.arange(len(ids)), balls)
            self.centres, self.radii = np.array([c for c, _ in balls]), np.array([r for _, r in balls])

    def stored(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def loaded(cls, stored: bytes) -> BallTree:
        tree = cls.__new__(cls)
        vars(tree).update(pickle.loads(stored))
        return tree

    def _grow(self, at: np.ndarray, balls: list[tuple[np.ndarray, float]]) -> int:
        rows = self.rows[at]
        centre = rows.mean(axis=0)
        away = lengths(rows - centre)
        me, radius = len(self.nodes), float(away.max())
        balls.append((centre, radius))
        self.nodes.append((at, None))
        if len(at) > LEAF_ROWS and 0 < radius < np.inf:
            order = np.argsort(rows @ between_far_ones(rows, away), kind="stable")
            self.nodes[me] = (None, tuple(self._grow(at[half], balls) for half in np.array_split(order, 2)))
        return me

    def _scores(self, at: np.ndarray, query: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products: in doubles or 64 bits where norms show that they fit, else in Python's whole numbers."""
        most = self.longest * length
        if most < 2.0**52:
            return (self.rows[at] @ query).astype(np.int64)
        if most < 2.0**62 and max(self.longest, length) < 2.0**62:
            return self.rows[at].astype(np.int64) @ query.astype(np.int64)
        asked = [int(x) for x in query]
        scores = [sum(int(a) * b for a, b in zip(row, asked)) for row in self.rows[at].tolist()]
        if any(not -(2**63) <= s < 2**63 for s in scores):
            raise OverflowError("a score does not fit 64 bits")
        return np.array(scores, np.int64)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """``(score, id)`` of the k best, ties to smaller ids, that reach ``floor``; never the row's own id."""
        with np.errstate(over="ignore", invalid="ignore"):
            return self._search(own, query, k, floor)

    def _search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        length = float(lengths(query))
        tops = bounds(self.centres, self.radii, self.longest, query, length).tolist()
        best: list[tuple[int, int]] = []
        queue = [(-tops[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            least = best[0][0] if len(best) == k else floor
            if least is not None and -top < least:
                break
            at, parts = self.nodes[node]
            if parts:
                for part in parts:
                    heapq.heappush(queue, (-tops[part], part))
                continue
            scores = self._scores(at, query, length)
            for i in np.flatnonzero(scores >= least) if least is not None else range(len(at)):
                entry = (int(scores[i]), -int(self.ids[at[i]]))
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in best]


def between_far_ones(rows: np.ndarray, away: np.ndarray) -> np.ndarray:
    """The row furthest from the centre, less the row furthest from that one: the way along which the rows spread."""
    one = rows[int(away.argmax())]
    return one - rows[int(np.square(rows - one).sum(axis=1).argmax())]


class Cuts:
    """Hyperplanes that cut the vectors of one length into cells, and a centre for each cell."""

    def __init__(self, rows: np.ndarray, cells: int):
        self.planes: list[tuple[np.ndarray, float, int, int] | int] = []
        self.centres: list[np.ndarray] = []
        with np.errstate(over="ignore", invalid="ignore"):
            self._cut(rows, cells)

    def _cut(self, rows: np.ndarray, cells: int) -> int:
        me, centre = len(self.planes), rows.mean(axis=0)
        self.planes.append(len(self.centres))
        away = lengths(rows - centre)
        if cells > 1 and len(rows) > 1 and 0 < away.max() < np.inf:
            normal = between_far_ones(rows, away)
            side = rows @ normal
            middle = float(np.median(side))
            least = float(side[side > middle].min()) if (side > middle).any() else middle
            right = side >= least
            if right.any() and not right.all() and math.isfinite(least):
                parts = self._cut(rows[~right], cells // 2), self._cut(rows[right], cells - cells // 2)
                self.planes[me] = (normal, least, *parts)
                return me
        self.centres.append(centre)
        return me

    def cells(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            waiting = [(0, np.arange(len(rows)))]
            while waiting:
                node, at = waiting.pop()
                plane = self.planes[node]
                if isinstance(plane, int):
                    out[at] = plane
                    continue
                right = rows[at] @ plane[0] >= plane[1]
                waiting += [(plane[2], at[~right]), (plane[3], at[right])]
        return out


def by_length(vecs: list[list[float]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: where its vectors are, and the vectors in whole numbers."""
    sizes = np.array([len(v) for v in vecs])
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield d, at, whole([vecs[i] for i in at]).reshape(len(at), d)


def placed(cuts: dict[int, Cuts]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``d, cell, away`` (distance to the cell's centre) to ``id, vec``. A length without cuts is one cell around zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, cell, away = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for size, at, rows in by_length(batch.column("vec").to_pylist()):
                d[at] = size
                centre = 0.0
                if size in cuts:
                    cell[at] = cuts[size].cells(rows)
                    centre = np.array(cuts[size].centres)[cell[at]]
                with np.errstate(over="ignore", invalid="ignore"):
                    far = lengths(rows - centre)
                away[at] = np.where(np.isfinite(far), far, np.inf)
            columns = [batch.column("id"), batch.column("vec"), pa.array(d), pa.array(cell), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vec", "d", "cell", "away"])

    return run


def trees(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over ``shard, id, vec`` sorted by shard: the ball tree of each shard. More than ``k`` equal rows of one id are one too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []

        def built() -> pa.RecordBatch:
            tree = BallTree(np.array([i for i, _ in rows], np.int64), np.array([v for _, v in rows]))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([tree.stored()], pa.binary())], names=["shard", "tree"])

        seen: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            for s, i, vec in zip(*(batch.column(c).to_pylist() for c in ("shard", "id", "vec"))):
                if s != shard:
                    if rows:
                        yield built()
                    shard, rows, seen = s, [], {}
                row = whole(vec)
                same = i, row.tobytes()
                seen[same] = seen.get(same, 0) + 1
                if seen[same] <= k:
                    rows.append((i, row))
        if rows:
            yield built()

    return run


Balls = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def visits(balls: Balls, since: int, until: int | None):
    """Over ``id, vec, floor``: a row for each shard of a wave (by bound, from number ``since``) that reaches the floor.

    ``balls``: by length, the centres and radii of cells, the first shard of each and how many it has. The shards of a
    cell begin with one by the query's id, so that queries of one cell spread over them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, floors = (batch.column(c).to_pylist() for c in ("id", "vec", "floor"))
            for n, (i, vec, floor) in enumerate(zip(ids, vecs, floors)):
                if len(vec) not in balls:
                    continue
                centres, radii, starts, parts = balls[len(vec)]
                query = whole(vec)
                with np.errstate(over="ignore", invalid="ignore"):
                    tops = bounds(centres, radii, lengths(centres) + radii, query, float(lengths(query)))
                order = np.argsort(-tops, kind="stable")
                before = np.cumsum(parts[order]) - parts[order]  # shards of better cells
                shards = []
                for cell, first in zip(order.tolist(), before.tolist()):
                    if (until is not None and first >= until) or (floor is not None and tops[cell] < floor):
                        break
                    count = int(parts[cell])
                    numbers = np.arange(max(0, since - first), count if until is None else min(count, until - first))
                    shards.append(starts[cell] + (numbers + i) % count)
                taken = np.concatenate(shards) if shards else np.empty(0, np.int64)
                for at in range(0, len(taken), 10_000):
                    part = taken[at : at + 10_000]
                    same = pa.array(np.full(len(part), n))
                    columns = [pa.array(part), *(batch.column(c).take(same) for c in ("id", "floor", "vec"))]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "id", "floor", "vec"])

    return run


def shard_search(k: int):
    """Over rows ``shard, tree, id, floor, vec`` sorted by shard, trees before queries: each query's best in its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            shards, stored, ids, floors, vecs = (batch.column(c) for c in ("shard", "tree", "id", "floor", "vec"))
            for s, found, i, floor, vec in zip(shards.to_pylist(), stored, ids.to_pylist(), floors.to_pylist(), vecs.to_pylist()):
                if found.is_valid:
                    shard, tree = s, BallTree.loaded(found.as_py())
                elif s == shard:
                    out += [(i, j, score) for score, j in tree.search(i, whole(vec), k, floor)]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fitted_cuts(rows: DataFrame, n_rows: int, longest: int, shard_rows: int) -> dict[int, Cuts]:
    """Cuts by length, from at most ``SAMPLED * CELLS`` vectors (fewer, if they are long), drawn by their hashes.

    The draw leaves about twice that many before they are cut to size, however many partitions there are.
    """
    cells = max(1, min(CELLS, n_rows // shard_rows, CUT_VALUES // max(1, longest)))
    if cells == 1:
        return {}
    wanted = SAMPLED * cells
    drawn = rows.where(F.pmod(F.xxhash64("vec", "id"), F.lit(max(1, n_rows // (2 * wanted)))) == 0)
    some = drawn.orderBy(F.xxhash64("id", "vec"), "id").limit(wanted).select("vec").toArrow().column("vec").to_pylist()
    if not some:
        return {}
    return {d: Cuts(sample, max(1, cells * len(at) // len(some))) for d, at, sample in by_length(some) if d}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query, by integer inner product.

    A component x counts as floor(256 x). Every row but those of the query's own id is a candidate; ties go to the
    smaller id. Rows without an id, and vectors that are null or hold null or non-finite components, take no part;
    components may be of any size, and a score that does not fit 64 bits is an error. Only vectors of the same length are compared. A repeated id is one query
    (its smallest vector) and as many candidates as it has rows. Fewer than ``k`` candidates are all returned.

    Of equal vectors only those of the ``k + 1`` smallest ids can be among the best, so others are left out before
    they are dealt. The driver holds one centre for each cell (at most ``CELLS``, ``CUT_VALUES`` numbers).
    """
    spark = vectors.sparkSession
    ok: Column = F.col("id").isNotNull() & F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(ok)
    asked = settle(clean(queries).groupBy("id").agg(F.min("vec").alias("vec")))
    copy = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    rows = settle(clean(vectors).withColumn("copy", copy).where(F.col("copy") <= k + 1).select("id", "vec"))
    n_rows, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    cuts = fitted_cuts(rows, n_rows, longest, shard_rows)
    rows = settle(rows.mapInArrow(placed(cuts), "id long, vec array<double>, d long, cell long, away double"))
    sizes = rows.groupBy("d", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).orderBy("d", "cell").collect()  # a row for each cell
    starts, balls, n_shards = [], {}, 0
    for d in sorted({s["d"] for s in sizes}):
        mine = [s for s in sizes if s["d"] == d]
        centres = np.array([cuts[d].centres[s["cell"]] if d in cuts else np.zeros(d) for s in mine]).reshape(len(mine), d)
        parts = np.array([-(-s["n"] // max(1, min(shard_rows, SHARD_VALUES // max(1, d)))) for s in mine])
        first = n_shards + np.cumsum(parts) - parts
        balls[d] = centres, np.array([s["radius"] for s in mine]), first, parts
        starts += [(d, s["cell"], int(f), int(p)) for s, f, p in zip(mine, first, parts)]
        n_shards += int(parts.sum())
    tasks = max(1, min(n_shards, TASKS))
    dealt = rows.join(F.broadcast(small_frame(spark, starts, "d long, cell long, first long, parts long")), ["d", "cell"])
    dealt = dealt.select((F.col("first") + F.pmod(F.xxhash64("id", "vec"), "parts")).alias("shard"), "id", "vec")
    grown = settle(dealt.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(trees(k), "shard long, tree binary"))
    nothing = lambda kind: F.lit(None).cast(kind)
    best = None
    for since, until in zip((0, *WAVES), (*WAVES, None)):
        floors = asked.withColumn("floor", nothing("long"))
        if best is not None:
            kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
            floors = asked.join(kth, F.col("id") == F.col("query_id"), "left").select("id", "vec", "floor")
        asking = floors.mapInArrow(visits(balls, since, until), "shard long, id long, floor long, vec array<double>")
        asking = asking.select("shard", nothing("binary").alias("tree"), "id", "floor", "vec")
        stored = grown.select("shard", "tree", nothing("long").alias("id"), nothing("long").alias("floor"), nothing("array<double>").alias("vec"))
        together = stored.unionByName(asking).repartition(tasks, "shard").sortWithinPartitions("shard", F.desc_nulls_last(F.length("tree")))
        found = together.mapInArrow(shard_search(k), FOUND)
        found = found if best is None else found.unionByName(best.select("query_id", "vec_id", "score"))
        best = settle(best_of(found, k))
    return best.select("query_id", "rank", "vec_id", "score")
