"""Near copies among vectors of one label, by a forest of random-projection trees.

A node of a tree is cut across a random direction; what lies within a margin of the cut goes to both sides. Cuts are
fitted to a bounded sample of each large node and all its rows follow them; nodes that are still
large are sampled again. Rows are compared within leaves only. A pair that meets in several leaves counts in the
first one they share, so links are counted, never listed: a leaf returns a number and one tie for each of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import named, ready_side, settle
from plumbline.llm.components import components

#: Trees of the forest, and rows of a leaf (a label or node of no more rows is one leaf).
TREES, LEAF_ROWS = 6, 2048
#: Rows that the cuts of a node are fitted to (a sample by hash of about so many), and the fewest in a part of it.
SAMPLE_ROWS, LEAST_SAMPLE = 16_384, 64
#: Rows that one copy of a node's cuts serves.
SERVED_ROWS = 50_000
#: A cut is taken if the larger side has at most so much of its node and both sides together so much, after so many tries.
LARGEST_SIDE, BOTH_SIDES, TRIES = 0.75, 1.35, 8
#: Half the width of what goes to both sides, in deviations of the difference of two vectors that just link.
MARGIN = 0.64
BROADCAST_ROWS = 500_000


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no finite row overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def unpacked(packed: pa.Array, single: bool) -> np.ndarray:
    """Vectors of one length from their bytes, as rows of doubles."""
    kind = np.float32 if single else np.float64
    return np.frombuffer(b"".join(packed.to_pylist()), kind).astype(np.float64).reshape(len(packed), -1)


def packed_vectors(single: bool):
    """Over ``row, vec``: the bytes of each vector, its length and a hash of 128 bits; none if it cannot link."""
    kind = pa.float32() if single else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for v in batch.column("vec"):
                whole = None if v.values is None or not len(v.values) or v.values.null_count else v.values.cast(kind).to_numpy(zero_copy_only=False)
                if whole is None or not np.isfinite(whole).all() or not whole.any():
                    found.append((None, None, None, None))
                    continue
                raw = (whole + 0).tobytes()  # zero has one sign
                h, g = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64)
                found.append((raw, len(whole), int(h), int(g)))
            kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *columns], names=["id", "label", "vec", "size", "h", "g"])

    return run


def link_angle_width(least: float, size: int) -> float:
    """The deviation of a random projection of the difference of two unit vectors whose cosine is ``least``."""
    return math.sqrt(2 * (1 - least) / size)


class Tree:
    """Cuts of one tree below a node: directions come from a seed, so only the cuts travel."""

    def __init__(self, seed: int, cuts: list[tuple[int, float, int, int]]):
        self.seed, self.cuts = seed, cuts  # (direction, cut, left, right); a negative child is a leaf

    @staticmethod
    def direction(seed: int, number: int, size: int) -> np.ndarray:
        drawn = np.random.default_rng([seed, number]).normal(size=size)
        return drawn / np.sqrt(drawn @ drawn)

    @classmethod
    def fit(cls, seed: int, sample: np.ndarray, margin: float, least: int) -> "Tree":
        tree, drawn = cls(seed, []), 0
        leaves = 0

        def grow(rows: np.ndarray) -> int:
            nonlocal drawn, leaves
            for _ in range(TRIES if len(rows) >= 2 * least else 0):
                number, drawn = drawn, drawn + 1
                across = rows @ cls.direction(seed, number, rows.shape[1])
                cut = float(np.median(across))
                left, right = across <= cut + margin, across > cut - margin
                if max(left.sum(), right.sum()) <= LARGEST_SIDE * len(rows) and left.sum() + right.sum() <= BOTH_SIDES * len(rows):
                    me = len(tree.cuts)
                    tree.cuts.append((0, 0.0, 0, 0))
                    tree.cuts[me] = (number, cut, grow(rows[left]), grow(rows[right]))
                    return me
            leaves += 1
            return -leaves

        grow(sample)
        return tree

    def route(self, rows: np.ndarray, margin: float) -> Iterator[tuple[int, np.ndarray]]:
        """``(leaf, rows in it)`` of all leaves; a row near a cut is in several."""
        waiting = [(0 if self.cuts else -1, np.arange(len(rows)))]
        while waiting:
            node, at = waiting.pop()
            if node < 0:
                yield -node, at
            elif len(at):
                number, cut, left, right = self.cuts[node]
                across = rows[at] @ self.direction(self.seed, number, rows.shape[1])
                waiting += [(left, at[across <= cut + margin]), (right, at[across > cut - margin])]


def fitted_cuts(least: float, leaf_rows: int, single: bool):
    """For the sample of one node, one row: its trees as bytes (the first round fits all of them, later ones the tree of the node)."""

    def run(sample: pa.Table) -> pa.Table:
        code, tree, n = (sample.column(c)[0].as_py() for c in ("code", "tree", "n"))
        rows = unit_rows(unpacked(sample.column("vec"), single))
        rows = rows[np.lexsort(rows.T)]  # whatever order they came in
        margin = MARGIN * link_angle_width(least, rows.shape[1])
        small = max(LEAST_SAMPLE, leaf_rows * len(rows) // (2 * n))
        trees = [tree] if tree >= 0 else range(TREES)
        cuts = [Tree.fit((code & (2**63 - 1)) + t, rows, margin, small).cuts for t in trees]
        flat = [np.array(c, np.float64).reshape(-1, 4).tobytes() for c in cuts]
        return pa.table({"code": pa.array([code], pa.int64()), "trees": pa.array([list(trees)], pa.list_(pa.int32())), "cuts": pa.array([flat], pa.list_(pa.binary()))})

    return run


def routed(least: float, single: bool):
    """Over rows of one node and one salt after the cuts of the node: ``cid, tree, code, parent`` for each leaf a row falls in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, trees = None, []
        for batch in batches:
            codes, cids = batch.column("code").to_pylist(), batch.column("cid").to_pylist()
            salts = batch.column("salt").to_pylist()
            start = 0
            for stop in range(1, len(codes) + 1):
                if stop < len(codes) and (codes[stop], salts[stop]) == (codes[start], salts[start]) and cids[start] is not None:
                    continue
                part = batch.slice(start, stop - start)
                if cids[start] is None:  # the cuts come first
                    key = codes[start], salts[start]
                    seed = codes[start] & (2**63 - 1)
                    found = zip(part.column("trees")[0].as_py(), part.column("cuts")[0].as_py())
                    trees = [(t, Tree(seed + t, [(int(d), c, int(a), int(b)) for d, c, a, b in np.frombuffer(raw).reshape(-1, 4).tolist()])) for t, raw in found]
                else:
                    assert key == (codes[start], salts[start]), "rows of a node without its cuts"
                    rows = unit_rows(unpacked(part.column("vec"), single))
                    margin = MARGIN * link_angle_width(least, rows.shape[1])
                    ids, parent = np.array(cids[start:stop]), codes[start]
                    for t, tree in trees:
                        for leaf, at in tree.route(rows, margin):
                            if len(at):
                                code = np.int64(xxhash.xxh3_64_intdigest(f"{parent}/{t}/{leaf}") - 2**63)
                                same = [pa.array(np.full(len(at), x, k)) for x, k in ((t, np.int32), (code, np.int64), (parent, np.int64))]
                                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), *same], names=["cid", "tree", "code", "parent"])
                start = stop

    return run


def block_links(least: float, single: bool):
    """For the rows of two chunks of a leaf (or of one): ``cid``, links that this leaf counts, and a row it is tied to."""

    def exact(one: np.ndarray, two: np.ndarray) -> bool:
        one, two = one / np.abs(one).max(), two / np.abs(two).max()
        dot, left, right = (math.fsum((a * b).tolist()) for a, b in ((one, two), (one, one), (two, two)))
        return dot / math.sqrt(left * right) >= least

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        code, i, j = (table.column(c)[0].as_py() for c in ("code", "i", "j"))
        chunk, mult = table.column("chunk").to_numpy(), table.column("mult").to_numpy()
        raw = unpacked(table.column("vec"), single)
        rows, n = unit_rows(raw), len(raw)
        earlier = [[c for c in codes if c < code] for codes in table.column("codes").to_pylist()]
        width = max(map(len, earlier), default=0)
        held = np.array([c + [None] * (width - len(c)) for c in earlier], dtype=object).reshape(n, width)
        known = {c: k for k, c in enumerate({c for codes in earlier for c in codes})}
        held = np.array([[known.get(c, -1) for c in codes] for codes in held], np.int64).reshape(n, width)
        close, links = np.zeros((n, n), bool), np.zeros(n, np.int64)
        for start in range(0, n, 512):
            stop = min(n, start + 512)
            cosines = rows[start:stop] @ rows.T
            near = cosines >= least
            for a, b in zip(*np.nonzero(np.abs(cosines - least) < 1e-9)):
                near[a, b] = exact(raw[start + a], raw[b])
            near[np.arange(stop - start), np.arange(start, stop)] = False
            if i != j:
                near &= chunk[start:stop, None] != chunk[None, :]
            close[start:stop] = near
            a, b = np.nonzero(near)
            met = np.zeros(len(a), bool)
            for k in range(width):
                mine = held[start + a, k]
                for m in range(width):
                    met |= (mine >= 0) & (mine == held[b, m])
            links[start:stop] += np.bincount(a[~met], weights=mult[b[~met]], minlength=stop - start).astype(np.int64)
        tied = np.arange(n)
        seen = np.zeros(n, bool)
        for first in range(n):
            front = np.array([first] if not seen[first] else [], np.int64)
            while len(front):
                seen[front], tied[front] = True, first
                front = np.flatnonzero(close[front].any(axis=0) & ~seen)
        reps, cids = table.column("rep").to_numpy(), table.column("cid").to_numpy()
        some = (links > 0) | (tied != np.arange(n))
        return pa.table({"cid": cids[some], "links": links[some], "a": reps[some], "b": reps[tied[some]]})

    return run


def leaves_of(classes: DataFrame, least: float, leaf_rows: int, single: bool) -> DataFrame:
    """``cid, code`` for each leaf that a class is in: all of a small label is one leaf."""
    state = classes.select("cid", F.lit(-1).alias("tree"), F.xxhash64("label", "size").alias("code"))
    done = None
    parents: DataFrame | None = None
    while True:
        state = settle(state)
        sizes = state.groupBy("tree", "code", *(["parent", "before"] if parents is not None else [])).agg(F.count("*").alias("n"))
        large = F.col("n") > leaf_rows
        if parents is not None:  # a node that its cuts did not make smaller stays a leaf
            large = large & (F.col("n") <= 0.9 * F.col("before"))
        sizes = ready_side(sizes.withColumn("large", large).select("code", "n", "large"), BROADCAST_ROWS)
        placed = state.select("cid", "tree", "code").join(sizes, "code")
        small = placed.where("NOT large").select("cid", "code")
        done = small if done is None else done.unionByName(small)
        if not sizes.where("large").head(1):
            return settle(done)
        rows = settle(placed.where("large").select("cid", "tree", "code", "n").join(classes.select("cid", "vec"), "cid"))
        chosen = F.pmod(F.xxhash64("cid", "code"), F.lit(1 << 30)) < F.least(F.lit(1.0), SAMPLE_ROWS / F.col("n")) * float(1 << 30)
        kinds = "code long, trees array<int>, cuts array<binary>"
        cuts = settle(rows.where(chosen).groupBy("code").applyInArrow(fitted_cuts(least, leaf_rows, single), kinds))
        salts = F.ceil(F.col("n") / SERVED_ROWS).cast("int")
        given = cuts.join(sizes, "code").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        nothing = lambda kind: F.lit(None).cast(kind)
        given = given.select("code", "salt", nothing("long").alias("cid"), nothing("binary").alias("vec"), "trees", "cuts")
        asking = rows.select("code", F.pmod(F.xxhash64("cid"), salts).cast("int").alias("salt"), "cid", "vec", nothing("array<int>").alias("trees"), nothing("array<binary>").alias("cuts"))
        together = asking.unionByName(given).repartition("code", "salt").sortWithinPartitions("code", "salt", F.asc_nulls_first("cid"))
        found = together.mapInArrow(routed(least, single), "cid long, tree int, code long, parent long")
        parents = sizes.select(F.col("code").alias("parent"), F.col("n").alias("before"))
        state = found.join(parents, "parent")


def near_vectors(
    vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """One row per input row: the id, ``n_links``, ``component_id`` and ``kept``.

    Rows of one label link where the cosine of their vectors is at least ``least`` and they meet in a leaf; nothing
    below it links. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable,
    ``kept`` tells whether it is the row's own. Rows without a label, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing, nor do vectors of different lengths. Equal vectors of a label are compared once
    and always link. Rows that repeat an id are one document with several vectors: they are in one component. A row without an
    id takes no part: it has no links, no component, and is kept. Ids are whole numbers. Other columns are ignored. An
    empty table gives an empty result. Labels of up to ``leaf_rows`` different vectors are compared whole.
    """
    single = dict(vectors.dtypes)[vec_col] == "array<float>"
    base = vectors.select(named(id_col).cast("long").alias("id"), named(label_col).cast("string").alias("label"), named(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    rows = settle(base.mapInArrow(packed_vectors(single), "id long, label string, vec binary, size int, h long, g long"))
    able = rows.where("id IS NOT NULL AND label IS NOT NULL AND size IS NOT NULL")
    key = ["label", "size", "h", "g"]
    # Equal vectors have equal bytes; a hash of 128 bits stands for them.
    classes = able.groupBy(*key).agg(F.min("id").alias("rep"), F.count("*").alias("mult"), F.first("vec").alias("vec"))
    classes = settle(classes.withColumn("cid", F.monotonically_increasing_id()))
    codes = leaves_of(classes, least, leaf_rows, single)
    every = codes.groupBy("cid").agg(F.sort_array(F.collect_set("code")).alias("codes"))  # a few for each tree
    sizes = ready_side(codes.groupBy("code").agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("chunks")), BROADCAST_ROWS)
    entries = classes.select("cid", "rep", "mult", "vec").join(every, "cid").withColumn("code", F.explode("codes")).join(sizes, "code")
    entries = entries.withColumn("chunk", F.pmod(F.xxhash64("cid"), "chunks").cast("int"))
    entries = entries.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    entries = entries.select("code", F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"), "chunk", "cid", "rep", "mult", "vec", "codes")
    found = settle(entries.groupBy("code", "i", "j").applyInArrow(block_links(least, single), "cid long, links long, a long, b long"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select(*[F.col(k).alias(f"_{k}") for k in key], "rep", "mult", "cid").join(links, "cid", "left")
    same_id = able.groupBy("id").agg(F.count("*").alias("times"), F.count_distinct("h", "g", "label").alias("kinds")).where("kinds > 1").select("id")
    of = able.join(same_id, "id").join(known, [F.col(k) == F.col(f"_{k}") for k in key]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    labels = components(found.where("a <> b").select("a", "b").unionByName(of.where("a <> b").distinct()))
    known = ready_side(known.join(labels, F.col("rep") == F.col("node"), "left").select(
        *[f"_{k}" for k in key], F.coalesce("label", "rep").alias("component"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n")), BROADCAST_ROWS)
    usable = F.col("id").isNotNull()
    told = rows.join(known, [F.when(usable, F.col(k)) == F.col(f"_{k}") for k in key], "left")
    component = F.when(usable, F.coalesce("component", "id"))
    return told.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
