"""One regression tree on the rows of one task: all nodes of a level are split together, with exact cuts.

Both children of a node are neighbours: a tree is three arrays. While a level has fewer nodes than a feature has rows for each of its
distinct values, the rows are summed up by node and value; further down each feature keeps its rows sorted by node and value, so
what depends on the place alone (the node, its sums, the slots of its children) is found once for all such features. Once nodes are
small, some at a time are finished, so that what they need stays in the cache.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rows whose nodes are finished together (a larger node is split first).
FRONT_ROWS = 32_768
#: Rows from which on they may be summed up by value.
SUMMED_ROWS = 8_192
#: Rows that each node of a level must have for that.
NODE_ROWS = 64


@dataclass(frozen=True)
class Growth:
    """How far and by what a tree grows. ``penalty`` is the (L1, L2) penalty of leaf values."""

    max_depth: int | None = None
    min_leaf: int = 1
    min_split: int = 2
    tried: int | None = None  # features tried at each node; all of them if None
    penalty: tuple[float, float] = (0.0, 0.0)

    def strength(self, total: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Twice what a node of this weight and this sum of (centred) labels takes off the loss."""
        return np.square(self.shrunk(total)) / (weight + self.penalty[1] if self.penalty[1] else weight)

    def shrunk(self, total):
        return np.sign(total) * np.maximum(np.abs(total) - self.penalty[0], 0.0) if self.penalty[0] else total

    def value(self, total, weight):
        return self.shrunk(total) / (weight + self.penalty[1])


@dataclass(frozen=True)
class Tree:
    """``feature`` (-1 in a leaf), ``cut`` (in a leaf: its value), the first of two children, and the value of every node if kept."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray | None = None

    def packed(self) -> bytes:
        kept = [] if self.value is None else [self.value.astype(np.float64).tobytes()]
        head = np.array([len(self.feature)], np.int64).tobytes()
        return b"".join([head, self.cut.astype(np.float64).tobytes(), self.child.astype(np.int32).tobytes(), self.feature.astype(np.int16).tobytes(), *kept])

    @staticmethod
    def packed_bytes(nodes: int, inner: bool) -> int:
        return 8 + nodes * (22 if inner else 14)

    @classmethod
    def unpacked(cls, raw: bytes) -> "Tree":
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ends = np.cumsum([8, 8 * n, 4 * n, 2 * n])
        value = np.frombuffer(raw[ends[3] :], np.float64) if len(raw) > ends[3] else None
        return cls(np.frombuffer(raw, np.int16, n, ends[2]), np.frombuffer(raw, np.float64, n, ends[0]), np.frombuffer(raw, np.int32, n, ends[1]), value)

    def depths(self) -> np.ndarray:
        """The depth of every node."""
        found, level = np.zeros(len(self.feature), np.int64), np.array([0])
        while len(level := level[self.feature[level] >= 0]):
            below = np.concatenate([self.child[level], self.child[level] + 1])
            found[below] = found[level[0]] + 1
            level = below
        return found

    @property
    def depth(self) -> int:
        return int(self.depths().max())

    def leaves(self, x: np.ndarray, cuts: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
        """The leaf of each row, and its node at each depth of ``cuts`` (or its leaf above)."""
        at, rows, depth = np.zeros(len(x), np.int64), np.arange(len(x)), 0
        at_depth = {0: at.copy()} if 0 in cuts else {}
        values, width = np.ascontiguousarray(x).ravel(), x.shape[1]
        node, first = at.copy(), rows * width  # of the rows still on their way: the node, and where their values begin
        while len(rows):
            feature = self.feature.take(node)
            ended = np.flatnonzero(feature < 0)
            if len(ended):
                at[rows.take(ended)] = node.take(ended)
                on = np.flatnonzero(feature >= 0)
                rows, node, first, feature = rows.take(on), node.take(on), first.take(on), feature.take(on)
            node = self.child.take(node) + (values.take(first + feature) > self.cut.take(node))
            depth += 1
            if depth in cuts and len(rows):
                at[rows] = node
                at_depth[depth] = at.copy()
        return at, [at_depth.get(c, at) for c in cuts]


@dataclass
class _Front:
    """Nodes of one level with their rows."""

    ids: np.ndarray
    depth: int
    node: np.ndarray  # of each row; -1 once its node is finished
    count: np.ndarray  # rows of each node
    orders: list[np.ndarray | None]  # for each feature, the rows sorted by node and value, once that is needed
    codes: list[np.ndarray]  # for each feature, the rank of each row's value
    sums: np.ndarray  # weight and weighted label of each row, as a complex number
    squares: np.ndarray
    total: np.ndarray  # of each node, as are the next two
    mass: np.ndarray
    square: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        """Where nodes begin in each order, and the end."""
        return np.concatenate([[0], np.cumsum(self.count)])

    def summed(self, f: int, values: int) -> bool:
        """Whether the rows are summed up by the values of a feature, as there are no more sums than rows.

        Small nodes have many cuts of equal gain: which one is taken there is left to sorted rows.
        """
        n = int(self.count.sum())
        return self.orders[f] is None and n >= SUMMED_ROWS and len(self.count) * values <= n and self.count.min() >= NODE_ROWS

    def order(self, f: int) -> np.ndarray:
        if self.orders[f] is None:
            rows = np.flatnonzero(self.node >= 0)
            rows = rows.take(np.argsort(_short(self.codes[f].take(rows)), kind="stable"))
            self.orders[f] = rows.take(np.argsort(_short(self.node.take(rows)), kind="stable"))
        return self.orders[f]

    def groups(self) -> list["_Front"]:
        """Itself while it is small or its nodes are large, else runs of nodes with about ``FRONT_ROWS`` rows each."""
        starts = self.starts
        if starts[-1] <= 2 * FRONT_ROWS or self.count.max(initial=0) > FRONT_ROWS:
            return [self]
        of = starts[:-1] // FRONT_ROWS
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(self.count)]
        out = []
        for a, b in zip(edges, edges[1:]):
            low, high = int(starts[a]), int(starts[b])
            rows = np.flatnonzero((self.node >= a) & (self.node < b))
            back = np.empty(len(self.node), np.intp)
            back[rows] = np.arange(len(rows))
            orders = [None if o is None else back.take(o[low:high]) for o in self.orders]
            codes = [c.take(rows) for c in self.codes]
            of_nodes = (m[a:b] for m in (self.total, self.mass, self.square))
            out.append(_Front(self.ids[a:b], self.depth, self.node[rows] - a, self.count[a:b], orders, codes, self.sums[rows], self.squares[rows], *of_nodes))
        return out


def _short(numbers: np.ndarray) -> np.ndarray:
    """Small whole numbers in a type that is sorted by its digits, where they fit."""
    return numbers.astype(np.uint16) if numbers.max(initial=0) < 1 << 16 else numbers


def _ranked(column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows sorted by value, the distinct values, and the rank of each row's value among them."""
    order = np.argsort(column, kind="stable")
    v = column.take(order)
    new = np.concatenate([[True], v[1:] > v[:-1]])[: len(v)]
    code = np.empty(len(v), np.int32)
    code[order] = np.cumsum(new) - 1
    return order, v[new], code


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, how: Growth, rng: np.random.Generator, inner: bool = False) -> tuple[Tree, np.ndarray]:
    """The tree of the rows with a weight, and the loss that each feature takes off.

    A node is split where its label still varies, at the cut with the largest gain (the first feature, the lowest cut of
    equal ones), halfway between two neighbouring values. Without penalties this is what exhaustive search gives.
    """
    used = np.flatnonzero(weight > 0)
    x, y, weight = x[used], y[used], weight[used].astype(np.float64)
    n, d = x.shape
    gains = np.zeros(d)
    wy = weight * y
    orders, values, codes = ([list(part) for part in zip(*(_ranked(np.ascontiguousarray(x[:, f])) for f in range(d)))] if d else ([], [], []))
    sums = np.empty(n, np.complex128)
    sums.real, sums.imag = weight, wy
    squares = wy * y
    total, mass, square = np.array([wy.sum()]), np.array([weight.sum()]), np.array([squares.sum()])
    floor = 1e-14 * max(float(square[0]), 1e-300) / max(float(mass[0]), 1.0)
    made, done = 1, []
    root = _Front(np.array([0]), 0, np.zeros(n, np.intp), np.array([n]), [None] * d, codes, sums, squares, total, mass, square)
    root.orders = [None if root.summed(f, len(values[f])) else orders[f] for f in range(d)]
    del orders
    fronts = [root]
    while fronts:
        front = fronts.pop()
        found, below = _split_level(front, values, how, rng, floor, made, gains)
        done.append((front.ids, *found))
        if below is not None:
            made += len(below.ids)
            fronts += reversed(below.groups())
    ids = np.concatenate([part[0] for part in done])
    features, cuts, children, node_values = (np.empty(made, k) for k in (np.int16, np.float64, np.int32, np.float64))
    for at, joined in enumerate((features, cuts, children, node_values), 1):
        joined[ids] = np.concatenate([part[at] for part in done])
    return Tree(features, cuts, children, node_values if inner else None), gains


def _open(how: Growth, depth: int, floor: float, count: np.ndarray, total: np.ndarray, mass: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Nodes that may be split: their label varies, and they have the rows and the depth."""
    if how.max_depth is not None and depth >= how.max_depth:
        return np.zeros(len(count), bool)
    loss = square - np.square(total) / np.where(mass > 0, mass, 1.0)
    return (count >= max(how.min_split, 2 * how.min_leaf, 2)) & (loss > floor * mass)


def _split_level(front: _Front, values: list[np.ndarray], how: Growth, rng: np.random.Generator, floor: float, made: int, gains: np.ndarray):
    """``(feature, cut, child, value)`` of the front's nodes, and the front of their children, numbered from ``made`` on."""
    starts, codes, count, total, mass, square = front.starts, front.codes, front.count, front.total, front.mass, front.square
    k, d, n = len(total), len(codes), int(starts[-1])
    value = how.value(total, mass)
    feature, cut, child = np.full(k, -1, np.int64), value.copy(), np.zeros(k, np.int64)
    last = np.zeros(k, np.int64)  # the rank of the last value on the left
    open_ = _open(how, front.depth, floor, count, total, mass, square)
    best = np.full(k, -np.inf)
    if not open_.any():
        return (feature, cut, child, value), None
    allowed = None
    if how.tried is not None and how.tried < d:
        allowed = np.argsort(np.argsort(rng.random((k, d)), axis=1), axis=1) < how.tried
    by_value = [front.summed(f, len(values[f])) for f in range(d)]
    if n and not all(by_value):
        of = np.repeat(np.arange(k), count)
        can = open_[of]
        if how.min_leaf > 1:
            rank = np.arange(n) - starts[of] + 1
            can &= (rank >= how.min_leaf) & (count[of] - rank >= how.min_leaf)
        can[starts[1:][count > 0] - 1] = False
    if any(by_value):  # rows of nodes above are out of such a front
        weights, labels = front.sums.real.copy(), front.sums.imag.copy()
    for f in range(d if n else 0):
        if by_value[f]:
            wide = len(values[f])
            cell = front.node * wide + codes[f]
            w_cell, s_cell = (np.bincount(cell, weights=m, minlength=k * wide).reshape(k, wide) for m in (weights, labels))
            full = w_cell > 0
            fine = full & open_[:, None]
            fine[np.arange(k), wide - 1 - np.argmax(full[:, ::-1], axis=1)] = False
            if how.min_leaf > 1:
                rank = np.cumsum(np.bincount(cell, minlength=k * wide).reshape(k, wide), axis=1)
                fine &= (rank >= how.min_leaf) & (count[:, None] - rank >= how.min_leaf)
            if allowed is not None:
                fine &= allowed[:, f][:, None]
            at = np.flatnonzero(fine)
            if not len(at):
                continue
            owner = at // wide
            w_left, s_left = (np.cumsum(m, axis=1).ravel().take(at) for m in (w_cell, s_cell))
        else:
            order = front.order(f)
            v = codes[f].take(order)
            fine = can.copy()
            fine[:-1] &= v[1:] > v[:-1]
            if allowed is not None:
                fine &= allowed[of, f]
            at = np.flatnonzero(fine)
            if not len(at):
                continue
            summed = np.cumsum(front.sums.take(order))
            before = np.where(starts[:-1] > 0, summed.take(np.maximum(starts[:-1] - 1, 0)), 0.0)
            owner = of.take(at)
            left = summed.take(at) - before.take(owner)
            w_left, s_left = left.real, left.imag
        gain = how.strength(s_left, w_left) + how.strength(total.take(owner) - s_left, mass.take(owner) - w_left)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        top = np.maximum.reduceat(gain, first)
        who = owner[first]
        hit = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(first, len(at)))))
        hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])]
        better = top > np.where(np.isfinite(best[who]), best[who] * (1 + 1e-12), -np.inf)
        who, spot = who[better], at[hit[better]]
        best[who], feature[who] = top[better], f
        if by_value[f]:
            cells = np.flatnonzero(full)
            below, above = spot % wide, cells.take(np.searchsorted(cells, spot) + 1) % wide
        else:
            below, above = v[spot], v[spot + 1]
        last[who], low, high = below, values[f].take(below), values[f].take(above)
        middle = low + (high - low) / 2
        cut[who] = np.where((middle >= high) | ~np.isfinite(middle), low, middle)
    gained = best - how.strength(total, mass)
    if how.penalty != (0.0, 0.0):
        feature[gained <= 1e-9 * np.maximum(square, 1e-300)] = -1
    cut = np.where(feature >= 0, cut, value)
    np.add.at(gains, feature[feature >= 0], np.maximum(gained[feature >= 0], 0.0))
    split = feature >= 0
    n_split = int(split.sum())
    child[split] = made + 2 * np.arange(n_split)
    if not n_split:
        return (feature, cut, child, value), None
    side = np.full(len(front.node), 2, np.int8)  # of each row: left, right, or out with a finished node
    by = np.append(feature, -1).astype(np.int16).take(front.node)  # node -1 is the one at the end
    for f in range(d):
        mine = np.flatnonzero(by == f)
        side[mine] = codes[f].take(mine) > last.take(front.node.take(mine))
    node = np.where(side < 2, np.append(2 * (np.cumsum(split) - 1), 0).take(front.node) + side, -1)
    keep = np.flatnonzero(node >= 0)
    whole = len(keep) == len(node)
    inside, sums, squares = (m if whole else m.take(keep) for m in (node, front.sums, front.squares))
    counts = np.bincount(inside, minlength=2 * n_split)
    total, mass, square = (np.bincount(inside, weights=v, minlength=2 * n_split) for v in (sums.imag, sums.real, squares))
    slots = np.repeat(np.tile([True, False], n_split), counts)  # where the rows of left children go, for every feature
    at_left, at_right = np.flatnonzero(slots), np.flatnonzero(~slots)
    placed: list[np.ndarray | None] = []
    for order in front.orders:
        if order is None:
            placed.append(None)
            continue
        goes, new = side.take(order), np.empty(len(slots), np.intp)
        new[at_left], new[at_right] = order.take(np.flatnonzero(goes == 0)), order.take(np.flatnonzero(goes == 1))
        placed.append(new)
    if 4 * len(keep) < 3 * len(front.node) or (len(keep) < len(front.node) and any(o is None for o in placed)):
        back = np.empty(len(front.node), np.intp)
        back[keep] = np.arange(len(keep))
        placed, codes = [None if o is None else back.take(o) for o in placed], [c.take(keep) for c in codes]
        node = inside
    else:  # few rows are out: they stay where they are, and no order names them
        sums, squares = front.sums, front.squares
    ids = made + np.arange(2 * n_split)
    return (feature, cut, child, value), _Front(ids, front.depth + 1, node, counts, placed, codes, sums, squares, total, mass, square)
