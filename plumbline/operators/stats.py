"""Column statistics: single-pass aggregates and exact order statistics.

``percentile`` keeps every distinct value of a column in one task, which a large
table does not survive. Exact quantiles are found here by narrowing instead: a
mergeable sketch proposes two values around the wanted rank, an exact count says
on which side of them the rank lies, and only once few rows are left between the
bounds are those rows gathered and sorted. Ties need no special care, because a
proposed value that holds the rank ends the search however often it occurs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType
from pyspark.storagelevel import StorageLevel

# Rows that one bracket may hold when they are gathered into one array.
GATHER_LIMIT = 20_000
SKETCH_ACCURACY = 2_000


def per_column(df: DataFrame, columns: Sequence[str], **metrics: Callable[[str], Column]) -> DataFrame:
    """One aggregation over all columns, returned as one row per column."""
    wide = df.agg(
        *[make(name).alias(f"{metric}__{i}") for i, name in enumerate(columns) for metric, make in metrics.items()]
    )
    return unpivot(wide, columns, metrics)


def unpivot(wide: DataFrame, columns: Sequence[str], metrics: Iterable[str]) -> DataFrame:
    """Turn the one wide row ``metric__i`` of an aggregation into a row per column."""
    metrics = list(metrics)
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("column"), *[F.col(f"{m}__{i}").alias(m) for m in metrics])
                    for i, name in enumerate(columns)
                ]
            )
        )
    )


def long_form(df: DataFrame, values: Mapping[str, Column], keep: Sequence[Column] = ()) -> DataFrame:
    """Narrow unpivot of columns of one type into (column, value) rows."""
    return df.select(
        *keep,
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), c.alias("value")) for n, c in values.items()])),
    )


@dataclass(frozen=True)
class Moments:
    count: int
    missing: int
    mean: float | None
    std: float | None
    std_pop: float | None
    min: float | None
    max: float | None


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Moments]:
    """Count, missing, mean, standard deviations and range of all columns in one pass."""
    if not columns:
        return {}
    measures = (
        lambda c: F.count(c),
        lambda c: F.count_if(F.col(c).isNull()),
        lambda c: F.avg(c),
        lambda c: F.stddev_samp(c),
        lambda c: F.stddev_pop(c),
        lambda c: F.min(c).cast("double"),
        lambda c: F.max(c).cast("double"),
    )
    row = df.agg(*[m(c).alias(f"m{j}_{i}") for i, c in enumerate(columns) for j, m in enumerate(measures)]).first()
    width = len(measures)
    return {c: Moments(*row[i * width : (i + 1) * width]) for i, c in enumerate(columns)}


@dataclass
class _Search:
    """Open interval (low, high) that holds the wanted rank, with exact counts around it."""

    value: int
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    found: float | None = None
    disjoint: bool = False

    def member(self) -> Column:
        c = F.col("v") if self.disjoint else F.col(f"v{self.value}")
        inside = (F.col("g") == self.value) if self.disjoint else c.isNotNull()
        if self.low is not None:
            inside = inside & (c > F.lit(self.low))
        if self.high is not None:
            inside = inside & (c < F.lit(self.high))
        return F.when(inside, c)

    def narrow(self, candidate: float, less: int, equal: int) -> None:
        if self.found is not None:
            return
        if self.rank < less:
            if self.high is None or candidate < self.high:
                self.high, self.inside = candidate, less - self.below
        elif self.rank < less + equal:
            self.found = candidate
        elif self.low is None or candidate > self.low:
            self.inside -= less + equal - self.below
            self.low, self.below = candidate, less + equal


def order_statistics(
    df: DataFrame,
    values: Mapping[str, Column],
    ranks: Mapping[str, Iterable[int]],
    counts: Mapping[str, int],
    gather_limit: int = GATHER_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
    group: Column | None = None,
) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ``ranks`` among the non-null ``values`` of each name.

    Values are compared in their own type; NaN counts as the largest. With ``group``, all names
    share one value expression and a row belongs to the name at its group's position,
    which saves an unpivot. Each round costs two scans
    of the needed columns and divides the rows in question by about 500.
    """
    names = list(values)
    disjoint = group is not None
    if disjoint:
        base = df.select(group.cast("int").alias("g"), values[names[0]].alias("v")).filter("g IS NOT NULL AND v IS NOT NULL")
    else:
        base = df.select(*[values[n].alias(f"v{i}") for i, n in enumerate(names)])
    searches = [
        _Search(i, rank, 0, counts[n], disjoint=disjoint) for i, n in enumerate(names) for rank in sorted(set(ranks.get(n, ())))
    ]
    while wide := [s for s in searches if s.found is None and s.inside > gather_limit]:
        proposals = _propose(base, wide, accuracy)
        tallies = _counts(base, proposals, disjoint)
        for s in wide:
            for candidate in proposals[s.value]:
                s.narrow(candidate, *tallies[(s.value, candidate)])
    _gather(base, [s for s in searches if s.found is None])
    return {(names[s.value], s.rank): s.found for s in searches}


def _brackets(searches: Sequence[_Search]) -> list[list[_Search]]:
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault((s.value, s.low, s.high), []).append(s)
    return list(groups.values())


def _propose(base: DataFrame, searches: Sequence[_Search], accuracy: int) -> dict[int, list[float]]:
    """Two values around every wanted rank, from one sketch per bracket.

    Sketches hold doubles. Whole and decimal numbers are sketched by their distance from a bound of
    the bracket, and a bracket with two bounds also proposes its middle, so that it always shrinks.
    """
    slack = 2.0 / accuracy
    groups = _brackets(searches)
    sketches, anchors, steps = [], [], []
    for group in groups:
        s = group[0]
        shares = [(s.rank - s.below) / max(1, s.inside - 1) for s in group]
        probes = sorted({max(0.0, x - slack) for x in shares} | {min(1.0, x + slack) for x in shares})
        kind = base.schema["v" if s.disjoint else f"v{s.value}"].dataType
        step = Decimal(1).scaleb(-kind.scale) if isinstance(kind, DecimalType) else 1 if isinstance(kind, IntegralType) else None
        anchor = next((Decimal(x) for x in (s.low, s.high) if x is not None), Decimal(0)) if step else None
        member = s.member()
        if step:
            member = (member.cast(f"decimal(38,{kind.scale if step != 1 else 0})") - F.lit(anchor)).cast("double")
        sketches.append(F.percentile_approx(member, probes, accuracy))
        anchors.append(anchor)
        steps.append(step)
    row = base.agg(*[sketch.alias(f"s{i}") for i, sketch in enumerate(sketches)]).first()
    proposals: dict[int, set[float]] = {}
    for values, anchor, step, group in zip(row, anchors, steps, groups):
        s = group[0]
        if step:
            values = [anchor + (Decimal(x) / step).to_integral_value() * step for x in values]
            if s.low is not None and s.high is not None:
                values.append(((Decimal(s.low) + Decimal(s.high)) / 2 / step).to_integral_value(ROUND_FLOOR) * step)
            values = [int(x) for x in values] if step == 1 else values
        proposals.setdefault(s.value, set()).update(values)
    return {v: sorted(candidates) for v, candidates in proposals.items()}


def _counts(base: DataFrame, proposals: Mapping[int, list[float]], disjoint: bool) -> dict[tuple[int, float], tuple[int, int]]:
    """Exact numbers of rows below and equal to every proposed value: one aggregate, compared in the column's own type."""
    asked = [(v, edge) for v, edges in proposals.items() for edge in edges]
    tallies = []
    for v, edge in asked:
        value, mine = (F.col("v"), F.col("g") == v) if disjoint else (F.col(f"v{v}"), F.lit(True))
        tallies += [F.count_if(mine & (value < F.lit(edge))), F.count_if(mine & (value == F.lit(edge)))]
    row = base.agg(*[t.alias(f"c{i}") for i, t in enumerate(tallies)]).first()
    return {key: (row[2 * i], row[2 * i + 1]) for i, key in enumerate(asked)}


def _gather(base: DataFrame, searches: Sequence[_Search]) -> None:
    """Read the ranks off the few rows left in each bracket (at most the gather limit)."""
    groups = _brackets(searches)
    if not groups:
        return
    gathered = base.agg(*[F.sort_array(F.collect_list(g[0].member())).alias(f"g{i}") for i, g in enumerate(groups)])
    picked = gathered.select(
        *[
            F.array(*[F.get(F.col(f"g{i}"), F.lit(s.rank - s.below)) for s in g]).alias(f"p{i}")
            for i, g in enumerate(groups)
        ]
    ).first()
    for values, group in zip(picked, groups):
        for s, value in zip(group, values):
            s.found = value


def quantiles(
    df: DataFrame,
    values: Sequence[str] | Mapping[str, Column],
    probs: Sequence[float],
    counts: Mapping[str, int] | None = None,
    accuracy: int | None = None,
    group: Column | None = None,
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles of every column, ``{column: {p: value}}``.

    Exact by default. ``accuracy`` asks for one pass of ``percentile_approx`` instead.
    """
    exprs = dict(values) if isinstance(values, Mapping) else {c: F.col(c) for c in values}
    if not exprs:
        return {}
    names = list(exprs)
    if accuracy is not None:
        row = df.agg(*[F.percentile_approx(exprs[n], list(probs), accuracy) for n in names]).first()
        return {n: dict(zip(probs, row[i] or [None] * len(probs))) for i, n in enumerate(names)}
    if counts is None:
        row = df.agg(*[F.count(exprs[n]) for n in names]).first()
        counts = dict(zip(names, row))
    positions = {n: {p: (counts[n] - 1) * p for p in probs} for n in names if counts[n]}
    ranks = {
        n: {r for position in by_prob.values() for r in (math.floor(position), math.ceil(position))}
        for n, by_prob in positions.items()
    }
    found = order_statistics(df, exprs, ranks, counts, group=group)

    def value(name: str, p: float) -> float | None:
        if not counts[name]:
            return None
        position = positions[name][p]
        low, high = found[name, math.floor(position)], found[name, math.ceil(position)]
        if low == high:  # also infinities, whose difference is no number
            return float(low)
        return float(low) + float(high - low) * (position - math.floor(position))

    return {n: {p: value(n, p) for p in probs} for n in names}


def spread(df: DataFrame) -> DataFrame:
    """Cache rows that are read many times, over at least as many partitions as there are cores.

    Filling the cache shows how many partitions hold rows; only an input with fewer
    than that (a small or unsplittable file) is dealt out again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    used = cached.select(F.spark_partition_id().alias("p")).distinct().count()
    if used >= cores:
        return cached
    even = cached.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    even.count()
    cached.unpersist()
    return even


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one shuffle; pre-aggregated before it."""
    values = {c: F.col(c).cast("string") for c in columns}
    return (
        long_form(df, values).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    )
