"""Reproducible splits and folds, decided per row from its key without a shuffle."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import KEY_SPACE, fraction_threshold, row_key
from plumbline.operators.stats import moments, order_statistics


def test_flag(ids: Sequence[str], test_size: float = 0.2, seed: int = 42) -> Column:
    """True for about ``test_size`` of the rows; needs no pass over the data."""
    return row_key(*ids, seed=seed) < F.lit(fraction_threshold(test_size))


def split_column(is_test: Column) -> Column:
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


def _cut(df: DataFrame, group: Column, sizes: Sequence[int], wanted: Sequence[int], ids: Sequence[str], seed: int) -> Column:
    """The ``wanted[g]`` rows with the smallest (key, id) of every group ``g``, as one filter expression.

    The key of the last wanted row is an exact order statistic. Rows that share that
    key are told apart by a second key of all their ids, whatever the ids' types, and rows
    that share both by the ids themselves; rows with the same ids stay together.
    """
    key = row_key(*ids, seed=seed)
    names = [str(g) for g in range(len(sizes))]
    ranks = {n: [w - 1] for n, w in zip(names, wanted) if w}
    found = order_statistics(df, {n: key for n in names}, ranks, dict(zip(names, sizes)), group=group)
    cuts = [int(found[n, w - 1]) if w else -1 for n, w in zip(names, wanted)]
    last = F.get(F.array(*[F.lit(c).cast("bigint") for c in cuts]), group)
    chosen = key <= last
    tallies = (
        df.select(group.alias("g"), key.alias("k"), last.alias("cut"))
        .groupBy("g")
        .agg(F.count_if(F.col("k") < F.col("cut")).alias("less"), F.count_if(F.col("k") == F.col("cut")).alias("equal"))
        .collect()
    )  # one row per group
    for r in tallies:
        g, need = r["g"], wanted[r["g"]] - r["less"]
        if wanted[g] and need < r["equal"]:
            tied = (group == g) & (key == F.lit(cuts[g]))
            second = row_key(*ids, seed=seed + 1)
            edge = order_statistics(df, {"id": F.when(tied, second)}, {"id": [need - 1]}, {"id": r["equal"]})["id", need - 1]
            chosen = chosen & ~(tied & (second > F.lit(edge)))
            last_ids = _last_ids(df.where(tied), second, edge, need, ids)
            if last_ids is not None:
                chosen = chosen & ~(tied & (second == F.lit(edge)) & (F.struct(*ids) > last_ids))
    return chosen


def _last_ids(tied: DataFrame, second: Column, edge: int, need: int, ids: Sequence[str]) -> Column | None:
    """The ids of the last of the ``need`` rows with the smallest second key and ids, if those with the key ``edge`` differ in ids."""
    need -= tied.where(second < F.lit(edge)).count()
    same = tied.where(second == F.lit(edge)).groupBy(*ids).count().orderBy(*ids).collect()  # ids that agree in two hashes: a few
    if len(same) < 2:
        return None
    last = next(r for r, upto in zip(same, accumulate(r["count"] for r in same)) if upto >= need)
    return F.struct(*[F.lit(last[i]).cast(tied.schema[name].dataType).alias(name) for i, name in enumerate(ids)])


def split_exact(df: DataFrame, ids: Sequence[str], test_size: float = 0.2, seed: int = 42, column: str = "split") -> DataFrame:
    """Add ``split``: exactly ``ceil(test_size * n)`` test rows. The ids must identify a row."""
    n = df.count()
    is_test = _cut(df, F.lit(0), [n], [math.ceil(test_size * n - 1e-9)], ids, seed)
    return df.withColumn(column, split_column(is_test))


def label_bin(label: str, low: float, high: float, bins: int = 10) -> Column:
    """Equal-width, right-closed label bins ``0..bins-1``; the minimum belongs to the first."""
    width = (high - low) / bins
    if width <= 0:
        return F.lit(0)
    raw = F.ceil((F.col(label) - F.lit(low)) / F.lit(width)) - 1
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), raw)).cast("int")


def split_stratified(
    df: DataFrame, ids: Sequence[str], label: str, test_size: float = 0.2, bins: int = 10, seed: int = 42, column: str = "split"
) -> DataFrame:
    """Add ``split`` with ``ceil(test_size * n_bin)`` test rows in every label bin."""
    s = moments(df, [label])[label]
    binned = df.withColumn("__bin", label_bin(label, s.min, s.max, bins))
    counted = {r["__bin"]: r["count"] for r in binned.groupBy("__bin").count().collect()}  # `bins` rows
    sizes = [counted.get(b, 0) for b in range(bins)]
    wanted = [math.ceil(test_size * n - 1e-9) for n in sizes]
    is_test = _cut(binned, F.col("__bin"), sizes, wanted, ids, seed)
    return binned.withColumn(column, split_column(is_test)).drop("__bin")


def fold_column(ids: Sequence[str], folds: int = 5, seed: int = 42) -> Column:
    """Shuffled fold number ``0..folds-1``, from a key of its own: folds of a train split are as even as those of all rows."""
    return F.shiftright(row_key(F.lit("fold"), *ids, seed=seed) * F.lit(folds), KEY_SPACE.bit_length() - 1).cast("int")


def require_folds(found: Iterable[int], folds: int) -> None:
    """An error where a fold holds no row: its score would be missing from every mean."""
    empty = sorted(set(range(folds)) - set(found))
    if empty:
        raise ValueError(f"folds {empty} of {folds} hold no row")


def contiguous_folds(df: DataFrame, order: str, folds: int = 5, column: str = "fold") -> DataFrame:
    """Folds that are runs of the ``order`` column, cut at its exact quantiles."""
    n = df.agg(F.count(order)).first()[0]
    size, larger = divmod(n, folds)  # the first folds take the remainder
    starts = [i * size + min(i, larger) for i in range(1, folds)]
    found = order_statistics(df, {order: F.col(order)}, {order: starts}, {order: n})
    fold = F.lit(0)
    for r in starts:
        fold = fold + (F.col(order) >= F.lit(found[order, r])).cast("int")
    return df.withColumn(column, fold)
