"""Positions of rows in an order, over the whole table or within groups, without gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import ready_side, settle

#: Runs (rows of one group in one partition) whose offsets are broadcast at most; each takes about 50 bytes and its group.
BROADCAST_RUNS = 100_000


def positions(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """The rows with ``pos``, from 0 in the order of each ``group`` (a column that is never null), and ``n``, the rows of it.

    Rows are sorted over ranges of the group and the order; only the number of rows of each group in each range is
    summed up. Rows that agree in both are told apart by where they are stored, so no key of any frequency fills
    a range, and a group of any size spreads over many. The input should be cheap to read: the ranges take a pass of their own.
    """
    rows = settle(rows.withColumn("__tie", F.monotonically_increasing_id()))
    keys = [F.col(group), *order, F.col("__tie")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    placed = settle(placed.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")))
    runs = placed.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__of")).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    each = Window.partitionBy("__group")  # at most one row for each partition
    before = F.sum("__rows").over(each.orderBy("__of")) - F.col("__rows")
    runs = ready_side(runs.select("__group", "__of", "__first", before.alias("__before"), F.sum("__rows").over(each).alias("n")), BROADCAST_RUNS)
    met = placed.join(runs, (F.col(group) == F.col("__group")) & (F.col("__part") == F.col("__of")))
    pos = F.col("__at") - F.col("__first") + F.col("__before")
    return met.withColumn("pos", pos).drop("__part", "__at", "__group", "__of", "__first", "__before")
