"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settle_and_release


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``a, b``: the smallest node that is reachable.

    Each round ties larger neighbours to the smallest one (large star), then smaller ones to the smallest of
    theirs (small star), until nothing changes: a logarithmic number of rounds, none of which gathers a component.
    """
    edges = settle_and_release(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before, n = None, 2 * edges.count()
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle_and_release(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), n)
        large = settle_and_release(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), n)
        lower = settle_and_release(large.groupBy("u").agg(F.min("v").alias("m")), n)
        small = large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle_and_release(small.unionByName(lower.withColumnRenamed("m", "v")).distinct(), n)
    found = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
