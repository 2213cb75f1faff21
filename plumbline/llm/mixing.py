"""Mixes sources to target weights, exactly and reproducibly.

Every row gets a random key by hash; within its source it falls into a range of that key, is summed
up in order there, and ranges add the totals of those before them. Each source is then cut at its
budget. A source of n rows has about sqrt(n) ranges of sqrt(n) rows, so both sums stay small however
large one source is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, pack, ready_side, settle, unpack

#: Key digits that place a row in a range (52 bits: exact in a double).
DIGITS = 13
#: Sources that are broadcast at most.
BROADCAST_ROWS = 10_000


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``grp, source_size, target`` of each source of ``grp, source, rows, source_size``.

    Targets share ``share`` of all sizes by weight, none above ``most`` times its size: ordered by how
    early they fill up, sources are full as long as their part of what is left exceeds their limit.
    There is one row per source; sources carry weights by hand, so they are few.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int") + 1)
    before = Window.orderBy("fills", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sources.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    ranked = ranked.withColumn("fills", F.col("limit") / F.col("weight"))
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / open_weight)
    level = level.withColumn("rate", F.min(F.when(F.col("level") <= F.col("fills"), F.struct("fills", "level"))).over(everything)["level"])
    target = F.when(F.col("rate").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("rate") * F.col("weight")))
    return level.select("grp", "source_size", target.alias("target"), "rows")


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], share: float, most: float, seed: int) -> DataFrame:
    """``id, version, size, source_size, target, taken`` of each row; ``version`` is the random key."""
    size: Column = F.size(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    key = random_key(F.col(id_col), F.col(text_col), seed)
    sized = settle(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"),
            F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("grp"),
        )
    )
    sources = sized.groupBy("grp", "source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    targets = ready_side(source_targets(sources, weights, share, most), BROADCAST_ROWS)
    placed = sized.select("id", "size", "key", "grp").join(targets, "grp")
    unit = F.conv(F.substring("key", 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)
    placed = placed.withColumn("slot", F.floor(unit * F.ceil(F.sqrt("rows"))))
    totals = settle(placed.groupBy("grp", "slot").agg(F.sum("size").alias("slot_size")))
    ahead = Window.partitionBy("grp").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("grp", "slot", F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("grp", "slot").orderBy("key", F.col("id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["grp", "slot"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - epochs * F.col("source_size")).cast("long")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - F.col("ahead") - F.col("inside")))
    return summed.select("id", F.col("key").alias("version"), "size", "source_size", F.round("target", 6).alias("target"), taken.cast("long").alias("taken"))


def random_key(id_: Column, text: Column, seed: int) -> Column:
    """A hash of seed, id and text: copies that share an id still differ if their texts do."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(id_.cast("string"), F.lit("null")), F.lit("|"), F.coalesce(text, F.lit(""))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """One row per input row: the id, ``size``, ``source_size``, ``target`` and ``taken`` words.

    Sources in code point order, null last as a source of its own, take the weights in turn. What a source
    takes is its rounded target exactly: whole epochs, then rows in random order until the budget is cut
    within a row. A null or empty text has size 0 and takes 0. Rows with equal id and text are ordered
    by nothing else and interchangeable; null ids are allowed. An empty table gives an empty result.
    """
    out = _mixed(docs, id_col, text_col, source_col, weights, share, most, seed)
    return out.drop("version").withColumnRenamed("id", id_col)


def sample_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The rows of the mix: each as often as its words are begun (a text is never cut), columns unchanged.

    Rows without words take nothing and go.
    """
    chosen = _mixed(docs, id_col, text_col, source_col, weights, share, most, seed).where("taken > 0")
    times = chosen.groupBy("version").agg(F.sum(F.ceil(F.col("taken") / F.col("size"))).alias("times"), F.count("*").alias("rows"))
    base = pack(docs, id=id_col, text=text_col)
    base = base.withColumn("key", random_key(F.col("id"), F.col("text"), seed))
    found = base.join(times, F.col("key") == F.col("version"))
    found = found.withColumn("n", F.explode(F.sequence(F.lit(1), F.ceil(F.col("times") / F.col("rows")).cast("int"))))
    return unpack(found, docs.columns, id=id_col, text=text_col)
