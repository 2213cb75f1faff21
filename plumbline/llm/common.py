"""Helpers shared by the operators: column packing, word and line expressions, shared scratch data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import release, scratch_path

#: ASCII white space; everything between is a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Narrow rows that a partition holds at least, where their number is known.
PARTITION_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def pack(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns under the keyword names; every other column goes into the struct ``rest``.

    Whatever the other columns are called, they cannot clash with an operator's own.
    """
    used = {c.lower() for c in columns.values()}
    others = [named(c).alias(c) for c in df.columns if c.lower() not in used]
    rest = F.struct(*others) if others else F.lit(None).cast("boolean")
    return df.select(*[named(c).alias(k) for k, c in columns.items()], rest.alias("rest"))


def unpack(df: DataFrame, order: Sequence[str], **columns: str) -> DataFrame:
    """Back from ``pack`` to the columns in ``order``; what else ``df`` has is left out."""
    known = {c.lower(): k for k, c in columns.items()}
    return df.select(
        *[(F.col(known[c.lower()]) if c.lower() in known else F.col("rest").getField(c)).alias(c) for c in order]
    )


def fold(text: Column) -> Column:
    """A-Z in lower case; all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def settle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cuts lineage with a checkpoint in the shared folder of ``spark.checkpoint.dir``.

    Where about how many rows there are is known, they go into no more partitions than these need.
    """
    if rows is not None:
        df = df.coalesce(1 + rows // PARTITION_ROWS)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if base:
            context.setCheckpointDir(base)
        else:
            scratch_path(df.sparkSession, "checkpoint")  # a local session's own folder, or an error on a cluster
    return df.checkpoint()


def settle_and_release(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``settle`` for joins of many jobs: what the job leaves on the driver (sides it broadcast, plans) would else
    stay there until a full heap is collected, and grow with the rows."""
    settled = settle(df, rows)
    release(df.sparkSession)
    return settled


def ready_side(side: DataFrame, most_rows: int, rows: int | None = None) -> DataFrame:
    """A side of a join, settled and counted: broadcast up to ``most_rows`` rows, else left to a shuffled join
    (adaptive execution splits its hot keys, as both sides are then plain exchanges)."""
    side = settle_and_release(side, rows)
    return F.broadcast(side) if side.count() <= most_rows else side
