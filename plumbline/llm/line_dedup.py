"""Drops lines that many documents share.

Normalised lines are exploded with their positions and hashed (128 bits); per hash, distinct
documents are counted in two steps, so that a line of a third of all documents is summed before
it meets; documents get back the positions they lose and are reassembled by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, fold, lines, pack, settle, unpack

REPORT = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    return fold(F.trim(line, F.lit(BLANKS)))


def _reassembled(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """``id, text, rest`` of each row with ``kept``, ``n_lines`` and ``n_dropped``."""
    base = pack(docs, id=id_col, text=text_col)
    keyed = base.where("id is not null").select("id", F.xxhash64("text").alias("version"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    keyed = keyed.select("id", "version", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    hashed = settle(keyed.select("id", "version", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g")))
    counted = hashed.groupBy("h", "g").agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"))
    shared = settle(counted.where(F.col("n") >= min_docs))  # apart from the join, which can then split a line of very many documents
    lost = (
        hashed.join(shared, ["h", "g"])
        .where(F.col("id") != F.col("keeper"))
        .groupBy(F.col("id").alias("lost_id"), F.col("version").alias("lost_version"))
        .agg(F.collect_set("pos").alias("lost"))
    )
    found = base.join(lost, (F.col("id") == F.col("lost_id")) & (F.xxhash64("text") == F.col("lost_version")), "left")
    found = found.select("id", "text", "rest", lines(F.col("text")).alias("lines"), F.coalesce("lost", F.array().cast("array<int>")).alias("lost"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    kept = F.when(F.size("lost") == 0, F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    return found.select(
        "id", "text", "rest", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), F.size("lost").cast("long").alias("n_dropped")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: the id, ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays).

    A key of at least ``min_chars`` code points in at least ``min_docs`` documents loses its lines
    everywhere but in the largest id that holds it. A document is an id: rows that repeat an id count
    once, and each of them loses the line. A null or empty text is one empty line; a row without an id
    neither counts nor loses anything; an empty table gives an empty result. Other columns are ignored.
    """
    out = _reassembled(docs, id_col, text_col, min_chars, min_docs)
    return out.select(F.col("id").alias(id_col), *REPORT, "kept")


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The input's rows and columns with the text that stays (a null text becomes empty)."""
    out = _reassembled(docs, id_col, text_col, min_chars, min_docs).drop("text").withColumnRenamed("kept", "text")
    return unpack(out, docs.columns, id=id_col, text=text_col)
