"""Merkle manifest of a dataset: a tree of hashes for each group, one over the groups' roots, and every row's path.

A level of an aligned block of nodes is one string of hexadecimal digests, 64 characters each. Parents are hashes of
its fixed-width substrings, and what stands beside a node in its run are the siblings. A block's root
is a node of the next table, which is cut into blocks in the same way, until each group has one node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import named, ready_side, settle
from plumbline.llm.ranks import positions

#: Children of a node, and levels that one block holds: a block is a string of ARITY ** LEVELS digests at most.
ARITY, LEVELS, WIDTH = 8, 3, 64
#: Groups whose roots and paths are broadcast at most (about 4 KB each).
BROADCAST_GROUPS = 10_000
PATH = "array<struct<left:binary,right:binary>>"


def digest(content: Column) -> Column:
    """SHA-256 as lowercase hexadecimal text, in bytes: substrings of bytes take constant time."""
    return F.sha2(content, 256).cast("binary")


def row_digest(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field as ``-`` if null, else its number of UTF-8 bytes, a colon and itself."""
    text = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"))


def _joined(digests: Column) -> Column:
    return F.array_join(digests.cast("array<string>"), "").cast("binary")


def _cut(level: Column, first: Column, count: Column) -> Column:
    return level.substr((first * WIDTH + 1).cast("int"), (count * WIDTH).cast("int"))


def _parents(level: Column) -> Column:
    """The next level: the hash of each run of ``ARITY`` digests, the last of which may be shorter."""
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (ARITY * WIDTH)).cast("int") - 1)
    return _joined(F.transform(runs, lambda i: F.sha2(_cut(level, i * ARITY, F.lit(ARITY)), 256)))


def _beside(level: Column, at: Column) -> Column:
    """``left`` and ``right`` of the node ``at``: the other digests of its run."""
    first = F.floor(at / ARITY) * ARITY
    return F.struct(_cut(level, first, at - first).alias("left"), _cut(level, at + 1, first + ARITY - 1 - at).alias("right"))


def climb(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """``grp, pos, node, path, top`` and ``payload`` for nodes ``grp, pos, node, n``: the way to the root of the group, and that root.

    ``pos`` counts from 0 in each group of ``n`` nodes. While several nodes remain, each run of ``ARITY`` becomes the
    hash of its digests, also a last run of one; a lone node is its own root.
    """
    size = ARITY**LEVELS
    block = F.floor(F.col("pos") / size)
    items = F.sort_array(F.collect_list(F.struct(F.col("pos"), "node", *payload)))  # at most `size`
    blocks = nodes.groupBy("grp", block.alias("block")).agg(items.alias("items"), F.max("n").alias("n")).withColumn("l0", _joined(F.col("items.node")))
    for k in range(LEVELS):  # a group with one block stops at its root; others climb all levels
        done = (F.col("n") <= size) & (F.octet_length(f"l{k}") <= WIDTH)
        blocks = blocks.withColumn(f"l{k + 1}", F.when(done, F.col(f"l{k}")).otherwise(_parents(F.col(f"l{k}"))))
    blocks = settle(blocks)
    roots = blocks.select("grp", F.col("block").alias("pos"), F.col(f"l{LEVELS}").alias("node"), F.ceil(F.col("n") / size).alias("n"))
    largest = roots.agg(F.max("n")).first()[0]
    if largest is not None and largest > 1:
        above = climb(roots).select("grp", F.col("pos").alias("block"), F.col("path").alias("above"), "top")
    else:
        above = roots.select("grp", F.col("pos").alias("block"), F.array().cast(PATH).alias("above"), F.col("node").alias("top"))
    rows = blocks.join(above, ["grp", "block"]).select("grp", "above", "top", "n", *[f"l{k}" for k in range(LEVELS)], F.explode("items").alias("item"))
    inside = F.col("item.pos") % size
    steps = []
    for k in range(LEVELS):
        climbs = (F.col("n") > size) | (F.octet_length(f"l{k}") > WIDTH)
        steps.append(F.when(climbs, _beside(F.col(f"l{k}"), F.floor(inside / ARITY**k))))
    own = F.filter(F.array(*steps), lambda s: s.isNotNull())
    return rows.select("grp", "item.pos", "item.node", *[F.col("item").getField(p).alias(p) for p in payload], F.concat(own, "above").alias("path"), "top")


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], claims: Sequence[Column] | None = None) -> DataFrame:
    """One row per input row: ``id, leaf, path, subroot, root`` and ``claim``, digests as hexadecimal text in bytes.

    A leaf is the hash of ``fields`` (nulls are marked). The leaves of each group, ordered by id (null first; rows
    with one id by their hash), form a tree whose root is ``subroot``; the subroots, ordered by group (null first,
    then by UTF-8 bytes), form the tree of ``root``. ``path`` lists for each level what stands left and right of
    the node in its run, up to ``root``. ``claim`` is the leaf of the ``claims`` given in place of ``fields``, by default
    of the fields. Ids are whole numbers. Repeated rows are leaves of their own. Texts of any length are hashed whole.
    Other columns are ignored; an empty table gives an empty result.
    """
    columns = [named(f) for f in fields]
    leaf = row_digest(columns)
    claim = leaf if claims is None else row_digest(claims)
    group = F.coalesce(F.concat(F.lit("="), named(group_col).cast("string")), F.lit(""))  # keeps the order; nulls first
    packed = lambda c: F.unhex(c.cast("string"))  # noqa: E731 - 32 bytes travel, 64 are hashed
    leaves = docs.select(group.alias("grp"), named(id_col).cast("long").alias("id"), packed(leaf).alias("leaf"), packed(claim).alias("claim"))
    placed = positions(leaves, "grp", [F.asc_nulls_first("id"), F.col("leaf")])
    text = lambda c: F.lower(F.hex(c)).cast("binary")
    rows = climb(placed.select("grp", "pos", text("leaf").alias("node"), "n", "id", "claim"), ["id", "claim"])
    rows = settle(rows.withColumnRenamed("top", "subroot"))
    tops = positions(rows.groupBy("grp").agg(F.first("subroot").alias("node")).select(F.lit("").alias("all"), F.col("grp").alias("of"), "node"), "all", [F.col("of")])
    tops = climb(tops.select(F.col("all").alias("grp"), "pos", "node", "n", "of"), ["of"])
    tops = ready_side(tops.select("of", F.col("path").alias("over"), F.col("top").alias("root")), BROADCAST_GROUPS)
    met = rows.join(tops, F.col("grp") == F.col("of"))
    return met.select("id", F.col("node").alias("leaf"), text("claim").alias("claim"), F.concat("path", "over").alias("path"), "subroot", "root")


def siblings(path: Column) -> Column:
    """All digests beside a path, from the leaf to the root and left to right."""
    return F.aggregate(path, F.lit(b""), lambda found, s: F.concat(found, s["left"], s["right"]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))
