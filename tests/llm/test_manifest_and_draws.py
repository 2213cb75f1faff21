"""The Merkle manifest, importance resampling and the forest of near copies against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm.merkle import folded, manifest, siblings
from plumbline.llm.near_vectors import near_vectors
from plumbline.llm.ranks import positions
from plumbline.llm.resample import _pieces, feature_buckets, resample


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each node what stands left and right of it on its way up."""
    at, ways = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for way, i in zip(ways, at):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            way.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        nodes, at = [sha("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], ways


@pytest.mark.parametrize("sizes", [(1,), (8,), (9,), (513,), (512, 1, 4105), (65, 3, 1, 1, 1, 1, 1, 1, 1)])
def test_manifest_is_the_tree_of_each_group(spark, sizes):
    rows = [(10_000 * g - i, None if g == 0 else f"g{g}", f"text {g} {i}") for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "id long, grp string, node string")
    changed = F.when(F.col("id") % 5 == 0, F.lit("other")).otherwise(F.col("node"))
    found = manifest(docs, "id", "grp", ["id", "node"], [F.col("id"), changed])
    text = lambda c: F.col(c).cast("string").alias(c)
    found = found.withColumn("beside", siblings(F.col("path"))).withColumn("reached", folded(F.col("claim"), F.col("path")))
    got = {r["id"]: tuple(r)[1:] for r in found.select("id", text("leaf"), text("subroot"), text("root"), text("beside"), text("reached")).collect()}
    assert len(got) == len(rows)
    groups = {}
    for i, g, t in sorted(rows):
        groups.setdefault(g or "", []).append((i, sha(f"{len(str(i))}:{i}{len(t)}:{t}")))
    trees = {g: tree([h for _, h in members]) for g, members in groups.items()}
    root, above = tree([trees[g][0] for g in sorted(groups)])
    for g, over in zip(sorted(groups), above):
        for (i, leaf), way in zip(groups[g], trees[g][1]):
            beside = "".join(a + b for a, b in way + over)
            assert got[i][:4] == (leaf, trees[g][0], root, beside)
            assert (got[i][4] == root) == (i % 5 != 0)


def test_positions_count_each_group_from_zero(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 37 % 50, i) for i in range(900)] + [("same", 1, 1)] * 60
    got = positions(spark.createDataFrame(rows, "grp string, v int, i int").repartition(7), "grp", [F.desc("v"), F.col("i")]).collect()
    groups = {}
    for g, v, i in sorted(rows, key=lambda r: (r[0], -r[1], r[2])):
        groups.setdefault(g, []).append((v, i))
    assert sorted((r["grp"], r["pos"], r["v"], r["i"], r["n"]) for r in got) == sorted((g, k, *x, len(m)) for g, m in groups.items() for k, x in enumerate(m))


@pytest.mark.parametrize("sizes", [1, 2, 3])
def test_draws_of_word_runs(spark, sf, sizes):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(80).collect()]  # a small fixture for brute force
    docs += [(None, "one two three four"), (900, None), (901, ""), (902, "\x00 Ünï-cödé {x} " * 9), (903, "Aa_b9" * 40)]
    target = [(f"goal {t}",) for _, t in docs[::9] if t]
    grams = lambda t: [" ".join(w[i : i + n]) for w in [words(t)] for n in range(1, sizes + 1) for i in range(len(w) - n + 1)]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bucket = lambda g: zlib.crc32(g.encode()) % 500
    s, t = (Counter(bucket(g) for _, x in side for g in grams(x)) for side in (docs, [(0, x) for (x,) in target]))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 500) / ((s[b] + 1) * (t.total() + 500)))) for b in range(500)]
    want = []
    for i, x in docs:
        weight, h = sum(gain[bucket(g)] for g in grams(x)), int(sha(f"7:{'' if i is None else i}")[:8], 16)
        want.append((i, len(words(x)), len(grams(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((w for w in want if w[1] >= 20), key=lambda w: (-w[4], w[0] or -1))
    rank = {w[0]: k for k, w in enumerate(able[: 25 * len(able) // 100], 1)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample(frame, spark.createDataFrame(target, "text string"), percent=25, sizes=sizes, buckets=500, seed=7)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((*w, rank.get(w[0]))) for w in want)


def test_words_of_texts_in_pieces(monkeypatch):
    """A batch with more text than one piece: the texts of each piece are those of the batch."""
    monkeypatch.setattr("plumbline.llm.resample.PIECE", 50)
    texts = [None, "One two, Three", "", "Ünï-cödé É x" * 9, "A b c", None, "\x00last ONE é", "a" * 70, "b B b"] * 3
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    pieces = list(_pieces(pa.array(texts, pa.string())))
    got = [found for piece in pieces for found in feature_buckets(piece, 1, 10_000)]
    assert len(pieces) > 3
    assert np.concatenate([counts for _, counts in got]).tolist() == [len(w) for w in words]
    assert np.concatenate([found for found, _ in got]).tolist() == [zlib.crc32(w.encode()) % 10_000 for t in words for w in t]


def near_rows(seed: int) -> list[tuple]:
    """A hot label with a dense group, pairs at different cosines, copies, and labels of few rows."""
    rng = np.random.default_rng(seed)
    base, rows = rng.normal(size=(700, 24)), []
    rows += [(v, "hot") for v in base]
    rows += [(base[0] + rng.normal(size=24) * 0.12, "hot") for _ in range(300)]
    for k in range(1, 200):
        rows.append((base[k] * 3 + rng.normal(size=24) * 3 * (0.05 + 0.35 * k / 200), "hot"))
    rows += [(base[k], "hot") for k in range(300, 340) for _ in range(1 + k % 3)]
    rows += [(v, f"l{k % 9}") for k, v in enumerate(rng.normal(size=(90, 24)))] + [(base[5], "l1"), (base[5], None)]
    return [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]


def brute_links(rows, least=0.93):
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    labels = np.array([r[2] or f"none{r[0]}" for r in rows])
    return (v @ v.T >= least) & (labels[:, None] == labels[None, :]) & ~np.eye(len(rows), dtype=bool)


def component_ids(links):
    found = np.arange(len(links))
    for first in range(len(links)):
        front = [first] if found[first] == first else []
        while len(front):
            found[front] = first
            front = np.flatnonzero(links[front].any(axis=0) & (found > first))
    return found


@pytest.mark.parametrize("leaf_rows", [2048, 256])
def test_forest_finds_the_links(spark, leaf_rows):
    rows = near_rows(3)
    links = brute_links(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("rep", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in near_vectors(frame, leaf_rows=leaf_rows).collect()}
    found = np.array([got[i][0] for i in range(len(rows))])
    want = links.sum(axis=1)
    assert (found <= want).all() and found.sum() >= (0.97 if leaf_rows < 2048 else 1) * want.sum()
    assert (np.array([got[i][1] for i in range(len(rows))]) == component_ids(links)).mean() > 0.995
    assert all(kept == (component == i) for i, (_, component, kept) in got.items())


def test_forest_takes_hostile_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, "a"), (1, [], "a"), (2, [0.0, 0.0], "a"), (3, [nan, 1.0], "a"), (4, [inf, 1.0], "a"), (5, [None, 1.0], "a"), (6, [1e308, 1e308], "a"), (7, [1e-300, 1e-300], "a"),
            (8, [1.0, 1.0, 0.0], "a"), (9, [1.0, 1.0], None), (None, [1.0, 1.0], "a"), (10, [1.0, -1.0], "a"), (10, [2.0, -2.0], "a"), (11, [1.0, 1.0], "a"), (11, [-1.0, 1.0], "a"), (6, [1e308, 1e308], "a")]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    alone = [(i, 0, i, True) for i in (0, 1, 2, 3, 4, 5, 8, 9)] + [(None, 0, None, True), (10, 1, 10, True), (10, 1, 10, True)]
    linked = [(6, 3, 6, True)] * 2 + [(7, 3, 6, False), (11, 3, 6, False), (11, 0, 6, False)]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, alone + linked))
