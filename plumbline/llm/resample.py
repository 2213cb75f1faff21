"""Importance resampling: documents drawn by how much likelier their words are in a target than in the corpus.

Features are hashed word n-grams. Texts of a batch become one array of words, and words become the indices of a
dictionary; shifted against themselves, these form n-grams, and only distinct ones are hashed. What is learned is a
number for each bucket; a document's weight is the sum over its features.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import named, settle
from plumbline.llm.ranks import positions

#: What separates words, after ASCII letters are lower-cased: ASCII other than digits and small letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that are taken apart at once (a longer text is taken alone).
PIECE = 8 << 20
SCORED = "id long, n_words long, n_features long, weight long"


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + PIECE, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def word_indices(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of each word of all texts, and the number of words of each text."""
    low = pc.ascii_lower(texts).cast(pa.large_string())  # lowered first: Arrow lowers a cast slice from its parent's beginning on
    parts = pc.split_pattern_regex(low, SEPARATORS)
    lengths = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(parts)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False).astype(bool)  # a separator at an end leaves an empty part
    owner = np.repeat(np.arange(len(texts)), lengths)[full]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy().astype(np.int64), np.bincount(owner, minlength=len(texts))


def feature_buckets(texts: pa.Array, sizes: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size up to ``sizes``: the bucket of every n-gram, text by text, and the number of n-grams of each text."""
    names, codes, counts = word_indices(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    grams, words = names, codes
    for size in range(1, sizes + 1):
        if size > 1:  # a pair of an (n-1)-gram and the word after it, where both are of one text
            left, right = codes[:-1], words[size - 1 :]
            within = owner[: len(left)] == owner[size - 1 :]
            left, right = left[within], right[within]
            pairs, codes_within = np.unique(left * max(len(names), 1) + right, return_inverse=True)
            grams = [grams[int(p) // len(names)] + b" " + names[int(p) % len(names)] for p in pairs]
            codes = np.full(len(within), -1)
            codes[within] = codes_within
        hashed = np.fromiter((zlib.crc32(g) % buckets for g in grams), np.int64, len(grams))
        here = codes >= 0
        yield hashed[codes[here]], np.bincount(owner[: len(codes)][here], minlength=len(texts))


def bucket_counts(sizes: int, buckets: int):
    """Over batches of ``text``: ``bucket, n`` of the whole partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _pieces(batch.column("text")):
                for found, _ in feature_buckets(texts, sizes, buckets):
                    total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return run


def count_buckets(texts: DataFrame, sizes: int, buckets: int) -> np.ndarray:
    """Features of all rows of ``text`` by bucket: what reaches the driver is a number for each bucket."""
    found = texts.mapInArrow(bucket_counts(sizes, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in found.collect():
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source for each bucket, with one more feature in each, rounded down."""
    buckets, of_source, of_target = len(source), float(source.sum()), float(target.sum())
    gain = lambda s, t: math.floor(1000 * math.log((t + 1.0) * (of_source + buckets) / ((s + 1.0) * (of_target + buckets))))
    return np.array([gain(float(s), float(t)) for s, t in zip(source, target)], np.int64)


def text_weights(gains: np.ndarray, sizes: int):
    """Over batches of ``id, text``: words, features and the sum of gains of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for texts in _pieces(batch.column("text")):
                n, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for size, (found, counts) in enumerate(feature_buckets(texts, sizes, len(gains))):
                    words += [counts] if size == 0 else []
                    n += counts
                    sums = np.concatenate([[0], np.cumsum(gains[found])])
                    ends = np.cumsum(counts)
                    weight += sums[ends] - sums[ends - counts]
                features.append(n)
                weights.append(weight)
            columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_words", "n_features", "weight"])

    return run


def noise(id_: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw for each id, rounded down; a null id counts as an empty text."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(key, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(share))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 10, least_words: int = 20,
    sizes: int = 1, buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """One row per input row: ``id, n_words, n_features, weight, score, rank``.

    A document's weight is the sum of its features' gains; its score adds a draw that depends on the seed and the id alone.
    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down) with the highest scores
    are drawn without replacement: their ranks are 1, 2, ...; ties go to the smaller id (null first), then by weight and
    features. The other rows have no rank. A null text has no words and weight 0. Rows that repeat an id have the same draw.
    Whole texts are read, of both tables. Ids are whole numbers. Other columns are ignored; without any target text all
    target counts are 0, and an empty table gives an empty result.
    """
    base = docs.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("text"))
    counts = [count_buckets(df.select("text"), sizes, buckets) for df in (base, target.select(named(text_col).cast("string").alias("text")))]
    scored = base.mapInArrow(text_weights(bucket_gains(*counts), sizes), SCORED)
    scored = settle(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    able = F.col("n_words") >= least_words
    ranked = positions(scored.where(able).withColumn("all", F.lit("")), "all", [F.desc("score"), F.asc_nulls_first("id"), F.col("weight"), F.col("n_features")])
    drawn = F.col("pos") < F.floor(F.lit(percent) * F.col("n") / 100)
    ranked = ranked.withColumn("rank", F.when(drawn, F.col("pos") + 1))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    columns = ["id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(rest.select(columns))
