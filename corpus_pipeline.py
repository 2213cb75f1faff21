"""A corpus from raw documents: language, shared lines, near copies, mixing, tokens.

Every stage takes all that its predecessor kept. Its result is written to the shared folder and read again, so a
lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import language
from plumbline.llm.jaccard import keep_one_of_each
from plumbline.llm.line_dedup import drop_shared_lines
from plumbline.llm.mixing import sample_mix
from plumbline.llm.pieces import encode_pieces
from plumbline.session import drop_path, release, scratch_path

#: No SQL expresses compression or piece encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not in doubt."""
    return language.accept(docs, language.learn(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another keeps."""
    return drop_shared_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return sample_mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of what they decode to."""
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, behind = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if behind:
            drop_path(spark, behind)
        behind = path
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
