"""The operators' registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from plumbline.llm import language, oracles
from plumbline.llm.common import WORD, fold, table
from plumbline.llm.jaccard import similar_classes
from plumbline.llm.line_dedup import dedup_lines
from plumbline.llm.merkle import digest, folded, manifest, siblings
from plumbline.llm.mixing import mix
from plumbline.llm.near_vectors import near_vectors
from plumbline.llm.pieces import piece_digests
from plumbline.llm.quality import judge
from plumbline.llm.resample import resample
from plumbline.llm.token_counts import count_masked
from plumbline.llm.tool_calls import link_calls
from plumbline.llm.topk import top_k
from plumbline.llm.url_filter import filter_urls

PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_masked(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return counted


#: What assistant turns are taken to call, by the parity of their exchange.
TOOLS = {
    name: {
        "type": "object",
        "required": ["n_words", "query"],
        "properties": {"n_words": {"type": "integer", "minimum": 1, "maximum": most}, "query": {"type": "string", "minLength": 1}},
        "additionalProperties": False,
    }
    for name, most in (("search", 40), ("answer", 1_000_000))
}


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn as a call, every user turn after the first as the result of the call before it.

    A call depends on the one of the exchange before, through the whole conversation.
    """
    talk = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    exchange = F.floor(F.col("turn") / 2)
    n_words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    calls = talk.where("role = 'assistant'").select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.when(exchange % 2 == 0, "search").otherwise("answer").alias("name"),
        F.to_json(F.struct(F.col("text").alias("query"), n_words.alias("n_words"))).alias("arguments"),
        F.array(name(F.col("turn") - 2)).alias("depends_on"),
    )
    results = talk.where("role = 'user' AND turn > 0").select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return link_calls(calls, results, TOOLS)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagged = language.identify(docs, language.learn(docs))
    return tagged.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against claims that lower-case the text where 3 divides the checksum of the id."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    claims = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [F.when(tampered, fold(F.col("text"))).otherwise(F.col("text"))]
    rows = manifest(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], claims)
    reached = rows.withColumn("folded_root", folded(F.col("claim"), F.col("path"))).withColumn("proof_sha256", digest(siblings(F.col("path"))))
    hashes = [F.col(c).cast("string").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return reached.select(F.col("id").alias("doc_id"), *hashes, (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_url_filters,
        op3_line_dedup,
        op4_jaccard_join,
        op5_token_counts,
        op6_chat_formatting,
        op7_mixing,
        op8_top_k,
        op9_sentencepiece,
        op10_language_id,
        op11_embedding_dedup,
        op12_merkle_manifest,
        op13_importance_resampling,
    )
}
ORACLE: dict[str, str] = {
    "op1_quality_rules": oracles.QUALITY,
    "op2_url_filters": oracles.URL_FILTERS,
    "op3_line_dedup": oracles.LINE_DEDUP,
    "op4_jaccard_join": oracles.JACCARD,
    "op6_chat_formatting": oracles.CHAT,
    "op7_mixing": oracles.MIXING,
    "op8_top_k": oracles.TOP_K,
    "op11_embedding_dedup": oracles.NEAR_VECTORS,
    "op12_merkle_manifest": oracles.MERKLE,
    "op13_importance_resampling": oracles.RESAMPLE,
}
