"""Every query gives what SQL or brute force gives: on the small tables, on hostile ones and on empty ones."""

import hashlib
import zlib

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from plumbline.llm import language, token_counts
from plumbline.llm.queries import ORACLE, QUERIES
from tools.check import connect

SOURCES = ("sf", "hostile", "empty")


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("where", SOURCES)
def test_matches_sql(spark, request, where, name):
    folder = request.getfixturevalue(where)
    got = QUERIES[name](spark, folder)
    asked = connect(folder).execute(ORACLE[name])
    order = [d[0] for d in asked.description]
    assert sorted(order) == sorted(got.columns)
    assert rows(got, *order) == sorted(map(repr, asked.fetchall()))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, folder):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def rows(frame, *columns):
    return sorted(map(repr, (tuple(r) for r in frame.select(*columns).collect())))


@pytest.mark.parametrize("where", SOURCES)
def test_pieces_are_the_library_s(spark, request, where):
    folder = request.getfixturevalue(where)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, text in texts(spark, folder):
        ids = library.encode(text, add_eos=True)
        want.append(repr((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))))
    assert rows(QUERIES["op9_sentencepiece"](spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


@pytest.mark.parametrize("where", SOURCES)
def test_counts_after_edits_are_those_of_the_edited_text(spark, request, where):
    folder = request.getfixturevalue(where)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        coder: tiktoken.Encoding = token_counts.TokenCounter(file.read(), public_tokenizers.PATTERN).coder
    masks = [(token_counts.regex.compile(m), r) for m, r in token_counts.MASKS.items()]
    want = []
    for i, text in texts(spark, folder):
        first = token_counts.regex.compile("|".join(f"({m.pattern})" for m, _ in masks))
        edited, n = first.subn(lambda m: masks[m.lastindex - 1][1], text)
        want.append(repr((i, len(coder.encode_ordinary(text)), n, len(coder.encode_ordinary(edited)), sha(edited))))
    got = QUERIES["op5_token_counts"](spark, folder)
    assert rows(got, "doc_id", "n_tokens_before", "n_edits", "n_tokens", "edited_sha256") == sorted(want)
    if where == "sf":
        assert got.where("n_edits > 0").count() > 0 and got.where("n_recounted > 40 * n_edits").count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = found[found.held_out]
    assert len(held) > 150 and (held.lang_pred == held.lang).mean() > 0.98
    assert found.score.between(0, 1).all() and found.rejected.mean() < 0.02


@pytest.mark.parametrize("where", ("hostile", "empty"))
def test_languages_of_hostile_documents(spark, request, where):
    folder = request.getfixturevalue(where)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    classify = language.classifier(language.learn(docs))
    want = [repr((r["doc_id"], classify(r["text"])[0])) for r in docs.collect()]
    got = QUERIES["op10_language_id"](spark, folder)
    assert rows(got, "doc_id", "lang_pred") == sorted(want)
    assert got.where("held_out IS NULL OR score IS NULL OR lang_pred IS NULL").count() == 0


def test_nothing_is_learned_from_held_out_rows_or_their_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from pyspark.sql import functions as F

    blind = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert language.learn(blind) == language.learn(docs)
