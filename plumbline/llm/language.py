"""Language identification by compression.

For each language, a sample of its texts is a raw-content dictionary of zstandard; a text belongs to the
language whose dictionary compresses it best. Texts are compressed in blocks, each from the dictionary
alone, so that a long text cannot become its own dictionary; the blocks cover the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import pack, unpack

UNKNOWN = "und"
#: Bounds of what is learned from: texts of a language, and the characters of each.
#: Many short parts of different texts: a copy of one of them gains little.
SAMPLE_TEXTS, SAMPLE_CHARS = 512, 100
#: Languages whose dictionaries (50 KB each) a task can hold; with more, learning fails rather than leave one out.
LANGUAGES = 2_000
#: Bytes of text that are compressed at once, and at least: below, zstandard stores instead of compressing.
BLOCK, LEAST = 4096, 256
#: The least difference between the best two, as a part of the best.
MARGIN = 0.005
LETTER = regex.compile(r"\p{L}")
#: ASCII other than letters.
NO_LETTER = bytes(c for c in range(128) if not chr(c).isalpha())
SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def held_out(id_: Column) -> Column:
    """Rows that nothing is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> bytes:
    """Lower case, with one blank for each run of ASCII characters that are no letters."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(SPACED).split())


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary per language, from ``SAMPLE_TEXTS`` of its texts (by hash of the id) outside the held-out rows.

    Every language is learned: what reaches the driver is bounded by languages times the sample. More than
    ``LANGUAGES`` of them are an error.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("id")))
    common = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if not common:
        return {}
    if len(common) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    # Four times the sample passes by hash, so what is ordered does not grow with the rows or partitions.
    reach = F.create_map(*[F.lit(x) for r in common for x in (r["lang"], min(1.0, 4 * SAMPLE_TEXTS / r["count"]))])
    key = F.xxhash64("id", "text")
    part = F.substring("text", 1, SAMPLE_CHARS)
    near = rows.where(F.pmod(key, F.lit(1 << 30)) < reach[F.col("lang")] * float(1 << 30))
    order = Window.partitionBy("lang").orderBy("key", "id", "part")
    near = near.select("lang", "id", key.alias("key"), part.alias("part"))
    sample = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_TEXTS)
    found: dict[str, list[tuple[int, str]]] = {}
    for r in sample.select("lang", "n", "part").collect():
        found.setdefault(r["lang"], []).append((r["n"], r["part"]))
    return {lang: b" ".join(letters(t) for _, t in sorted(parts)) for lang, parts in sorted(found.items())}


def classifier(dictionaries: Mapping[str, bytes]) -> Callable[[str | None], tuple[str, float, float]]:
    """A function from a text to its language, a score from 0 to 1 and the margin."""
    coders = []
    for lang, raw in sorted(dictionaries.items()):
        how = zstandard.ZstdCompressionParameters.from_level(
            9, source_size=BLOCK, dict_size=len(raw), write_content_size=False, strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=4
        )
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=how)
        coders.append((lang, zstandard.ZstdCompressor(compression_params=how, dict_data=known)))

    def classify(text: str | None) -> tuple[str, float, float]:
        if not coders or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        raw = letters(text)
        if len(raw) < LEAST:
            raw = b" ".join([raw] * (LEAST // (len(raw) + 1) + 1))
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in coders)
        best = sizes[0][0]
        weights = [2.0 ** -min((s - best) / len(blocks) / 4, 60.0) for s, _ in sizes]
        margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
        return sizes[0][1], 1.0 / sum(weights), margin

    return classify


def language_tagger(dictionaries: Mapping[str, bytes], margin: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = classifier(dictionaries)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column("text")]
            langs, scores, margins = zip(*found) if found else ((), (), ())
            added = [
                pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()),
                pa.array([lang == UNKNOWN or m < margin for lang, m in zip(langs, margins)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score", "margin", "rejected"])

    return tag


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per input row: the id, ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    Whole texts are read. A null text, a text without a letter, or no dictionary at all gives ``und`` with score 0;
    such rows are rejected, and those whose best two languages differ by less than ``margin``. With one language
    all texts are its own. Equal sizes go to the first language by name. Null ids and repeated rows are
    tagged like others. Other columns are ignored. An empty table gives an empty result.
    """
    base = pack(docs, id=id_col, text=text_col).select("id", "text")
    schema = f"id {dict(base.dtypes)['id']}, text string, lang_pred string, score double, margin double, rejected boolean"
    return base.mapInArrow(language_tagger(dictionaries, margin), schema).drop("text").withColumnRenamed("id", id_col)


def accept(docs: DataFrame, dictionaries: Mapping[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows that are not rejected, with their columns as they are."""
    base = pack(docs, id=id_col, text=text_col)
    found = StructType().add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")
    tagged = base.mapInArrow(language_tagger(dictionaries, margin), StructType([*base.schema.fields, *found.fields]))
    return unpack(tagged.where("NOT rejected"), docs.columns, id=id_col, text=text_col)
