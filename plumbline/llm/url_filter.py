"""Judges urls by host and path rules, and the rest by a weighted vocabulary.

Host, path and rule are column expressions. The vocabulary is matched by one Aho-Corasick automaton
per task, in Arrow batches: every occurrence between word boundaries counts for its term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, UPPER, fold, pack

#: host/path -> verdict, by the longest that fits.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
#: Terms of weight 1 are strict: one suffices. Lighter ones are soft.
VOCABULARY = {
    "adult": 1.0, "casino": 1.0, "escort": 1.0, "gambling": 1.0, "malware": 1.0, "phishing": 1.0, "poker": 1.0, "porn": 1.0,
    "sex": 1.0, "torrent": 1.0, "viagra": 1.0, "warez": 1.0, "xxx": 1.0,
    "ad": 0.5, "ads": 0.5, "affiliate": 0.5, "banner": 0.5, "bet": 0.5, "cheap": 0.5, "click": 0.5, "coupon": 0.5, "crack": 0.5, "deal": 0.5,
    "download": 0.5, "free": 0.5, "promo": 0.5, "redirect": 0.5, "track": 0.5, "tracker": 0.5, "win": 0.5,
}
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_of(url: Column) -> Column:
    return fold(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule whose host is the host or a parent of it, and whose path begins the path; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), len(r.split("/")[0]))):  # later, longer ones win
        of, at, below = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(at + below))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def vocabulary_counter(weights: Mapping[str, float], min_soft: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to each row with a ``url``: strict and soft occurrences, distinct soft terms, their weight, the verdict."""
    weights = dict(weights)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        lower = str.maketrans(UPPER, LOWER)
        for batch in batches:
            rows: list[tuple[int, int, int, float, bool]] = []
            for url in batch.column("url").to_pylist():
                text = (url or "").translate(lower)
                strict, soft, kinds = 0, 0, set()
                for end, term in automaton.iter(text):
                    start = end - len(term)
                    if (start >= 0 and text[start] in LETTERS) or (end + 1 < len(text) and text[end + 1] in LETTERS):
                        continue
                    if weights[term] >= 1:
                        strict += 1
                    else:
                        soft += 1
                        kinds.add(term)
                heavy = sum(weights[t] for t in sorted(kinds))
                rows.append((strict, soft, len(kinds), heavy, strict > 0 or (len(kinds) >= min_soft and heavy >= 1)))
            columns = list(zip(*rows)) or [()] * 5
            added = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()))]
            names = ["strict_hits", "soft_hits", "soft_terms", "soft_weight", "rejected"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return count


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Mapping[str, str] = RULES,
                weights: Mapping[str, float] = VOCABULARY, min_soft: int = 2) -> DataFrame:
    """One row per input row: the id, ``host``, ``path``, ``rule``, ``verdict`` and what the vocabulary counted.

    A rule decides where one fits; elsewhere a url is blocked on one strict term, or on ``min_soft`` distinct
    soft terms that weigh 1 together. Terms count between characters other than a-z and 0-9, in the whole url
    with A-Z lower-cased. A null url or one without ``://`` has an empty host and path, and a null url has no terms:
    it is allowed. Null ids and repeated rows are judged like others. Other columns are ignored.
    """
    base = pack(pages, id=id_col, url=url_col).select("id", "url")
    schema = "id " + dict(base.dtypes)["id"] + ", url string, strict_hits long, soft_hits long, soft_terms long, soft_weight double, rejected boolean"
    counted = base.mapInArrow(vocabulary_counter(weights, min_soft), schema)
    parts = counted.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = parts.withColumn("rule", best_rule(F.col("host"), F.col("path"), list(rules)))
    decided = F.lit(None).cast("string")
    for rule, what in rules.items():
        decided = F.when(F.col("rule") == rule, F.lit(what)).otherwise(decided)
    verdict = F.coalesce(decided, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.select(
        F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "strict_hits", "soft_hits", "soft_terms", "soft_weight"
    )
