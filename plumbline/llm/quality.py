"""Host-level quality rules, in DataFrame functions only.

Every document is measured and judged by a few rules; failures are summed by host; a beta prior fitted to
all hosts (method of moments) shrinks the rates of hosts with few documents; hosts whose shrunk
rate is too high for any rule are rejected, and their verdict is joined back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, WORD, ready_side, settle, words

SYMBOLS = "#*$%&|<>"
#: Rule: when a document fails it.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "dup_lines": "2 * n_dup_lines > n_word_lines",
}
#: Hosts that are broadcast at most.
BROADCAST_ROWS = 10_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(found: Column, n: int = 3) -> Column:
    """Words covered by windows of ``n`` words that occur twice or more in the array of words.

    Window hashes are sorted with their positions: equal neighbours are repeats, and the sorted
    positions of repeats are covered up to the next one or the window's length.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - n), lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(n)])
    )

    def positions(order: Column) -> Column:
        same = lambda x, j: (x["h"] == F.get(order, j - 1)["h"]) | (x["h"] == F.get(order, j + 1)["h"])
        return F.sort_array(F.transform(F.filter(order, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(n), F.coalesce(F.get(at, j + 1) - p, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        full = _let(_let(F.sort_array(pairs), positions), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(full)

    return F.when(F.size(found) <= n, F.lit(0)).otherwise(_let(windows, counted)).cast("long")


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``id, host`` and the measures of each row; a null text measures 0 throughout."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text.alias("text"))
    split = base.select("id", "host", "text", words(F.col("text")).alias("words"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    length = lambda cut: F.char_length(F.translate("text", cut, ""))
    return split.select(
        "id", "host", F.size("words").cast("long").alias("n_words"), length(BLANKS).cast("long").alias("word_chars"),
        (F.char_length("text") - length(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_word_lines"), repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """One row per host: ``host, docs`` and the shrunk failure rate ``rate_<rule>`` of each rule."""
    fails = [F.sum(F.col(f"fails_{r}").cast("int")).alias(f"sum_{r}") for r in RULES]
    hosts = settle(judged.groupBy("host").agg(F.count("*").alias("docs"), *fails))
    moments = [F.sum(f"sum_{r}").alias(f"all_{r}") for r in RULES]
    moments += [F.sum(F.col(f"sum_{r}") * F.col(f"sum_{r}") / F.col("docs")).alias(f"square_{r}") for r in RULES]
    total = hosts.agg(F.count("*").alias("hosts"), F.sum("docs").alias("docs"), *moments).first()
    rates = []
    for r in RULES:
        a, b = beta_prior(total["hosts"], total["docs"] or 0, total[f"all_{r}"] or 0, total[f"square_{r}"] or 0.0)
        rates.append(((F.col(f"sum_{r}") + F.lit(a)) / (F.col("docs") + F.lit(a + b))).alias(f"rate_{r}"))
    return hosts.select("host", "docs", *rates)


def beta_prior(hosts: int, docs: int, fails: int, squares: float) -> tuple[float, float]:
    """Beta parameters from the mean and the spread of failure rates between hosts, weighted by documents.

    The spread is what remains after the sampling noise of each rate. Without any (or with one host), the
    prior is as strong as all documents: hosts are taken to be alike. It is never weaker than one document.
    """
    if not docs:
        return 0.5, 0.5
    mean = fails / docs
    noise = mean * (1 - mean)
    spread = squares / docs - mean * mean - noise * (hosts - 1) / docs
    strength = min(max(noise / spread - 1, 1.0), float(docs)) if spread > 0 else float(docs)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = 0.5) -> DataFrame:
    """One row per input row: the id, the measures, ``base_failed``, ``host_failed`` and ``kept``.

    A host is rejected when the shrunk rate of any rule exceeds ``max_rate``. A null or empty text has no
    words and fails; a null host is a host of its own; null ids and repeated rows are judged like
    others, each in a row of its own. Other columns are ignored. An empty table gives an empty result.
    """
    measured = measure(docs, id_col, text_col, host_col)
    judged = settle(measured.select("*", *[F.expr(cond).alias(f"fails_{r}") for r, cond in RULES.items()]))
    hosts = host_rates(judged).select(F.col("host").alias("of"), F.greatest(*[F.col(f"rate_{r}") for r in RULES]).alias("host_rate"))
    found = judged.join(ready_side(hosts, BROADCAST_ROWS), F.col("host").eqNullSafe(F.col("of")))
    base, bad = F.col("fails_short") | F.col("fails_repetitive"), F.col("host_rate") > max_rate
    return found.select(
        F.col("id").alias(id_col), *MEASURES, base.alias("base_failed"), bad.alias("host_failed"), (~base & ~bad).alias("kept")
    )
