"""Token counts that follow edits.

A document is cut into pre-tokens; a segment tree over them sums characters and tokens. An edit is found by
descending the character sums. Only the pre-tokens it touches, those before it whose cut could look as far, and
those after it up to the next common cut are encoded again; the sums above them are updated.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Mapping
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pack

#: White space as the tokenizer's pattern means it (Python's own \\s has four controls more).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Characters beyond its end that a pre-token's cut depends on.
AHEAD = 2
REMEMBERED = 300_000
#: Personal data and what takes its place (fixed order: the first that matches wins).
MASKS = {
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}": "[email]",
    r"\+?\d[\d ().-]{7,}\d": "[number]",
}
#: What every match of a mask holds.
NEEDED = {next(iter(MASKS)): "@"}
EDITS = "array<struct<start:int,stop:int,text:string>>"
SLICE = 4 << 20


class TokenCounter(dict):
    """Tokens of each pre-token, counted when first asked for."""

    def __init__(self, ranks: bytes, pattern: str):
        super().__init__()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.coder = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        inside = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
        self.cut = regex.compile(inside).findall

    def __missing__(self, piece: str) -> int:
        n = len(self.coder._encode_single_piece(piece))
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = n
        return n


class CountedText:
    """A text with the segment tree of its pre-tokens, built at the first edit. After edits a leaf may hold several, or none."""

    def __init__(self, text: str, counter: TokenCounter):
        self.counter, self.recounted, self.leaves = counter, 0, []
        self.pieces = counter.cut(text)
        self.n_chars, self.n_tokens = len(text), sum(map(counter.__getitem__, self.pieces))

    def _build(self) -> None:
        counter = self.counter
        self.leaves: list[list[str]] = [[p] for p in self.pieces] or [[]]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        chars, tokens = np.zeros(2 * self.base, np.int64), np.zeros(2 * self.base, np.int64)
        for sums, of in ((chars, len), (tokens, counter.__getitem__)):
            sums[self.base : self.base + len(self.leaves)] = [sum(map(of, leaf)) for leaf in self.leaves]
            low = self.base
            while low > 1:
                sums[low // 2 : low] = sums[low : 2 * low : 2] + sums[low + 1 : 2 * low : 2]
                low //= 2
        self.chars, self.tokens = chars.tolist(), tokens.tolist()

    def text(self) -> str:
        return "".join(p for leaf in self.leaves for p in leaf) if self.leaves else "".join(self.pieces)

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where that leaf begins (the last leaf with text, for the end)."""
        if not self.n_chars:
            return 0, 0
        at, node, start = min(at, self.n_chars - 1), 1, 0
        while node < self.base:
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def _set(self, leaf: int, pieces: list[str]) -> None:
        self.leaves[leaf] = pieces
        node = leaf + self.base
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(map(self.counter.__getitem__, pieces))
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.n_chars, self.n_tokens = self.chars[1], self.tokens[1]

    def edit(self, start: int, stop: int, text: str) -> None:
        """Puts ``text`` in place of the characters from ``start`` to ``stop`` (clipped to what there is)."""
        if not self.leaves:
            self._build()
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        first, begins = self._leaf_at(max(start - AHEAD, 0))
        last, _ = self._leaf_at(stop)
        more = 4
        while True:
            until = min(last + more, len(self.leaves) - 1)
            old = "".join(p for leaf in self.leaves[first : until + 1] for p in leaf)
            new = old[: start - begins] + text + old[stop - begins :]
            grown, whole = len(new) - len(old), until == len(self.leaves) - 1
            ends, at = {}, 0
            for i in range(first, until + 1):
                at += sum(map(len, self.leaves[i]))
                if at >= stop - begins:
                    ends.setdefault(at + grown, i)
            pieces, at, n = self.counter.cut(new), 0, 0
            common = None
            for n, piece in enumerate(pieces, 1):
                at += len(piece)
                if at in ends and at >= start - begins + len(text) and (whole or at + AHEAD <= len(new)):
                    common = ends[at]
                    break
            if common is None and whole:
                common, n = until, len(pieces)
            if common is not None:
                break
            more *= 4
        self.recounted += n
        self._set(first, pieces[:n])
        for i in range(first + 1, common + 1):
            if self.leaves[i]:
                self._set(i, [])


class Masks:
    """Finds what the masks match, and gives it as edits: last first, so that positions hold.

    A mask is only looked for where a text holds what all its matches do.
    """

    def __init__(self, masks: Mapping[str, str]):
        self.masks, self.kept = dict(masks), {}

    def edits(self, text: str) -> list[tuple[int, int, str]]:
        able = tuple(m for m in self.masks if NEEDED.get(m, "") in text)
        if able not in self.kept:
            self.kept[able] = re.compile("|".join(f"({m})" for m in able)).finditer if able else lambda _: ()
        return [(m.start(), m.end(), self.masks[able[m.lastindex - 1]]) for m in self.kept[able](text)][::-1]


def masking_edits(masks: Mapping[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``edits``: every match of a mask is replaced, last first, so that positions hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Masks(masks)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            found = [[dict(zip(("start", "stop", "text"), e)) for e in finder.edits(t.as_py() or "")] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "edits"])

    return run


def _counter(ranks: bytes, pattern: str) -> TokenCounter:
    kept = vars(tiktoken).setdefault("_token_counters", {})  # a worker's later tasks find what it remembers
    if (ranks, pattern) not in kept:
        kept.clear()
        kept[ranks, pattern] = TokenCounter(ranks, pattern)
    return kept[ranks, pattern]


def masked_counter(ranks: bytes, pattern: str, masks: Mapping[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over ``id, text``: counts before and after the edits that mask, and the digest of the edited text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, finder = _counter(ranks, pattern), Masks(masks)
        names = ["n_tokens_before", "n_edits", "n_recounted", "n_tokens", "edited_sha256"]
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                counted, edits = CountedText(text, counter), finder.edits(text)
                before = counted.n_tokens
                for e in edits:
                    counted.edit(*e)
                edited = counted.text() if edits else text
                rows.append((before, len(edits), counted.recounted, counted.n_tokens, sha256(edited.encode()).hexdigest()))
            columns = zip(zip(*rows) if rows else [()] * 5, [pa.int64()] * 4 + [pa.string()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in columns)], names=["id", *names])

    return run


def edit_counter(ranks: bytes, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks, pattern)
        names = ["id", "n_tokens_before", "n_edits", "n_recounted", "n_tokens", "edited"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows, start, used = [], 0, 0
            for i, (text, edits) in enumerate(zip(batch.column("text"), batch.column("edits"))):
                counted = CountedText(text.as_py() or "", counter)
                before = counted.n_tokens
                todo = [e for e in edits.as_py() or [] if e and e["start"] is not None and e["stop"] is not None]
                for e in todo:
                    counted.edit(e["start"], e["stop"], e["text"] or "")
                rows.append((before, len(todo), counted.recounted, counted.n_tokens, counted.text()))
                used += counted.n_chars
                if used > SLICE or i == batch.num_rows - 1:
                    ids = batch.column("id").slice(start, len(rows))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=names)
                    rows, start, used = [], i + 1, 0

    return run


def mask_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", masks: Mapping[str, str] = MASKS) -> DataFrame:
    """``id, text, edits``: the edits that mask personal data. A null text has none."""
    base = pack(docs, id=id_col, text=text_col).select("id", "text")
    return base.mapInArrow(masking_edits(masks), f"id {dict(base.dtypes)['id']}, text string, edits {EDITS}")


def count_after_edits(edited: DataFrame, ranks_path: str, pattern: str, id_col: str = "id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """One row per input row: the id, ``n_tokens_before``, ``n_edits``, ``n_recounted`` (pre-tokens encoded again),
    ``n_tokens`` and the ``edited`` text.

    Edits (start, stop, text; in characters) apply in the order of the array, each to the text as the ones before
    left it; positions are clipped to the text, a null replacement is empty, and an edit without positions is
    none. A null text is empty. Null ids and repeated rows are counted like others. Other columns are ignored.
    """
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    base = edited.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))
    schema = f"id {dict(base.dtypes)['id']}, n_tokens_before long, n_edits long, n_recounted long, n_tokens long, edited string"
    return base.mapInArrow(edit_counter(ranks, pattern), schema).withColumnRenamed("id", id_col)


def count_masked(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", masks: Mapping[str, str] = MASKS) -> DataFrame:
    """``mask_edits`` and ``count_after_edits`` in one pass, with ``edited_sha256`` in place of the edited text."""
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    base = pack(docs, id=id_col, text=text_col).select("id", "text")
    schema = f"id {dict(base.dtypes)['id']}, n_tokens_before long, n_edits long, n_recounted long, n_tokens long, edited_sha256 string"
    return base.mapInArrow(masked_counter(ranks, pattern, masks), schema).withColumnRenamed("id", id_col)
