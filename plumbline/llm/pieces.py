"""SentencePiece encoding of merge-type models, and decoding.

A text is encoded without merging it: pieces that match are found by Aho-Corasick, the longest is tried
first at each position, a piece may follow another only if merging the two together gives just these two, and
positions that led nowhere are remembered in a bit field. The result is what merging by score gives. Pieces
never cross from a word into the blank after it, so a text falls into chunks that are encoded apart and remembered.
"""

from __future__ import annotations

import heapq
import re
from hashlib import sha256
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pack

BLANK = "▁"
#: Chunks and pairs that a task remembers, and the longest chunk it does.
REMEMBERED, LONGEST = 400_000, 48
#: A match is its length above these bits and the id of its piece in them; ALONE stands for no piece.
ID_BITS, ALONE = 24, (1 << 24) - 1
NO_PIECE = 1 << ID_BITS | ALONE
#: Bytes of text whose tokens are returned at once.
SLICE = 4 << 20


class _Chunks(dict):
    """Coded chunks, made when first asked for. When full, those asked for since the last time stay."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, chunk: str):
        made = self.old.get(chunk)
        if made is None:
            made = self.make(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED // 2:
                self.old = dict(self)
                self.clear()
            self[chunk] = made
        return made


class PieceCoder:
    """Encodes and decodes with the pieces of a model; the library only reads the file."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.surface: list[bytes] = []
        self.byte_ids = [vocabulary.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        of_byte = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        for i in range(len(vocabulary)):
            piece = vocabulary.id_to_piece(i)
            if vocabulary.is_byte(i):
                self.surface.append(of_byte[i])
            elif vocabulary.is_control(i):
                self.surface.append(b"")
            elif vocabulary.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.surface.append(piece.replace(BLANK, " ").encode())
        self.end = vocabulary.eos_id()
        self.score = {p: vocabulary.get_score(i) for p, i in self.ids.items()}
        self.opens = {i for p, i in self.ids.items() if p.startswith(BLANK)}
        self.automaton = ahocorasick.Automaton()
        several = [p for p in self.ids if len(p) > 1]  # characters are looked up
        for p in several or self.ids:
            if p:
                self.automaton.add_word(p, len(p) << ID_BITS | self.ids[p])
        self.automaton.make_automaton()
        self.single = {p: 1 << ID_BITS | i for p, i in self.ids.items() if len(p) == 1}
        self.names = {i: p for p, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}
        self.decimal = [b"%d " % i for i in range(len(vocabulary))]
        self.chunks = _Chunks(self._encode_chunk)
        self.words = _Chunks(self._spell_word)
        self.spelled = _Chunks(lambda chunk: self._spelled(self.chunk_ids(chunk)))
        crossing = re.compile(f"[^{BLANK}]{BLANK}|\n")
        whole = any(crossing.search(p) for p in self.ids)
        self.apart = not whole
        self.split = re.compile(r"(?s).+" if whole else f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = {p: order[s] if len(p) > 1 else -1 for p, s in self.score.items()}
        self.halves: dict[str, tuple[str, str] | None] = {}

    def merge(self, text: str, until: str = "") -> list[str]:
        """The definition: the best-scored neighbours that form a piece are joined, leftmost first, until none are left.

        With ``until``, the last two parts are left apart when their merge would give it.
        """
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                both = parts[i] + parts[after[i]]
                if both in self.score:
                    heapq.heappush(queue, (-self.score[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            if both == until:
                break
            j = after[i]
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def made_of(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge ends a piece; none for a piece that merging never gives (a character: itself twice)."""
        if piece not in self.halves:
            parts = [piece] if len(piece) == 1 else self.merge(piece, until=piece)
            self.halves[piece] = (piece, piece) if len(piece) == 1 else tuple(parts) if len(parts) == 2 else None
        return self.halves[piece]

    def follows(self, one: str, two: str) -> bool:
        """Whether merging the two together gives just these two; with an empty first, whether it gives the second at all.

        The merges of both are taken back, latest first: a merge across their border that would have come
        before one just taken back (or at the same rank, further left) shows that they do not.
        """
        return self.made_of(two) is not None and (not one or self._apart(one, two))

    def _apart(self, one: str, two: str) -> bool:
        rank, limit = self.rank, len(self.rank)
        while True:
            if rank.get(one + two, limit) < limit:
                return False
            left, right = rank.get(one, -1), rank.get(two, -1)
            if left < 0 and right < 0:
                return True
            if left > right:
                limit, one = left, self.made_of(one)[1]
            else:
                limit, two = right + 1, self.made_of(two)[0]

    def chunk_ids(self, text: str) -> list[int]:
        """Ids of the pieces of a chunk, by backtracking; a character that no piece begins with stands alone, as its bytes."""
        longest = [0] * len(text)  # by start: length and id of the longest match
        for end, match in self.automaton.iter(text):
            start = end + 1 - (match >> ID_BITS)
            if match > longest[start]:
                longest[start] = match
        known, single, n, failed = self.pairs.get, self.single.get, len(text), None
        ends: list[int] = [0]
        found: list[int] = [ALONE]  # of characters that are no piece: ALONE
        at, match = 0, (longest[0] or single(text[0], NO_PIECE)) if n else 0
        while at < n:
            length, piece = match >> ID_BITS, match & ALONE
            end = at + length
            if failed is None or not failed[end >> 3] & 1 << (end & 7):
                fits = piece == ALONE or known(found[-1] << ID_BITS | piece)
                if fits is None:
                    fits = self._learn(found[-1], piece)
                if fits:
                    found.append(piece)
                    ends.append(end)
                    at = end
                    if at < n:
                        match = longest[at] or single(text[at], NO_PIECE)
                    continue
            while True:  # the next shorter match here, or else at the piece before
                length -= 1
                while length and text[at : at + length] not in self.ids:
                    length -= 1
                if length:
                    match = length << ID_BITS | self.ids[text[at : at + length]]
                    break
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                found.pop()
                length = ends.pop() - ends[-1]
                at = ends[-1]
        if ALONE not in found[1:]:
            return found[1:]
        spelled = [[i] if i != ALONE else [self.byte_ids[b] for b in text[e0:e1].encode()] for i, e0, e1 in zip(found[1:], ends, ends[1:])]
        return [i for part in spelled for i in part]

    def _learn(self, before: int, piece: int) -> bool:
        fits = self.follows(self.names[before] if before != ALONE else "", self.names[piece])
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[before << ID_BITS | piece] = fits
        return fits

    def _encode_chunk(self, chunk: str) -> bytes:
        return np.array(self.chunk_ids(chunk), dtype=np.int32).tobytes()

    def _spell_word(self, word: str) -> tuple[int, bytes, bytes]:
        if "\n" not in word:
            return self._spelled(self.chunk_ids(BLANK + word))
        return self._spelled([i for chunk in self.split.findall(BLANK + word) for i in self.chunk_ids(chunk)])

    def _spelled(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        """The number of ids, the ids in decimal and the bytes they decode to."""
        return len(ids), b"".join(map(self.decimal.__getitem__, ids)), b"".join(map(self.surface.__getitem__, ids))

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """The number of ids of a text, and SHA-256 of the ids in decimal and of the text they decode to.

        What stands between single blanks is coded apart and remembered; with runs of blanks, chunks are.
        """
        if not text:
            coded: list[tuple[int, bytes, bytes]] = []
        elif self.apart and "  " not in text and BLANK not in text and text[0] != " " and text[-1] != " ":
            coded = list(map(self.words.__getitem__, text.split(" ")))
        else:
            coded = list(map(self.spelled.__getitem__, self.split.findall(BLANK + text.replace(" ", BLANK))))
        ids = b"".join([c[1] for c in coded]) + self.decimal[self.end][:-1]
        raw = b"".join([c[2] for c in coded])
        first = coded[0][1].split(b" ", 1)[0] if coded and coded[0][0] else b""
        decoded = raw.decode("utf-8", "replace")
        if first and int(first) in self.opens:
            decoded = decoded[1:]
        return sum([c[0] for c in coded]) + 1, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text with the end id; a null or empty text has the end id only."""
        parts = self.split.findall(BLANK + text.replace(" ", BLANK)) if text else []
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, parts)) + np.int32(self.end).tobytes(), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank that encoding puts in front is taken off."""
        first = next((i for i in ids if self.surface[i]), -1)
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if first in self.opens else text


def _coder(model: bytes) -> PieceCoder:
    kept = vars(sentencepiece).setdefault("_piece_coders", {})  # a worker's later tasks find what it remembers
    if model not in kept:
        kept.clear()
        kept[model] = PieceCoder(model)
    return kept[model]


def digest_encoder(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over ``id, text``: the number of ids and the digests of the ids and of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            found = [coder.digests(t.as_py()) for t in batch.column("text")]
            columns = zip(zip(*found) if found else [()] * 3, (pa.int64(), pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in columns)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def piece_encoder(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``ids`` and ``decoded`` to each row with a ``text``, in slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            texts, start = batch.column("text"), 0
            while start < batch.num_rows:
                arrays, decoded, used, stop = [], [], 0, start
                while stop < batch.num_rows and used < SLICE:
                    ids = coder.encode(texts[stop].as_py())
                    arrays.append(ids)
                    decoded.append(coder.decode(ids.tolist()))
                    used += ids.nbytes
                    stop += 1
                part = batch.slice(start, stop - start)
                offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
                keep = [i for i, name in enumerate(part.schema.names) if name != "text"]
                columns = [part.column(i) for i in keep] + [lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[part.schema.names[i] for i in keep] + ["ids", "decoded"])
                start = stop

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``ids`` (with the end id) and ``decoded``.

    Whole texts are encoded as the model's own library does; a null text counts as empty. Null ids and
    repeated rows are encoded like others. Other columns are ignored. An empty table gives an empty result. The model
    file, read once by the driver, travels with the task (its size is that of a vocabulary).
    """
    with open(model_path, "rb") as file:
        model = file.read()
    base = pack(docs, id=id_col, text=text_col).select("id", "text")
    out = base.mapInArrow(piece_encoder(model), f"id {dict(base.dtypes)['id']}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_tokens`` (with the end id), ``ids_sha256`` (of the ids in decimal, joined by
    one blank) and ``decoded_sha256``: what ``encode_pieces`` returns, digested where it is made. Other cases are as there."""
    with open(model_path, "rb") as file:
        model = file.read()
    base = pack(docs, id=id_col, text=text_col).select("id", "text")
    out = base.mapInArrow(digest_encoder(model), f"id {dict(base.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
