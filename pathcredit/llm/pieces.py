"""SentencePiece BPE by a table of prefixes.

A model of merges gives every prefix of a text exactly one piece that can be
the last of its encoding. An automaton over all pieces tells which pieces end
at a position; of these the last one is the piece that may follow the (already
known) last piece of what is before it. Whether one piece may follow another
is a test of the pair alone: the merges that build both are undone one by one,
latest first, and at no time may the two pieces that then meet at the border
have merged. The ids are recovered from the end of the table backwards.

No piece goes on after a space that follows something else, so a text is cut
there (``PrefixTable.cuts``), and parts met before are remembered, a bounded
number of them. Whole texts are encoded in one pass without a shuffle.

Characters without a piece become the pieces of their UTF-8 bytes. Pieces of
equal score (runs of spaces) are told by carrying out the merges themselves.

Defined results: a null or empty text has no ids and decodes to the empty
text. Repeated rows are encoded each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.automaton import Automaton, Known, Tables, heaps
from pathcredit.llm.common import batches, strings

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NEVER = float("inf")
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
ENCODED_SQL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PrefixTable:
    """Encoding and decoding with one model: pieces by id, their scores, and the ids of bytes."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        if model.normalize("a  b ") != f"{SPACE}a{SPACE * 2}b{SPACE}":
            raise ValueError("only models that keep texts as they are and put one space before them")
        self.size = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.token = {self.piece[i]: i for i in plain}
        #: Pieces are merged in this order, equal ones from the left.
        self.rank = {self.piece[i]: -model.get_score(i) for i in plain}
        if any(model.is_unused(i) for i in plain) or any(c not in self.token for p in self.token for c in p):
            raise ValueError("a model with unused pieces, or with characters that only longer pieces hold")
        times = Counter(self.rank.values())
        self.tied = {i for i in plain if times[self.rank[self.piece[i]]] > 1}
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        self.of_byte = {i: b for b, i in self.byte.items()}
        if len(self.byte) != 256:
            raise ValueError("a model without a piece for each byte")
        self.silent = {i for i in range(self.size) if model.is_control(i)}
        self.unknown = model.unk_id()
        #: Stands in the table where nothing is yet, or a character that no piece holds.
        self.none = self.size
        self.length = [len(p) for p in self.piece]
        symbols = sorted({c for p in self.token for c in p})
        self.symbol = np.zeros(0x110000, np.int32)  # of each code point; 0: no piece holds it
        self.symbol[np.array([ord(c) for c in symbols])] = np.arange(1, len(symbols) + 1)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fit: dict[int, bool] = {}
        words = ((self.symbols(p).tolist(), i) for p, i in self.token.items())
        self.tables = Tables(Automaton(words, len(symbols) + 1, self.size), self.length, self.fits, self.none)
        within = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.token)
        self.cuts = re.compile("(?s).+" if within else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def merge(self, text: str, until: int = 1) -> list[str]:
        """Pieces by the definition: again and again the leftmost pair of least rank is joined."""
        parts = list(text)
        while len(parts) > until:
            rank, at = min((self.rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one; None for a character, or where merges don't make it."""
        if token not in self._halves:
            parts = self.merge(self.piece[token], 2)
            self._halves[token] = (self.token[parts[0]], self.token[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def fits(self, before: int, last: int) -> bool:
        """May ``last`` follow ``before``?"""
        key = before * (self.size + 1) + last
        known = self._fit.get(key)
        if known is None:
            if len(self._fit) >= 500_000:
                self._fit.clear()
            known = self._fit[key] = self._compatible(before, last)
        return known

    def _compatible(self, before: int, last: int) -> bool:
        if self.length[last] > 1 and self.halves(last) is None:
            return False
        if before == self.none:
            return True
        if before in self.tied or last in self.tied:
            return self.merge(self.piece[before] + self.piece[last]) == [self.piece[before], self.piece[last]]
        piece, rank, length = self.piece, self.rank, self.length
        left_to = right_to = NEVER  # the ranks at which either becomes part of something longer
        while True:
            across = rank.get(piece[before] + piece[last])
            if across is not None and across < left_to and across <= right_to:  # of equal merges the left one comes first
                return False
            left_from = rank[piece[before]] if length[before] > 1 else -1
            right_from = rank[piece[last]] if length[last] > 1 else -1
            if left_from < 0 and right_from < 0:
                return True
            if left_from > right_from:
                left_to, before = left_from, self.halves(before)[1]
            else:
                right_to, last = right_from, self.halves(last)[0]

    def encode(self, parts: list[str]) -> list[tuple[int, ...]]:
        """Ids of each part."""
        tokens, counts = self.tables.encode(self.symbols("".join(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        out, at, tokens = [], 0, tokens.tolist()
        for part, n in zip(parts, counts.tolist()):
            own = tokens[at : at + n]
            at += n
            out.append(tuple(self._bytes(part, own) if self.none in own else own))
        return out

    def _bytes(self, part: str, tokens: list[int]) -> list[int]:
        """The ids with those of bytes for the characters that no piece holds."""
        out, at = [], 0
        for token in tokens:
            if token == self.none:
                out.extend(self.byte[b] for b in part[at].encode())
                at += 1
            else:
                out.append(token)
                at += self.length[token]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text that ids stand for; bytes that are no UTF-8 become replacement characters one by one."""
        out, held = [], bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(utf8(held))
                held.clear()
            out.append("" if i in self.silent else " ⁇ " if i == self.unknown else self.piece[i])
        if held:
            out.append(utf8(held))
        first = next((k for k, p in enumerate(out) if p), None)
        if first is not None and out[first].startswith(SPACE):
            out[first] = out[first][1:]
        return "".join(out).replace(SPACE, " ")


def utf8(raw: bytes) -> str:
    """Bytes as text; each byte that begins no whole character is one replacement character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                n = 1
            at += n
        return "".join(out)


class TextEncoder:
    """Whole texts, many at a time."""

    def __init__(self, name: str):
        self.model = PrefixTable(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name)))
        self.known = Known(self.model.encode)
        self.decimal = list(map(str, range(self.model.size)))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        return self.known([self.model.cuts(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts])

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def text_encoder(name: str) -> TextEncoder:
    return TextEncoder(name)


def encode(docs: DataFrame, model: str = MODEL, with_ids: bool = False) -> DataFrame:
    """Ids of every whole text and what they decode to: counts and digests, with ``with_ids`` the ids too."""
    schema = pa.schema([*ENCODED, pa.field("ids", pa.list_(pa.int32()))]) if with_ids else ENCODED

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(model)

        def made(batch):
            for rows in heaps(zip(batch.column(0).to_pylist(), strings(batch.column(1)))):
                for (doc_id, _), ids in zip(rows, own.encode([text for _, text in rows])):
                    row = (doc_id, len(ids), hashlib.sha256(",".join(map(own.decimal.__getitem__, ids)).encode()).hexdigest(),
                           hashlib.sha256(own.decode(ids).encode()).hexdigest())
                    yield (*row, ids) if with_ids else row

        for batch in rows:
            yield from batches(made(batch), schema, 1024)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, ENCODED_SQL + (", ids array<int>" if with_ids else ""))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text from doc_id and ids."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(model)
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        for batch in rows:
            yield from batches(((i, own.decode(ids or [])) for i, ids in zip(*(c.to_pylist() for c in batch.columns))), schema, 1024)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
