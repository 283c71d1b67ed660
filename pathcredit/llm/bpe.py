"""Byte-level BPE by dynamic programming over prefixes.

For every byte prefix of a piece exactly one vocabulary token can be the last
of its encoding. It is found from the suffixes of the prefix that are tokens:
the one that may follow the (already known) last token of what is before it.
Two tokens may follow each other if merging the bytes of both gives just
those two, which the merges at the border of both tell. The table of last tokens is the encoding of every prefix at once,
so bytes are appended without looking back further than the longest token,
and after an edit only the positions from the edit on are computed, until the
table agrees with the old one over a longest token's length.

``encode`` runs over whole texts in one pass without a shuffle; pieces are
the matches of the pattern, each distinct piece is encoded once while it is
remembered (a bounded number are). The tables of a batch's new pieces are
filled side by side, one byte of each a step; an automaton over the tokens
tells which of them end there.

Defined results: a null or empty text has no ids and decodes to no bytes.
Repeated rows are encoded each. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.automaton import Automaton, Known, Tables, heaps
from pathcredit.llm.common import batches, strings

RANKS = "byte_bpe_multi_50k.tiktoken"
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
ENCODED_SQL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file of base64 tokens and decimal ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._fit: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, bool], list[tuple[bytes, int, int]]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids by the definition: again and again the leftmost pair of least rank is joined."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or a token that no merges make."""
        if token not in self._halves:
            parts = [self.token[token][i : i + 1] for i in range(len(self.token[token]))]
            while len(parts) > 2:
                rank, at = min((self.rank.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if rank == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int, int]]:
        """What stands at one end of a token while it is built: bytes, the rank at which they form, and the rank
        at which they are merged into something longer."""
        key = token, right
        if key not in self._edges:
            out, end, at = [], 1 << 60, token
            while True:
                data = self.token[at]
                out.append((data, at if len(data) > 1 else -1, end))
                halves = self.halves(at)
                if halves is None:
                    break
                end, at = at, halves[right]
            self._edges[key] = out
        return self._edges[key]

    def fits(self, before: int, last: int) -> bool:
        """May ``last`` follow ``before`` (-1: nothing)? Not if, while both are built, something at the border
        would merge across it. (Of equal merges the left one comes first: at the border that is the one across
        it rather than the one to its right.)"""
        key = before, last
        known = self._fit.get(key)
        if known is None:
            if len(self._fit) >= 2_000_000:
                self._fit.clear()
            known = len(self.token[last]) == 1 or self.halves(last) is not None
            if known and before >= 0:
                for x, x_from, x_to in self.edge(before, True):
                    for y, y_from, y_to in self.edge(last, False):
                        if max(x_from, y_from) < min(x_to, y_to):
                            rank = self.rank.get(x + y)
                            if rank is not None and rank < x_to and rank <= y_to:
                                known = False
            self._fit[key] = known
        return known

    def extend(self, data: bytes, table: list[int], until: int | None = None) -> list[int]:
        """The last token of each prefix of ``data``; ``table`` holds those of the first prefixes and grows."""
        rank, fits, longest = self.rank, self.fits, self.longest
        for end in range(len(table) + 1, (len(data) if until is None else until) + 1):
            for start in range(max(0, end - longest), end):
                last = rank.get(data[start:end])
                if last is not None and fits(table[start - 1] if start else -1, last):
                    table.append(last)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}: the vocabulary lacks a byte")
        return table

    def ids(self, data: bytes, table: list[int]) -> list[int]:
        """The encoding of the prefix that the table covers."""
        out, end = [], len(table)
        while end:
            out.append(table[end - 1])
            end -= len(self.token[table[end - 1]])
        return out[::-1]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.rank.get(data)
        return [whole] if whole is not None else self.ids(data, self.extend(data, []))

    def replace(self, data: bytes, table: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Data and table after ``data[start:stop]`` became ``new``: the table is computed from ``start`` on until
        it has agreed with the old one over ``longest`` positions, and copied from there."""
        edited = data[:start] + new + data[stop:]
        shift = len(edited) - len(data)
        out, same = table[:start], 0
        for end in range(start + 1, len(edited) + 1):
            self.extend(edited, out, end)
            old = end - shift
            same = same + 1 if old > stop and out[-1] == table[old - 1] else 0
            if same >= self.longest:
                return edited, out + table[old:]
        return edited, out


class TextEncoder:
    """Whole texts, many at a time: pieces of the pattern, the new ones with their prefix tables side by side."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = Encoder(ranks)
        self.pieces = regex.compile(pattern).findall
        self.size = 1 + max(ranks.values())
        length = [len(self.encoder.token.get(i, b"")) for i in range(self.size)]
        self.tables = Tables(Automaton(ranks.items(), 256, self.size), length, self._fits, self.size)
        self.known = Known(self._ids)
        self.decimal = {i: str(i) for i in self.encoder.token}

    def _fits(self, before: int, last: int) -> bool:
        return self.encoder.fits(-1 if before == self.size else before, last)

    def _ids(self, pieces: list[str]) -> list[tuple[int, ...]]:
        raw, rank = [p.encode() for p in pieces], self.encoder.rank.get
        out: list = [None if whole is None else (whole,) for whole in map(rank, raw)]
        built = [i for i, ids in enumerate(out) if ids is None]
        symbols = np.frombuffer(b"".join([raw[i] for i in built]), np.uint8)
        tokens, counts = self.tables.encode(symbols, np.fromiter((len(raw[i]) for i in built), np.int64, len(built)))
        tokens, at = tokens.tolist(), 0
        for i, n in zip(built, counts.tolist()):
            out[i] = tuple(tokens[at : at + n])
            at += n
        return out

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        return self.known(list(map(self.pieces, texts)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.encoder.token.__getitem__, ids))


@lru_cache(maxsize=2)
def text_encoder(ranks: str, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(public_tokenizers.path(ranks)), pattern)


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, with_ids: bool = False) -> DataFrame:
    """Ids of every whole text and what they decode to: counts and digests, with ``with_ids`` the ids too."""
    schema = pa.schema([*ENCODED, pa.field("ids", pa.list_(pa.int32()))]) if with_ids else ENCODED

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(ranks, pattern)

        def made(batch):
            for rows in heaps(zip(batch.column(0).to_pylist(), strings(batch.column(1)))):
                for (doc_id, _), ids in zip(rows, own.encode([text for _, text in rows])):
                    row = (doc_id, len(ids), hashlib.sha256(",".join(map(own.decimal.__getitem__, ids)).encode()).hexdigest(),
                           hashlib.sha256(own.decode(ids)).hexdigest())
                    yield (*row, ids) if with_ids else row

        for batch in rows:
            yield from batches(made(batch), schema, 1024)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, ENCODED_SQL + (", ids array<int>" if with_ids else ""))


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and text from doc_id and ids; bytes that are no UTF-8 become replacement characters."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(ranks, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        for batch in rows:
            yield from batches(((i, own.decode(ids or []).decode("utf-8", "replace")) for i, ids in zip(*(c.to_pylist() for c in batch.columns))), schema, 1024)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
