"""Packing by power-of-two decomposition.

A document's ids, closed by one end id, are cut into pieces whose lengths are
powers of two: as many whole sequences as fit, then the binary digits of the
rest, longest first. Every piece is a sequence of its own, so no sequence
crosses documents and none is padded; pieces of one length form a bucket, and
batches are drawn bucket by bucket. One pass, no shuffle: nothing depends on
other documents.

``sequence_id`` is the bucket (log2 of the length) in its top bits, then the
task's partition and the piece's place among the task's pieces. It is unique
in one result whatever is repeated or lost, but not the same numbers for
another partitioning of the input.

Defined results: a null or empty text is the end id alone, one piece of
length 1. Repeated rows are packed each. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pathcredit.llm.common import batches, strings

TOKENIZER, END, LONGEST = "byte_bpe_50k.json", 1, 2048
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("bucket", pa.int32())])
PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"


def byte_symbols() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others for 256 and on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    """A text's ids as the tokenizer file gives them, little-endian 32-bit words.

    The vocabulary and the special strings come from the file; a byte-level
    BPE vocabulary is in the order of its merges, so the merging itself is
    left to tiktoken's faster code (the tests hold it against the library the
    file belongs to). Special strings are taken out first, as that library does.
    """

    def __init__(self, name: str):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.any_special = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        byte = byte_symbols()
        ranks = {bytes(byte[c] for c in t): i for t, i in tokenizer.get_vocab().items() if t not in self.special}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return self.plain(text)
        out, at = [], 0
        for m in self.any_special.finditer(text):
            out += [self.plain(text[at : m.start()]), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])


@lru_cache(maxsize=2)
def ids_of(name: str) -> Ids:
    return Ids(name)


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """n as powers of two up to ``longest``, largest first."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, longest: int = LONGEST, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves, to be written by bucket."""
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    close = np.array([end], "<u4").tobytes()
    schema = pa.schema([*PIECES, pa.field("ids", pa.list_(pa.int32()))]) if with_ids else PIECES

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(tokenizer)
        first = TaskContext.get().partitionId() << 33
        made = 0

        def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal made
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                raw = memoryview(ids(text) + close)
                n, start = len(raw) // 4, 0
                for length in lengths(n, longest):
                    own = raw[4 * start : 4 * (start + length)]
                    bucket = length.bit_length() - 1
                    row = (doc_id, start, length, zlib.crc32(own), n, bucket << 58 | first + made, 0, bucket)
                    yield (*row, np.frombuffer(own, "<i4")) if with_ids else row
                    start, made = start + length, made + 1

        for batch in rows:
            yield from batches(pieces(batch), schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES_SQL + (", ids array<int>" if with_ids else ""))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences with their ids, one folder per length: a reader draws batches of equal lengths without padding."""
    packed.write.partitionBy("bucket").parquet(path)
