"""Packing, BPE and token counts against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from pathcredit.llm import bpe, packing, token_counts
from pathcredit.llm.common import importable

ODD = ["", " ", "\n\n  x", "a" * 50_000, " " * 5_000, "<|endoftext|>", "a<|endoftext|> b <|startoftext|>", "don't 'start I'LL ΑΣ Σ.", "é漢字😀 ½",
       "x ́y", "é Ǆ", "1234567 12.5", "tab\tnew\r\nline\x0b\x0c", "　wide space"]


def texts(n: int = 150) -> list[str]:
    r = random.Random(4)
    parts = ["in", "the", " the", "ing", "th", "'re", "tion", " x", "1", "23", "Z", "\n", "  ", "é", "ß", "漢", ".", ", ", "#"]
    return ODD + ["".join(r.choice(parts) for _ in range(r.randint(1, 40))) for _ in range(n)]


def table(spark, values):
    importable(spark)
    rows = [(i, v, "x", 1) for i, v in enumerate(values)] + [(len(values), None, "x", 1), (0, values[0], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def empty(spark):
    importable(spark)
    return spark.createDataFrame([], "doc_id long, text string, ids string, length int")


def test_packing_gives_the_librarys_ids_in_powers_of_two(spark):
    library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    values = texts()
    found: dict[int, list] = {}
    rows = packing.pack(table(spark, values)).collect()
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in [*enumerate(values), (len(values), "")]:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        own = sorted(found[doc_id], key=lambda r: r.start)[:: 2 if doc_id == 0 else 1]  # the first row is there twice
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece) and r.offset == 0
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
    assert packing.pack(empty(spark)).count() == 0


def test_packed_buckets_hold_equal_lengths(spark, tmp_path):
    packing.write_buckets(packing.pack(table(spark, texts(20)), with_ids=True), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("size(ids) != length or length != shiftleft(1, bucket)").count() == 0


def test_bpe_gives_tiktokens_ids_and_decodes_to_the_text(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))
    values = texts()
    encoded = bpe.encode(table(spark, values), with_ids=True)
    got = {r.doc_id: r for r in encoded.collect()}
    for doc_id, text in [*enumerate(values), (len(values), "")]:
        ids = library.encode_ordinary(text)
        r = got[doc_id]
        assert r.n_tokens == len(ids) and r.ids == ids
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert {r.doc_id: r.text for r in bpe.decode(encoded).collect()}[5] == values[5]
    assert bpe.encode(empty(spark)).count() == 0


def test_prefix_tables_append_and_edit():
    r = random.Random(1)
    e = bpe.text_encoder(bpe.RANKS, public_tokenizers.PATTERN).encoder
    pieces = [b"the", b" ing", b"tion", b"x", b"\xff", "é".encode(), b"abc", b" "]
    for _ in range(150):
        data = b"".join(r.choice(pieces) for _ in range(r.randint(0, 30)))
        cut = r.randint(0, len(data))
        table_ = e.extend(data, e.extend(data[:cut], []))
        assert e.ids(data, table_) == e.merge(data)
        a = r.randint(0, len(data))
        b = r.randint(a, len(data))
        edited, changed = e.replace(data, table_, a, b, r.choice(pieces))
        assert changed == e.extend(edited, []) and e.ids(edited, changed) == e.merge(edited)


def test_token_counts_are_the_librarys(spark):
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    values = texts()
    got = {r.doc_id: r for r in token_counts.count_tokens(table(spark, values)).collect()}
    for doc_id, text in [*enumerate(values), (len(values), "")]:
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[doc_id].n_tokens, got[doc_id].n_bytes, got[doc_id].over_limit) == (n, len(text.encode()), n > 2048), text[:40]
    assert token_counts.count_tokens(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 17])
def test_chunk_maps_compose(chunk):
    c = token_counts.counter(token_counts.TOKENIZER)
    for text in texts(60):
        if len(text) < 2000:
            assert c.of_text(text, chunk) == c.of_text(text)
