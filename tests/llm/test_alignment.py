"""Cross-tokenizer alignment against brute force with the public libraries."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pathcredit.llm import alignment, queries
from pathcredit.llm.common import importable


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(public_tokenizers.path(alignment.LEFT))
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.RIGHT))


def byte_of() -> dict[str, int]:
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def brute(docs: list[tuple], libraries) -> list[tuple]:
    """Rows of the result, token by token."""
    left, right = libraries
    with open(public_tokenizers.path(alignment.LEFT), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    shown = byte_of()
    a_bytes = {i: bytes(shown[c] for c in t) for t, i in vocabulary.items() if all(c in shown for c in t)}
    found, counts = [], Counter()
    for doc_id, text in docs:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        pieces = [right.id_to_piece(i) for i in b]
        b_raw = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        a_raw = [a_bytes[i] for i in a]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            found.append((doc_id, [], [], [], []))
            continue
        a_end, b_end = np.cumsum(list(map(len, a_raw))).tolist(), np.cumsum(list(map(len, b_raw))).tolist()
        at, shared = dict(zip(b_end, b)), set(a_end) & set(b_end)
        links = [(i, at[e]) for i, e in zip(a, a_end) if e in at]
        counts.update(links)
        groups, x, y, own = [], [], [], iter(zip(b_end, b))
        for e, i in zip(a_end, a):
            x.append(i)
            if e in shared:
                for f, j in own:
                    y.append(j)
                    if f == e:
                        break
                groups.append((x, y))
                x, y = [], []
        found.append((doc_id, a, b, groups, links))
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    out = []
    for doc_id, a, b, groups, links in found:
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_documents_of_every_kind(spark, libraries):
    importable(spark)
    r = random.Random(6)
    parts = ["in", "the", " the", "ing", "  ", "\n", "é", "漢", "😀", "\x00", "<s>", "<|endoftext|>", "Z", "123", "'s", ".", "�", "　", " " * 17, "tion"]
    values = ["", " ", "▁", "a▁b", "a", "the " * 3000, "漢字" * 2000, "x" * 3000, *("".join(r.choice(parts) for _ in range(r.randint(1, 40))) for _ in range(150))]
    data = [(i, v, "x", 1) for i, v in enumerate(values)] + [(500, None, "x", 1), (4, "a", "y", 1), (4, "the same id", "y", 1), (None, values[9], "x", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, pairs string, n int")
    got = alignment.corpus_alignment(docs).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute([(i, v) for i, v, _, _ in data], libraries), key=repr)
    assert alignment.corpus_alignment(docs.limit(0)).count() == 0


def test_groups_hold_all_tokens(spark):
    importable(spark)
    rows = alignment.align(spark.createDataFrame([(1, "thesis of the 漢字 tion"), (2, "")], "doc_id long, text string"), with_tokens=True).collect()
    for r in rows:
        assert sum(r.a_in_group) == len(r.a_ids) == r.n_a and sum(r.b_in_group) == len(r.b_ids) == r.n_b and len(r.a_in_group) == r.n_groups


def test_galloping_finds_the_places_of_binary_search():
    r = np.random.default_rng(1)
    for _ in range(300):
        long = np.unique(r.integers(0, r.integers(2, 3000), r.integers(0, 600)))
        short = np.unique(r.integers(0, r.integers(2, 3000), r.integers(0, 300)))
        assert (alignment.gallop(short, long, int(r.integers(1, 40))) == np.searchsorted(long, short)).all()


def test_pairs_end_alike(spark, sf_small):
    """The bound of the table of counts: of two tokens that end together one's bytes end the other's."""
    importable(spark)
    tokens = alignment.tokens_of(alignment.LEFT, alignment.RIGHT)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for (pair,) in alignment.align(docs).selectExpr("explode(pairs)").distinct().collect():
        a, b = tokens.a_bytes[pair // tokens.b_size], tokens.b_bytes[pair % tokens.b_size]
        assert a.endswith(b) or b.endswith(a)
    ends = Counter(t[k:] for t in tokens.a_bytes for k in range(len(t)))
    inner = {}
    for t in tokens.a_bytes:
        inner[t] = inner.get(t, 0) + 1
    most = sum(ends[t] for t in tokens.b_bytes if t) + sum(inner.get(t[k:], 0) for t in tokens.b_bytes for k in range(1, len(t)))
    assert most == 324_297


def test_the_query_is_brute_force_over_the_whole_table(spark, sf_small, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    result = queries.QUERIES["op13_alignment"](spark, sf_small)
    assert result.columns == COLUMNS
    assert sorted(map(tuple, result.collect())) == sorted(brute(docs, libraries))
