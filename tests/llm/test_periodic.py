"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathcredit.llm import periodic, queries
from pathcredit.llm.common import importable


def brute(words: list[str], least: int) -> list[tuple[int, int, int]]:
    """Every period, every stretch: start, length and smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def rows(found) -> list[tuple[int, int, int]]:
    return list(zip(*(a.tolist() for a in found)))


def fibonacci(n: int) -> list[str]:
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def made(r: random.Random) -> list[str]:
    words = [r.choice("abcde"[: r.choice([1, 2, 2, 3, 5])]) for _ in range(r.randint(0, 90))]
    for _ in range(r.randint(0, 3)):
        if words:
            s, p = r.randrange(len(words)), r.randint(1, 15)
            for i in range(s + p, min(len(words), s + r.randint(1, 60))):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_are_those_of_brute_force(least):
    r = random.Random(least)
    documents = [made(r) for _ in range(1500)] + [fibonacci(n) for n in (20, 60, 150)] + [list("bababaababab"), ["a"] * 200, list("ab" * 50)]
    for at in range(0, len(documents), 40):  # copies of a document in one batch don't meet
        own = documents[at : at + 40] + documents[at : at + 3]
        for words, found in zip(own, periodic.of_documents(own, least)):
            assert rows(found) == brute(words, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=120))
def test_runs_over_two_words(words):
    assert rows(periodic.of_documents([words], 2)[0]) == brute(words, 2)


def test_a_long_document_is_done_whole():
    r = random.Random(8)
    words = [str(r.randrange(50_000)) for _ in range(300_000)]
    words[1000:61_000] = (words[1000:21_000] * 3)
    words[299_000:] = ["x"] * 1000
    found = rows(periodic.of_documents([words])[0])
    assert (299_000, 1000, 1) in found and any(q == 20_000 and n >= 60_000 for _, n, q in found)


def test_factor_names_are_equal_where_factors_are():
    r = np.random.default_rng(1)
    words = r.integers(0, 3, 200)
    for k, names in enumerate(periodic.factor_names(words, 200)):
        n = 1 << k
        factors = [tuple(words[i : i + n]) if i + n <= 200 else None for i in range(200)]
        for i in range(200):
            for j in range(i + 1, 200):
                assert (names[i] == names[j]) == (factors[i] is not None and factors[i] == factors[j])


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute(words, 12) if n < 3000 else rows(periodic.of_documents([words])[0])
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_documents_of_every_kind(spark):
    importable(spark)
    r = random.Random(3)
    values = ["", " \t\n", "one", "a a a a a a a a a a a a a", " ".join(f"w{i % 7}" for i in range(100)), "　x　 " * 30, *(" ".join(made(r)) for _ in range(60))]
    data = [(i, v, "x", 1) for i, v in enumerate(values)] + [(999, None, "x", 1), (3, values[3], "x", 1), (3, "other text", "y", 2), (None, values[4], "x", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, runs string, n_words int")
    got = sorted(map(tuple, periodic.described(periodic.periodic_runs(docs, rewrite=queries.with_period)).collect()), key=repr)
    assert got == sorted((expected(i, v) for i, v, _, _ in data), key=repr)
    assert periodic.described(periodic.periodic_runs(docs.limit(0))).count() == 0


def test_the_query_is_brute_force_over_the_whole_table(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    result = queries.QUERIES["op11_periodic"](spark, sf_small)
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, result.collect())) == sorted(expected(i, t) for i, t in docs)
