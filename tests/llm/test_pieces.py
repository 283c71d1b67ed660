"""SentencePiece encoding by prefix tables against the public library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from pathcredit.llm import pieces, queries
from pathcredit.llm.automaton import Recent, heaps
from pathcredit.llm.common import importable

PARTS = ["in", "the", " the", "ing", "▁", "  ", "    ", " ", "\n", "\t", "a", "é", "漢", "梦", "😀", "\x00", "<0x0A>", "<s>", "</s>", "<unk>", "Z", "1", "23",
         "'s", ".", "...", " ⁇ ", "�", "ﬁ", "　", "aa", "aaa", " " * 17, "ch", "sch", "ion", "tion"]
ODD = ["", " ", "  ", " " * 40, "▁" * 33, "a" * 5000, "x" + " " * 100 + "y", "\n\n\n", "漢字梦" * 3000, "théあ" * 3000, "a b " * 20_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def texts(n: int, seed: int = 3) -> list[str]:
    r = random.Random(seed)
    return ODD + ["".join(r.choice(PARTS) for _ in range(r.randint(1, 30))) for _ in range(n)]


def test_ids_and_decoded_texts_are_the_librarys(spark, library):
    importable(spark)
    values = texts(300)
    rows = [(i, v, "x", 1) for i, v in enumerate(values)] + [(len(values), None, "x", 1), (0, values[0], "y", 2), (None, "a", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    encoded = pieces.encode(docs, with_ids=True)
    found = encoded.collect()
    assert len(found) == len(rows) and sum(r.doc_id == 0 for r in found) == 2
    got = {r.doc_id: r for r in found}
    for doc_id, text in [*enumerate(values), (len(values), ""), (None, "a")]:
        ids = library.encode(text)
        r = got[doc_id]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(back[i] == library.decode(library.encode(v)) for i, v in enumerate(values))
    assert pieces.encode(docs.limit(0)).count() == 0


def test_any_ids_decode_as_the_library_does(library):
    own, r = pieces.text_encoder(pieces.MODEL), random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(0, 6), 259, 29871, r.randrange(195, 250)]) for _ in range(r.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_every_prefix_has_the_last_piece_of_its_encoding(library):
    model = pieces.text_encoder(pieces.MODEL).model
    for text in texts(60, 9):
        part = "▁" + text.replace(" ", "▁")[:80]
        last = model.tables.last(model.symbols(part).tolist())
        assert len(last) == len(part) + 1
        for n in range(1, len(part) + 1):
            ids = library.encode(part[1:n])
            if last[n] != model.none and n > 1:
                assert ids[-1] == last[n]


def test_pairs_that_fit_are_those_that_merging_leaves_apart():
    model, r = pieces.text_encoder(pieces.MODEL).model, random.Random(5)
    plain = list(model.token.values())
    runs = [i for i in model.tied]
    for _ in range(4000):
        a, b = r.choice(plain if r.random() < 0.8 else runs), r.choice(plain if r.random() < 0.8 else runs)
        if model.merge(model.piece[a]) == [model.piece[a]]:
            assert model.fits(a, b) == (model.merge(model.piece[a] + model.piece[b]) == [model.piece[a], model.piece[b]]), (a, b)


def test_tables_are_the_same_side_by_side_and_one_by_one():
    model = pieces.text_encoder(pieces.MODEL).model
    parts = [p for t in texts(200, 1) if t for p in model.cuts("▁" + t.replace(" ", "▁"))][:2000]
    wide = pieces.Tables(model.tables.automaton, model.length, model.fits, model.none, lanes=7, widest=1 << 30)
    symbols = [model.symbols(p[:200]) for p in parts]
    tokens, counts = wide.encode(np.concatenate(symbols), np.array(list(map(len, symbols))))
    at = 0
    for own, n in zip(symbols, counts.tolist()):
        assert tokens[at : at + n].tolist() == wide.one(own.tolist())
        at += n


def test_remembered_values_are_right_when_places_are_few():
    recent = Recent(lambda keys: (keys * 7 % 1000).astype(np.int32), bits=3)
    r = np.random.default_rng(1)
    for _ in range(50):
        keys = r.integers(0, 500, 100)
        assert (recent(keys) == keys * 7 % 1000).all()


def test_heaps_keep_every_row():
    rows = [(i, "x" * n) for i, n in enumerate([0, 5, 20, 1, 1, 1, 9, 30, 0])]
    cut = list(heaps(iter(rows), 10))
    assert [r for h in cut for r in h] == rows and all(len(h) == 1 or sum(len(t) for _, t in h) <= 10 for h in cut)
    assert list(heaps(iter([]))) == []


def test_the_query_is_the_library_over_the_whole_table(spark, sf_small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_sentencepiece"](spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
