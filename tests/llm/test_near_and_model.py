"""Near-duplicates, embeddings, the language model and the pipeline against brute force."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pathcredit.llm import embeddings, maxent, minhash, packing, quality, queries, toxicity
from pathcredit.llm.common import importable, table


def classes_by_brute_force(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    return {i: root(i) for i in ids}


def near_texts() -> dict[int, str | None]:
    r = random.Random(6)
    word = lambda: f"w{r.randint(0, 400)}"
    out: dict[int, str | None] = {}
    for base in range(6):
        words = [word() for _ in range(80)]
        for _ in range(7):
            own = list(words)
            for _ in range(r.choice([0, 0, 1, 1, 4, 12])):
                own[r.randrange(len(own))] = word()
            out[len(out) * 3 + 1] = " ".join(own)
    return out | {500: None, 501: "", 502: " \n", 503: "one two", 504: "One  two", 505: "one two three", 506: "a b c d e", 507: "a b c d e"}


def test_minhash_classes(spark):
    importable(spark)
    texts = near_texts()
    rows = [(i, t, "x") for i, t in texts.items()] + [(503, "one two", "x"), (None, "a b c d e", "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band string")
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert {i: got[i].class_id for i in texts} == classes_by_brute_force(texts)
    assert got[None].class_id is None and got[None].kept
    one = minhash.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.filter("doc_id is not null").collect()) == sorted(set(classes_by_brute_force(texts).values()))
    assert one.filter("doc_id is null").count() == 2
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_what_the_least_members_leave_apart_is_found(spark):
    """A bucket whose least member is like nobody: the others are linked with each other nevertheless, in blocks."""
    importable(spark)
    p = minhash.MinHashParams(block=4)
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**32, 300).astype(np.uint32)
    rows = []
    for node in range(12):
        own = common.copy()
        own[: 6 if node else 200] = rng.integers(0, 2**32, 6 if node else 200)
        sig = minhash.signatures(np.unique(own).astype(np.uint64), None, np.zeros(len(np.unique(own)), int), 1, p.coordinates)[0]
        rows.append((7, 12, node, node, sig.tobytes(), np.unique(own).tobytes()))
    members = spark.createDataFrame(rows, "band long, n long, node long, grp long, signature binary, shingles binary")
    links = minhash.apart_links(members, p).collect()
    joined = {i: i for i in range(12)}
    for _ in range(12):
        for r in links:
            joined[r.a] = joined[r.b] = min(joined[r.a], joined[r.b])
    assert joined == {0: 0, **{i: 1 for i in range(1, 12)}}


@pytest.mark.parametrize("weighted", [False, True])
def test_signatures_agree_as_often_as_the_sets(weighted):
    rng = np.random.default_rng(2)
    for n, shared in ((1, 1), (30, 20), (400, 300)):
        agree = []
        for _ in range(25):
            x = rng.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
            a, b = x[:n], x[n - shared :]
            w = np.full(2 * n, 2.5) if weighted else None
            s = minhash.signatures(np.concatenate([a, b]), w, np.repeat([0, 1], n), 2, 126)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.05


def vectors(rng) -> list:
    rows = []
    for size, noise in ((1, 0.0), (30, 0.02), (25, 0.05), (8, 0.15), (1, 0.0), (12, 0.08)):
        base = rng.normal(size=16)
        base /= np.linalg.norm(base)
        for _ in range(size):
            rows.append((len(rows) * 2, [float(v) for v in (base + noise * rng.normal(size=16)) * rng.uniform(0.1, 9)], 3))
    return rows


def test_embedding_links(spark):
    importable(spark)
    good = vectors(np.random.default_rng(3))
    odd = [(901, None, 3), (902, [0.0] * 16, 3), (903, [1.0] * 15, 3), (904, [float("nan")] * 16, 3), (905, [1e300] * 16, 3), (907, [1.0] * 15 + [None], 3),
           (909, [float("inf")] * 16, 3), (0, good[0][1], 3), (None, [1.0] * 16, 3)]
    df = spark.createDataFrame([*good, *odd], "vec_id long, embedding array<double>, cell int")
    got = {r.vec_id: r for r in embeddings.near_vectors(df).collect()}
    ids = [g[0] for g in good] + [905]
    x = np.array([g[1] for g in good] + [[1.0] * 16])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    label = np.arange(len(ids))
    for _ in ids:
        label = np.array([label[row].min() for row in linked])
    for k, i in enumerate(ids):
        assert (got[i].n_links, got[i].component_id) == (linked[k].sum() - 1, ids[label[k]]), i
        assert got[i].kept == (got[i].component_id == i)
    for i in (901, 902, 903, 904, 907, 909):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_every_length_and_every_row(spark):
    """Mixed lengths against the query's own SQL; rows of one id each have its result."""
    import duckdb

    importable(spark)
    rng = np.random.default_rng(7)
    rows = []
    for size, n in ((16, 40), (15, 12), (3, 9), (1, 5)):
        bases = rng.normal(size=(3, size))
        for k in range(n):
            rows.append((len(rows), [float(v) for v in bases[k % 3] + 0.02 * rng.normal(size=size)]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    con = duckdb.connect()
    con.register("embeddings", df.toPandas())
    want = sorted(con.execute(queries.ORACLE["op6_embeddings"]).fetchall())
    assert sorted(map(tuple, embeddings.near_vectors(df).collect())) == want
    assert sum(n for _, n, _, _ in want) > 300 and len({c for _, _, c, _ in want}) > 6
    twice = embeddings.near_vectors(df.unionByName(df.limit(10)).unionByName(spark.createDataFrame([(None, [1.0])] * 2, df.schema))).collect()
    assert len(twice) == len(rows) + 12 and sorted({tuple(r) for r in twice if r.vec_id is not None}) == want


def test_embedding_recall_at_the_cosine():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for n in (2_000, 50_000, 10**8):
        hashes, tables = embeddings.plan(n, 64)
        met = [bool(set(p) & set(q)) for p, q in zip(embeddings.bucket_keys(a, hashes, tables).tolist(), embeddings.bucket_keys(b, hashes, tables).tolist())]
        assert np.mean(met) >= 0.95


def test_model_scores(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text, 1) for r in docs] + [(docs[0].doc_id, docs[0].text, 1), (None, None, 1)]
    got = maxent.score(spark.createDataFrame(rows, "doc_id long, text string, block int"), maxent.MaxentParams(block_tokens=20_000)).collect()
    assert len(got) == len(rows)
    counts: collections.Counter = collections.Counter()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t, _ in rows}
    for i, *_ in rows:
        if not held(i):
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        w = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
    for out in (False, True):
        some = [r for r in got if r.held_out == out]
        assert sum(r.score for r in some) > sum(r.base_score for r in some)


def test_model_classes_sum_to_one():
    p = maxent.MaxentParams()
    w = np.random.default_rng(0).normal(size=(p.features, p.classes)).astype(np.float32)
    f = np.random.default_rng(1).integers(0, p.features - 1, (4, 50))
    assert np.allclose(maxent.softmax(w, f).sum(1), 1, atol=1e-4)


def test_model_without_training_texts(spark):
    importable(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert maxent.score(none).count() == 0
    held_out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = maxent.score(spark.createDataFrame([(held_out, "a b")], "doc_id long, text string")).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_pipeline_against_its_parts(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = docs.collect()
    model = toxicity.fit(docs, table(spark, sf_small, "labels"))
    rows = [r for r in rows if toxicity.score_text(model, r.text) < 0.5]
    judge = quality.Judge(quality.learn(spark.createDataFrame(rows, docs.schema)), quality.QualityParams())
    rows = [r for r in rows if judge(r.text or "", r.lang)[6]]
    classes = classes_by_brute_force({r.doc_id: r.text for r in rows})
    rows = [r for r in rows if classes[r.doc_id] == r.doc_id]
    ids = packing.ids_of(packing.TOKENIZER)
    want = {(r.doc_id, length) for r in rows for length in [len(ids(r.text or "")) // 4 + 1]}
    got = corpus_pipeline.run(spark, sf_small).collect()
    assert {(r.doc_id, r.doc_tokens) for r in got} == want
    assert len(rows) > 0.5 * docs.count()
    by_doc = collections.Counter()
    for r in got:
        by_doc[r.doc_id] += r.length
    assert all(by_doc[i] == n for i, n in want)


def test_counts_return_to_their_blocks_whole():
    """Bundled by block in heaps of any size, every word's count and mark comes back."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    rows = {(int(b), int(w)): int(c) for b, w, c in zip(rng.integers(0, 9, 4000), rng.integers(0, 2000, 4000), rng.integers(0, 1 << 40, 4000))}
    table_ = pa.table({"block": [b for b, _ in rows], "word": [w for _, w in rows], "c": list(rows.values())})
    for most in (1, 700, 1 << 20):
        back = {}
        for batch in maxent.bundles(iter(table_.to_batches(max_chunksize=333)), most):
            for block, told in zip(*(x.to_pylist() for x in batch.columns)):
                steps, counts = maxent.unsqueezed(told)
                back |= {(block, w): c for w, c in zip(np.cumsum(steps).tolist(), counts.tolist())}
        assert back == rows


def test_maxent_sums_and_chances_do_not_depend_on_their_pieces():
    """All lines of features are summed at once, and chances come piece by piece, as if made whole."""
    r = np.random.default_rng(3)
    weights = r.normal(size=(50, 6)).astype(np.float32)
    features = r.integers(0, 49, (4, 501))
    chances = maxent.softmax(weights, features, most=7)
    assert (chances == maxent.softmax(weights, features, most=10_000)).all()
    z = weights[features].sum(0, dtype=np.float64) + weights[-1]
    assert np.allclose(chances, np.exp(z) / np.exp(z).sum(1, keepdims=True), atol=1e-5)
    into, wanted = np.zeros((50, 6)), np.zeros((50, 6))
    maxent.summed(into, features, chances)
    for f in features:
        np.add.at(wanted, f, chances)
    assert np.allclose(into, wanted, atol=1e-4)
