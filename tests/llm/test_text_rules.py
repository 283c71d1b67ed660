"""Quality, toxicity, URL rules and WARC on small cases, against plain versions."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

from pathcredit.llm import quality, toxicity, url_filter, warc
from pathcredit.llm.common import importable, table
from pathcredit.session import new_state_dir


def plain_counts(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def random_text(r: random.Random) -> str:
    return "".join(r.choice(["a", "b", "a b c ", " ", "\n", "\r\n", "\t", "é", "#", "|", "\x1c", " ", "x y\n", "\x0b"]) for _ in range(r.randint(0, 120)))


def test_base_counts():
    r = random.Random(2)
    for text in ["", " \n", "a a a a", "a b", "\n\n", "x\nx\nx", *(random_text(r) for _ in range(400))]:
        assert quality.base_counts(text)[0] == plain_counts(text), repr(text)


def test_distances():
    rng = np.random.default_rng(0)
    p, q = rng.dirichlet(np.ones(9), 4), rng.dirichlet(np.ones(9), 4)
    m = (p + q) / 2
    want = np.sqrt(((p * np.log2(p / m)).sum(1) + (q * np.log2(q / m)).sum(1)) / 2)
    assert np.allclose(quality.distance(p, q), want)
    p[:, :5] = 0
    p /= p.sum(1, keepdims=True)
    assert np.allclose(quality.part_distance(p[:, 5:], q[:, 5:]), quality.distance(p, q))


def test_quality_keeps_clean_and_drops_junk(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    refs = quality.learn(docs)
    judged = quality.judge(docs, refs).join(table(spark, sf_small, "labels"), "doc_id").collect()
    clean = [r for r in judged if r.quality == 1 and not r.base_failed]
    junk = [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)
    assert sum(r.kept for r in junk) <= 0.2 * max(5, len(junk))


def test_quality_defined_cases(spark):
    importable(spark)
    text = "the cat sat on a mat and then it ran off to see who was there now " * 1
    rows = [(1, None, "en", 0.5), (2, "", "en", 0.5), (3, "word " * 100, None, 0.5), (3, "word " * 100, None, 0.5), (None, text * 5, "xx", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept double")
    for refs in (quality.learn(docs), quality.References((), (), ())):
        got = quality.judge(docs, refs).collect()
        assert len(got) == 5 and [r.n_words for r in got if r.doc_id in (1, 2)] == [0, 0]
        assert not any(r.kept for r in got if r.doc_id is not None)
        assert quality.drop_poor(docs, refs).columns == docs.columns
    nothing = docs.limit(0)
    assert quality.learn(nothing) == quality.References((), (), ()) and quality.judge(nothing, quality.learn(nothing)).count() == 0


def test_quality_judges_rare_languages(spark):
    importable(spark)
    r = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "nrsl"][::6]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    make = lambda n: " ".join(r.choices(vocabulary, weights, k=n)).capitalize() + "."
    rows = [(i, make(200), "aa") for i in range(160)] + [(200 + i, make(1000), "rare") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality.learn(docs, quality.QualityParams(least_share=0.5))
    assert refs.languages == ("aa", "rare")  # 27 % of the documents, but enough characters
    judge = quality.Judge(quality.learn(docs.filter("lang = 'aa'")), quality.QualityParams())
    junk = " ".join("".join(r.choices("#$%&0123456789XQZ|", k=r.randint(2, 9))) for _ in range(200))
    kept = lambda text, lang: judge(text, lang)[6]
    assert [kept(make(200), x) for x in ("aa", "zz", None)] == [True] * 3
    assert [kept(junk, x) for x in ("aa", "zz", None)] == [False] * 3


def toxic_corpus(n: int = 400) -> tuple[list[str], list[str]]:
    r = random.Random(3)
    plain = ["alpha", "beta", "gamma", "delta", "house", "tree", "river", "stone", *(f"w{r.randint(0, 3000)}" for _ in range(800))]
    make = lambda extra: " ".join([*(r.choice(plain) for _ in range(60)), *extra])
    return [make(r.sample(["fool", "villain", "brute", "knave"], 2)) for _ in range(n // 4)], [make([]) for _ in range(n)]


def test_toxicity_learns_and_leaves_clean_documents(spark):
    importable(spark)
    toxic, plain = toxic_corpus()
    rows = [(i, t, "x") for i, t in enumerate([*toxic, *plain])]
    docs = spark.createDataFrame([*rows, (9_000, None, "x"), (9_001, "", "x"), (None, "villain fool", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < len(toxic))) for i, *_ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    right = sum((got[i] >= 0.5) == (i < len(toxic)) for i, *_ in rows)
    assert right >= 0.99 * len(rows) and got[9_000] == got[9_001] < 0.5 and got[None] >= 0.5
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.filter(f"doc_id >= {len(toxic)}").count() >= 0.99 * len(plain)


def test_a_shared_passage_makes_no_copies():
    r = random.Random(5)
    passage = " ".join(f"licence{i}" for i in range(20))
    texts = [" ".join([passage, *(f"w{r.randint(0, 10**6)}" for _ in range(60))]) for _ in range(200)]
    copies = [texts[0], texts[1].upper(), texts[2] + " and more", *["", ""], *["short"] * 2]
    assert toxicity.distinct_texts([*texts, *copies]) == [*map(toxicity.words, texts), [], [b"short"]]


def test_toxicity_without_labels(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] == [0.25, 0.25]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "http://example.com/en", "ftp://example.net/fr/1",
        "http://NET/es/", "http://notnet/es/", "http://x.org/a?b=1&c=2#d", "http://h?x/y", "http://h#x", "://a.com/", "http://u:p@b.net:80/es/", "http://a.com://b/"]


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fit, key=lambda r: len(r.text), default=None)


def test_url_rules(spark, sf_small):
    importable(spark)
    more = [r.url for r in table(spark, sf_small, "pages").collect()]
    rows = [(i, u, "k") for i, u in enumerate([*URLS, *more])] + [(0, None, "k"), (None, "http://a.net/es/", "k")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for page_id, url, _ in rows:
        host, path, rule = plain_rule(url)
        r = by_id[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), url
        assert r.verdict == (rule.verdict if rule else ("block" if r.score >= 0.5 else "allow"))
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none).count() == 0


def test_suffix_statistics_are_learnt_from_other_hosts(spark):
    """Where each host alone tells its label, its own labels aren't in its features: trees can't repeat them, and
    URLs of hosts that no rule knows are judged by what other hosts have in common."""
    importable(spark)
    r = random.Random(4)
    hosts = [f"h{i}.{'bad' if i % 2 else 'good'}" for i in range(60)]
    rules = tuple(url_filter.Rule("block" if h.endswith("bad") else "allow", h + "/") for h in hosts[:40])
    rows = [(k, f"http://{r.choice(hosts)}/{r.randint(0, 999)}") for k in range(1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {x.page_id: x for x in url_filter.judge(pages, rules).collect()}
    held_out = [x for x in got.values() if x.rule is None]
    assert len(held_out) > 300 and all((x.verdict == "block") == x.host.endswith("bad") for x in held_out)
    alone = tuple(url_filter.Rule("block" if i % 3 == 0 else "allow", f"x{i}.s{i}/") for i in range(40))
    pages = spark.createDataFrame([(k, f"http://x{k % 60}.s{k % 60}/a") for k in range(1200)], "page_id long, url string")
    scores = [x.score for x in url_filter.judge(pages, alone).collect() if x.rule is None]
    assert max(scores) < 0.5  # with the hosts' own shares as features, trees would tell labels of single hosts apart by them


def test_trees_learn_held_out_urls():
    r = random.Random(5)
    urls = [(f"http://h{r.randint(0, 99)}.x/{r.randint(0, 9)}", 0.0) for _ in range(600)] + \
           [(f"http://h-{r.randint(0, 10**9)}-{r.randint(0, 10**9)}.x/a/b/c?{'&'.join('k=1' for _ in range(r.randint(2, 6)))}", 1.0) for _ in range(600)]
    r.shuffle(urls)
    none = url_filter.Suffixes(np.zeros((8, 3), int), np.zeros((8, 3), int))
    rows = [url_filter.lexical(u, *plain_rule(u)[:2]) + none.of(plain_rule(u)[0]) for u, _ in urls]
    x, y = np.array(rows), np.array([v for _, v in urls])
    p = url_filter.Trees(url_filter.UrlParams()).fit(x[:800], y[:800]).predict(x[800:])
    assert ((p >= 0.5) == (y[800:] == 1)).mean() > 0.98
    assert url_filter.Trees(url_filter.UrlParams()).fit(x[:0], y[:0]).predict(x[:3]).max() < 0.5


PAGES = [(5, "http://a/", "<p>x</p>", 1), (2, "http://b/\r\nX: y", "<p>x</p>", 1), (9, None, None, 1), (3, "http://c/", "", 1), (7, "http://d/", "é WARC/1.1\r\n\r\n", 1),
         (7, "http://d/", "é WARC/1.1\r\n\r\n", 1), (None, "http://e/", "<p>x</p>", 1), (None, "http://f/", "alone", 1)]


def test_warc_round_trip(spark, tmp_path):
    importable(spark)
    path = new_state_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string, header int"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({p[2] or "" for p in PAGES})
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect()), key=str)
    want = []
    for page_id, _, html, _ in PAGES:
        payload = (html or "").encode()
        first = min((p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None), default=None)
        kind = "response" if first is None or first == page_id else "revisit"
        want.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), kind, None if kind == "response" else first))
    assert got == sorted(want, key=str)
    warc.export(spark, path, str(tmp_path / "files"), records_a_file=3)
    back = warc.read_files(spark, str(tmp_path / "files")).collect()
    assert len(back) == len(PAGES) and sum(r.record_type == "revisit" for r in back) == sum(w[3] == "revisit" for w in want)
    assert any(r.block.endswith("é WARC/1.1\r\n\r\n".encode()) for r in back)


def test_warc_verifies_and_takes_empty_tables(spark):
    importable(spark)
    head = warc.header(1, "http://a/", warc.sha1_base32(b"x"), 1, None)
    assert warc.rebuilt(head, b"x")[0].endswith(b"x\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        warc.rebuilt(head, b"y")
    same = zstandard.ZstdCompressor().compress(b"x")
    assert warc._whole(head, same, hashlib.sha256(b"x").digest())[0] == b"x"
    with pytest.raises(ValueError, match="another SHA-256"):  # though the header's own digest fits
        warc._whole(head, same, hashlib.sha256(b"y").digest())
    with pytest.raises(ValueError, match="missing"):
        warc._whole(head, None, b"")
    path = new_state_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).count() == 0


def test_url_sample_is_of_distinct_urls(spark, monkeypatch):
    importable(spark)
    rule = url_filter.RULES[0]
    url = lambda i: f"http://{rule.host}{rule.path}{'x' * i}"
    rows = [(i, url(0)) for i in range(3000)] + [(i, url(1 + i % 300)) for i in range(600)]
    ruled = url_filter.with_rules(spark.createDataFrame(rows, "page_id long, url string"), url_filter.RULES)
    seen = []
    monkeypatch.setattr(url_filter.Trees, "fit", lambda self, x, y: seen.append(x[:, 0].tolist()) or self)
    url_filter.learn(ruled, url_filter.UrlParams(sample=100))
    assert len(seen[0]) == len(set(seen[0])) == 100
