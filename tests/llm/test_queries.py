"""Every registered query of the training-data operators by its contract, and the pipeline over odd tables."""

from __future__ import annotations

import re
import zlib

import pytest

import corpus_pipeline
from pathcredit.llm import packing, queries
from pathcredit.llm.common import importable

COLUMNS = {
    "op1_warc": ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
    "op2_bpe": ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"),
    "op3_packing": ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"),
    "op4_token_counts": ("doc_id", "n_bytes", "n_tokens", "over_limit"),
    "op5_quality": ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    "op6_embeddings": ("vec_id", "n_links", "component_id", "kept"),
    "op7_maxent": ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
    "op8_minhash": ("doc_id", "class_id", "kept"),
    "op9_url_filter": ("page_id", "host", "path", "rule", "verdict"),
    "op10_toxicity": ("doc_id", "held_out", "score", "predicted"),
}
TABLE = {"op1_warc": ("pages", "page_id"), "op9_url_filter": ("pages", "page_id"), "op6_embeddings": ("embeddings", "vec_id")}


def fold(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_a_query_returns_its_contract_over_its_whole_table(spark, sf_small, name):
    rows = queries.QUERIES[name](spark, sf_small).collect()
    table, key = TABLE.get(name, ("documents", "doc_id"))
    source = {r[key]: r for r in spark.read.parquet(f"{sf_small}/{table}.parquet").collect()}
    assert set(COLUMNS[name]) <= set(rows[0].asDict())
    if name == "op3_packing":
        assert {r.doc_id for r in rows} == set(source)
        total: dict[int, int] = {}
        for r in rows:
            total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert all(total[r.doc_id] == r.doc_tokens for r in rows) and all(r.length <= packing.LONGEST for r in rows)
        return
    assert sorted(r[key] for r in rows) == sorted(source)
    if name == "op10_toxicity":
        for r in rows:
            assert r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    if name == "op7_maxent":
        train = sum(len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) + 1 for d in source.values() if fold(d.doc_id, 7) != 2)
        for r in rows:
            assert r.held_out == (fold(r.doc_id, 7) == 2) and r.train_tokens == train and r.n_known <= r.n_tokens and r.score < 0
        assert all(r.n_known == r.n_tokens for r in rows if not r.held_out)
    if name == "op5_quality":
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    if name in ("op6_embeddings", "op8_minhash"):
        group = "component_id" if name == "op6_embeddings" else "class_id"
        assert all(r.kept == (r[group] == r[key]) and r[group] <= r[key] for r in rows)
    if name == "op9_url_filter":
        assert {r.verdict for r in rows} <= {"allow", "block"}
    if name == "op1_warc":
        assert all(r.payload_bytes == len((source[r.page_id].html or "").encode()) for r in rows)


def written(spark, path, docs, labels) -> str:
    importable(spark)
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_the_pipeline_over_empty_tables(spark, tmp_path):
    path = written(spark, tmp_path, spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, path).count() == 0


def test_the_pipeline_over_nulls_repeats_and_clashing_columns(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60)
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "x " * 80, "en", None, 160), (9003, "word " * 60_000, None, "s", 300_000)]
    more = docs.unionByName(spark.createDataFrame(odd, DOCS).select(*docs.columns)).unionByName(docs.limit(3))
    for column in ("toxic", "kept", "score", "node", "length"):
        more = more.selectExpr("*", f"'{column}' as {column}")
    path = written(spark, tmp_path, more, spark.read.parquet(f"{sf_small}/labels.parquet"))
    packed = corpus_pipeline.run(spark, path).collect()
    ids = {r.doc_id for r in packed}
    assert ids and not ids & {9001, 9002, 9003} and len({r.sequence_id for r in packed}) == len(packed)
    assert len({(r.doc_id, r.start) for r in packed}) == len(packed)  # repeated rows once
