"""One registered query per operator: production parameters over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.llm import alignment, bpe, embeddings, maxent, minhash, packing, periodic, pieces, quality, token_counts, toxicity, url_filter, warc
from pathcredit.llm.common import fold, table
from pathcredit.session import new_state_dir


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id", toxicity.ToxicityParams.folds) == toxicity.ToxicityParams.held_out).alias("held_out"),
        "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_state_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judge(docs, quality.learn(docs))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def with_period(doc_id: int | None, words: list[str]) -> list[str]:
    """The words that op11 judges: a tenth of the documents repeats some of its own from a place on."""
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    start, period = g % n, 1 + (n - g % n) // (3 + g % 8)
    own = words[start : start + period]
    times = (n - start) // len(own) + 1
    return words[:start] + (own * times)[: n - start]


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.described(periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_period))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.corpus_alignment(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_bpe": op2_bpe,
    "op4_token_counts": op4_token_counts,
    "op3_packing": op3_packing,
    "op5_quality": op5_quality,
    "op6_embeddings": op6_embeddings,
    "op7_maxent": op7_maxent,
    "op8_minhash": op8_minhash,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_periodic": op11_periodic,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_alignment": op13_alignment,
}

#: Least vertex reachable over ``links`` (x, y in both directions).
REACH = """reach(v, m) AS (SELECT x, x FROM links UNION SELECT l.y, r.m FROM reach r JOIN links l ON l.x = r.v),
least AS (SELECT v, min(m) AS m FROM reach GROUP BY v)"""

#: The operators that SQL can express, by brute force; the tests hold the others against plain versions.
ORACLE: dict[str, str] = {
    "op1_warc": """WITH held AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)
                        for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM held""",
    "op6_embeddings": f"""WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.vec_id <> b.vec_id AND CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) END >= 0.9),
{REACH}
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, coalesce(m, vec_id) AS component_id, coalesce(m, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON v = vec_id""",
    "op8_minhash": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE k >= 0.8 * (p.n + q.n - k)),
{REACH}
SELECT doc_id, coalesce(m, doc_id) AS class_id, coalesce(m, doc_id) = doc_id AS kept FROM documents LEFT JOIN least ON v = doc_id""",
}
