"""Corpus pipeline: toxic documents go, poor documents go, one document of each
near-duplicate group stays, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``, whatever others the table has besides.

Defined results: documents with a null, empty or blank text fail the base rules
of the second stage, like any of under 50 words; rows without a doc_id are
judged by their text and all stay where it passes; of rows with one doc_id the
third stage keeps one; empty tables give no rows. Long texts are judged whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathcredit.llm import minhash, packing, quality, toxicity
from pathcredit.llm.common import importable, table
from pathcredit.session import delete_path, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language."""
    importable(spark)
    return quality.drop_poor(docs, quality.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each near-duplicate class."""
    importable(spark)
    return minhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each a sequence of its own."""
    importable(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("minhash", drop_copies), ("packing", pack)]
#: SQL cannot express the stages; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name, written)
    for done in written[:-1]:  # every stage is written in full
        delete_path(spark, done)
    return docs
