"""Every registered query against its DuckDB oracle on the smallest scale."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as se  # noqa: E402
from compare_oracle import digest  # noqa: E402
from pathcredit.plans.queries import ORACLE, QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_small}/events.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(se.queries())
    assert len(KEYS) >= 35


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    got = se.queries()[key](spark, sf_small).toPandas()
    want = duck.execute(se.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "ROAS" in df.columns


@pytest.mark.parametrize("key", ["touchpoints", "paths", "overview_window", "incremental_two_runs"])
def test_session_time_zone_does_not_matter(spark, duck, sf_small, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = se.queries()[key](spark, sf_small).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = duck.execute(se.oracle_sql()[key]).df()
    assert len(got) == len(want) and digest(got) == digest(want)


def test_entry_without_the_training_data_libraries():
    """A library that only the removable subpackage needs may be absent: its queries are, the others aren't."""
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), "False"]
