"""What runs shuffle and read: rows that are replaced aren't read whole, attribution rows are written once."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pathcredit.config import AttributionConfig
from pathcredit.operators import attribution as att
from pathcredit.session import new_state_dir
from pathcredit.sources import tables
from pathcredit.sources.tables import TableStore
from pathcredit.streaming import incremental as inc

CFG = AttributionConfig()
SCHEMA = "k string, d date, v int"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def days(spark, values, schema=SCHEMA):
    return spark.createDataFrame([(k, dt.date(2024, 1, d) if d else None, *v) for k, d, *v in values], schema)


def test_replaced_rows_are_found_by_keys_alone(spark, monkeypatch):
    """An upsert of every key writes its updates as they are: no join with whole rows, no search in dates it has anyway."""
    store = TableStore(spark, new_state_dir(spark, "test-volume"))
    store.upsert("t", days(spark, [(f"k{i}", i % 5 + 1, i) for i in range(600)]), ["k"], "d")
    written, whole = [], TableStore._write

    def write(self, df, name, *a, **k):
        written.append(plan(df))
        return whole(self, df, name, *a, **k)

    monkeypatch.setattr(TableStore, "_write", write)
    monkeypatch.setattr(tables, "rows_of_keys", lambda *a, **k: pytest.fail("every date has updates"))
    out = store.upsert("t", days(spark, [(f"k{i}", i % 5 + 1, -i) for i in range(600)]), ["k"], "d")
    assert len(written) == 1 and "LeftAnti" not in written[0]
    assert sorted(r.v for r in out.collect()) == sorted(-i for i in range(600))


@pytest.mark.parametrize("share", [0.02, 0.6, 0.97, 1.0])
def test_rows_whose_key_isnt_updated_stay(spark, share):
    """However many stay, and with null keys and dates, repeated rows, other types and new columns."""
    r = random.Random(int(share * 100))
    held = [(f"k{i}", i % 6, i) for i in range(300)] + [(None, 2, 1000), (None, 2, 1000), ("k7", 1, 7)]
    store = TableStore(spark, new_state_dir(spark, "test-volume"))
    store.upsert("t", days(spark, held), ["k"], "d")
    fresh = [(f"k{i}", r.choice([i % 6, 3]), 10_000 + i, "n") for i in range(300) if r.random() < share] + [("new", 4, 1, "n")]
    out = store.upsert("t", days(spark, fresh, "k string, d date, v long, w string"), ["k"], "d")
    assert out.dtypes == [("k", "string"), ("d", "date"), ("v", "bigint"), ("w", "string")]
    keys = {x[0] for x in fresh}
    wanted = [(k, d, v, None) for k, d, v in held if k not in keys] + fresh
    got = [(x.k, x.d.day if x.d else 0, x.v, x.w) for x in out.collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert store.updates("t").count() == len(fresh)


def test_dealt_paths_give_the_same_rows(spark):
    paths = spark.createDataFrame([("c1", dt.datetime(2024, 1, 3), ["a", "b"]), ("c2", None, None), ("c2", None, None)],
                                  "cv_id string, cv_tstamp timestamp_ntz, channel_transformed_path array<string>")
    paths = paths.selectExpr("*", "'e' AS event_id", "'u' AS customer_id", "'t' AS cv_type", "1.0 AS revenue")
    rows, dealt = (att.attribute(x, "channel", CFG) for x in (paths, inc.dealt_by_date(paths, 3_000_000)))
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()
    assert re.search(r"rangepartitioning\(.* 6\)", plan(inc.dealt_by_date(paths, 3_000_000)))


def test_a_run_writes_each_attribution_row_once(spark, sf_small, monkeypatch):
    """Attribution rows go straight into their table: none is staged before, and none is shuffled with its path's text."""
    from pathcredit.sources import fixtures as fx

    staged, whole = [], TableStore.stage
    monkeypatch.setattr(TableStore, "stage", lambda self, name, df: staged.append(df.columns) or whole(self, name, df))
    state = new_state_dir(spark, "test-volume")
    inc.run_incremental(spark, fx.load_inputs(spark, sf_small), state, CFG, "run1")
    assert staged and not any("first_touch_attribution" in columns for columns in staged)
    assert inc.read_table(spark, state, inc.CHANNEL_ATTR).filter(F.col("path_length").isNotNull()).count() > 0
