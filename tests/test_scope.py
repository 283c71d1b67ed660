"""Attribution's scope lies by date in small files: its paths are unnested where they are read, and nothing is shuffled for it."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pathcredit.config import AttributionConfig
from pathcredit.functions.columns import unique_path
from pathcredit.operators import attribution as att
from pathcredit.operators import paths as pth
from pathcredit.session import new_state_dir
from pathcredit.sources import fixtures as fx
from pathcredit.sources.tables import TableStore
from pathcredit.streaming import incremental as inc

CFG = AttributionConfig()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("by_conversion", [False, True])
def test_attribution_rows_are_written_without_a_shuffle(spark, sf_small, monkeypatch, by_conversion):
    written, whole = {}, TableStore._write

    def write(self, df, name, date_column, key=(), dealt=False, mode="overwrite"):
        if mode == "overwrite":
            written.setdefault(name, []).append(plan(df))
        return whole(self, df, name, date_column, key, dealt, mode)

    monkeypatch.setattr(TableStore, "_write", write)
    state, inputs = new_state_dir(spark, "test-scope"), fx.load_inputs(spark, sf_small)
    for run in ("run1", "run2"):
        inc.run_incremental(spark, inputs, state, CFG.with_(attribution_replace_by_conversion=by_conversion), run)
    for table in (inc.CHANNEL_ATTR, inc.CAMPAIGN_ATTR):
        assert len(written[table]) == 2 and not any("Exchange" in p or "Repartition" in p for p in written[table])
    rows = att.attribute(inc.read_table(spark, state, inc.PATHS), "channel", CFG)
    held = inc.read_table(spark, state, inc.CHANNEL_ATTR).select(*rows.columns)
    assert rows.count() > 0 and rows.exceptAll(held).isEmpty() and held.exceptAll(rows).isEmpty()


def test_a_stage_by_date_has_small_files_and_is_read_in_the_order_of_its_dates(spark):
    """With more dates than scans, null dates, and rows that come twice."""
    store = TableStore(spark, new_state_dir(spark, "test-scope"))
    days = [(i % 700, dt.date(2024, 1, 1) + dt.timedelta(days=i % 70) if i % 70 else None) for i in range(1400)]
    df = spark.createDataFrame(days, "v int, d date")
    held = store.by_files_of(3, "d").stage("scope", df)
    read = store.by_ranges(held, "d")
    assert held.columns == df.columns and read.exceptAll(df).isEmpty() and df.exceptAll(read).isEmpty()
    assert max(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{store.root}/_staging/*/*/*.parquet")) == 3
    assert 2 < read._jdf.queryExecution().sparkPlan().toString().count("FileScan") <= 33
    assert store.by_ranges(held.filter("v < 0"), "d").isEmpty()
    plain = store.stage("plain", df)
    assert plain.count() == 1400 and not glob.glob(f"{store.root}/_staging/plain-*/d=*")


def test_files_of_the_scope_hold_fewer_long_paths(spark):
    long, short = (spark.createDataFrame([(["a"] * n, ["b"])], "channel_transformed_path array<string>, campaign_transformed_path array<string>")
                   .select(att.bytes_written()).first()[0] for n in (1000, 10))
    assert 1 <= inc.scope_files(long) < inc.scope_files(short) < inc.scope_files(None)
    empty = spark.createDataFrame([(None, None)], "channel_transformed_path array<string>, campaign_transformed_path array<string>")
    assert empty.select(att.bytes_written()).first()[0] > 0


def test_transformed_paths_are_shuffled_where_they_differ_only(spark):
    t = dt.datetime(2024, 1, 3)
    raw = [("c1", t, ["a", "b", "a"], ["x", "y"]), ("c2", t, None, ["x"]), ("c3", None, ["a"], None), ("c4", t, [], [None, "a"]), (None, t, ["a"], ["x"])]
    paths = spark.createDataFrame(raw, "cv_id string, cv_tstamp timestamp_ntz, channel_path array<string>, campaign_path array<string>")
    changed = pth.transform_paths(paths, CFG.with_(path_transforms=(unique_path,)))
    nulls = paths.withColumn("channel_transformed_path", F.lit(None).cast("array<string>")).withColumn("campaign_transformed_path", F.array(F.lit("z")))
    for df in (pth.transform_paths(paths, CFG), changed, nulls):
        df = df.withColumn("cv_tstamp_date", F.to_date("cv_tstamp"))
        out = pth.rebalanced(df, "cv_tstamp_date")
        assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
        assert "RebalancePartitions" in plan(out) and "_raw_channel_transformed_path" in plan(out)
