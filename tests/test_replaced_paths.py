"""Stored attribution rows are told by their paths: keys are looked for only where a path changed."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pathcredit.config import AttributionConfig
from pathcredit.operators import attribution as att
from pathcredit.operators import paths as pth
from pathcredit.session import new_state_dir
from pathcredit.sources import fixtures as fx
from pathcredit.sources.tables import TableStore
from pathcredit.streaming import incremental as inc

CFG = AttributionConfig()


def stored_paths(spark, held):
    data = [(cv, f"e{cv}", "u", dt.datetime(2024, 1, day) if day else None, "t", 1.0, labels, labels) for cv, day, labels in held]
    return spark.createDataFrame(data, "cv_id string, event_id string, customer_id string, cv_tstamp timestamp_ntz, cv_type string, "
                                       "revenue double, channel_transformed_path array<string>, campaign_transformed_path array<string>")


OLD = [("c1", 1, ["a", "b", "a > b"]), ("c2", 1, ["a", "b", "c"]), ("c3", 2, ["a"]), ("c4", 2, None), ("c5", 3, ["x", None, "y"]),
       ("c6", 3, [""]), ("c7", None, ["a", "b"]), (None, 2, ["n"]), ("k", 2, ["1x"]), ("c8", 1, ["p", "q"]), ("c9", 2, ["a", "b"])]
NEW = [("c1", 1, ["a", "b", "a > b"]), ("c2", 1, ["a", "c"]), ("c4", 2, None), ("c5", 3, ["x", "y", None]), ("c6", 3, [""]),
       ("c7", None, ["a", "b"]), (None, 2, ["n"]), ("k1", 3, ["x"]), ("c9", 2, ["a > b"]), ("new", 1, ["a"])]


@pytest.mark.parametrize("new", [NEW, OLD, OLD[:1] + NEW[-1:]])
def test_told_by_paths_the_same_rows_stay(spark, new):
    """With changed and shortened paths, null labels, paths, ids and dates, keys that two conversions share, and an older
    row that an earlier merge left."""
    left = [("c8", 1, ["z", "q", "r"])]  # its third row stayed when c8 got its path of two
    got = []
    for told in (False, True):
        store = TableStore(spark, new_state_dir(spark, "test-told"))
        for held in (left, OLD, new):
            scope = stored_paths(spark, held)
            rows = att.attribute(scope, "channel", CFG)
            out = store.upsert("t", rows, ["composite_key"], "cv_tstamp_date", date_limited=True, same=att.paths_held(scope, "channel") if told else None)
        got.append(sorted(map(str, out.collect())))
    assert got[0] == got[1] and any("c8r2" in row for row in got[1])


def test_a_run_looks_for_no_key_of_an_unchanged_path(spark, sf_small, monkeypatch):
    state, inputs = new_state_dir(spark, "test-told"), fx.load_inputs(spark, sf_small)
    inc.run_incremental(spark, inputs, state, CFG, "run1")
    before = inc.read_table(spark, state, inc.CHANNEL_ATTR).collect()
    sought, whole, staged, stage = [], TableStore._kept, [], TableStore.stage
    monkeypatch.setattr(TableStore, "_kept", lambda self, rows, keys, key, unique: sought.append(key) or whole(self, rows, keys, key, unique))
    monkeypatch.setattr(TableStore, "stage", lambda self, name, df: staged.append(df.columns) or stage(self, name, df))
    inc.run_incremental(spark, inputs, state, CFG, "run2")
    assert ["cv_id"] in sought and ["composite_key"] not in sought
    assert staged and not any("channel_path" in columns for columns in staged)  # paths go straight into their table
    after = inc.read_table(spark, state, inc.CHANNEL_ATTR).collect()
    assert sorted(map(str, before)) == sorted(map(str, after))


def test_keys_are_stored_by_what_they_differ_in(spark):
    store = TableStore(spark, new_state_dir(spark, "test-told"))
    store.upsert("t", spark.range(5000).selectExpr("concat('conversion-', id) AS k", "date'2024-01-01' AS d").coalesce(1), ["k"], "d")
    file = pq.ParquetFile(glob.glob(f"{store.path('t')}/write=1/d=2024-01-01/*.parquet")[0])
    assert "DELTA_BYTE_ARRAY" in file.metadata.row_group(0).column(0).encodings
    assert store.read("t").filter("k = 'conversion-4711'").count() == 1


def test_labels_of_a_path_are_shuffled_as_plain_arrays(spark, sf_small):
    from pathcredit.plans.pipeline import Pipeline

    pipe = Pipeline(fx.load_inputs(spark, sf_small), CFG, materialize=False)
    paths = pth.paths_to_conversion(pipe.ordinary, pipe.touchpoints, CFG)
    shuffled = paths._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(slice(_touches" in shuffled and shuffled.count("transform(slice(_touches") == 2


def test_the_adapter_maps_devices_as_its_mapping_does(spark, sf_small):
    """From an event's own device, without a join with all devices for each of the inputs."""
    inputs = fx.load_inputs(spark, sf_small)
    told = inputs.user_mapping.select(F.col("user_identifier").alias("ui"), F.col("user_id").alias("uid"))
    for df in (inputs.views, inputs.conversions):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
        both = df.join(told, F.col("user_identifier") == F.col("ui"), "left")
        assert both.count() == df.count() > 0
        assert both.filter(~F.col("stitched_user_id").eqNullSafe(F.coalesce("uid", "user_identifier"))).isEmpty()
    assert inputs.conversions.join(told, F.col("user_identifier") == F.col("ui"), "left").filter(~F.col("user_id").eqNullSafe(F.col("uid"))).isEmpty()
