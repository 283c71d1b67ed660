"""What is done once a row or a block, and not again for each value made of it."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from helpers import conv, mapping, views
from pyspark.sql import functions as F

from pathcredit.config import AttributionConfig
from pathcredit.operators import attribution as att
from pathcredit.operators import paths as pth
from pathcredit.operators import touchpoints as tpo
from pathcredit.sources import fixtures as fx
from pathcredit.sources.tables import TableStore

CFG = AttributionConfig()


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _events(spark, tmp_path) -> str:
    rows = [(i, dt.datetime(2024, 1, 2, i % 24), i % 3, kind, 1.0, props)
            for i, (kind, props) in enumerate((k, p) for k in ("view", "purchase", "signup")
                                              for p in ('{"k": 0}', '{"k": 1}', '{"k": 2}', '{"k": 3}', '{"k": -1}', "{}", None))]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_an_events_properties_are_parsed_once_a_row(spark, tmp_path):
    where = _events(spark, tmp_path)
    assert _plan(fx.views(spark, where)).count("get_json_object") == 1
    conversions = fx.conversions(spark, where)
    assert _plan(conversions).count("get_json_object") == 1
    kinds = {r["cv_id"]: r["cv_type"] for r in conversions.collect()}
    want = ["free_trial", "subscribe", "renew", "purchase", "purchase", "purchase", "purchase"] + ["signup"] * 7
    assert [kinds[f"cv{i}"] for i in range(7, 21)] == want
    held = {r["cv_id"] for r in conversions.filter("subscription_id is not null").collect()}
    assert held == {"cv7", "cv8", "cv9", "cv11"}


def _touched(spark):
    convs = conv(spark, [("c1", None, "d1", "2024-01-20 00:00:00", "purchase", 10.0), ("c2", None, "d2", "2024-01-20 00:00:00", "purchase", 5.0),
                         ("c3", None, "d3", "2024-01-20 00:00:00", "purchase", 5.0)])
    seen = views(spark, [("v1", "d1", "2024-01-10 00:00:00", "a", "cpc"), ("v2", "d1", "2024-01-19 00:00:00", "b", "email"),
                         ("v3", "d2", "2024-01-19 00:00:00", "a", "email"), ("v4", "d3", "2024-01-19 00:00:00", "a", "cpc")])
    return pth.ordinary_conversions(convs, mapping(spark), CFG), tpo.touchpoints(seen, mapping(spark), CFG)


def test_null_labels_are_left_out_of_their_own_path_only(spark):
    goals, touches = _touched(spark)
    gone = touches.withColumn("channel", F.when(F.col("view_id").isin("v1", "v4"), F.col("channel")))
    paths = {r["cv_id"]: (r["channel_path"], r["campaign_path"]) for r in pth.paths_to_conversion(goals, gone, CFG).collect()}
    assert paths == {"c1": (["Paid_Search"], ["a", "b"]), "c2": (None, ["a"]), "c3": (["Paid_Search"], ["a"])}


def test_texts_of_a_path_are_written_without_a_dictionary(spark, tmp_path):
    rows = att.attribute(pth.paths_to_conversion(*_touched(spark), CFG), "channel", CFG)
    table = TableStore(spark, str(tmp_path)).upsert("t", rows, ["composite_key"], "cv_tstamp_date", date_limited=True, runs=att.texts_of_path("channel"))
    assert table.count() == rows.count() == 4
    assert sorted(table.select(*rows.columns).collect()) == sorted(rows.collect())
    for file in glob.glob(f"{tmp_path}/t/**/*.parquet", recursive=True):
        group = pq.ParquetFile(file).metadata.row_group(0)
        plain = {c.path_in_schema for c in map(group.column, range(group.num_columns)) if not c.has_dictionary_page}
        assert plain >= set(att.texts_of_path("channel"))
