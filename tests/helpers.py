"""Small literal inputs for golden tests (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

CONV_SCHEMA = T.StructType([
    T.StructField("cv_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("subscription_id", T.StringType()),
    T.StructField("user_identifier", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("stitched_user_id", T.StringType()),
    T.StructField("cv_tstamp", T.TimestampNTZType()),
    T.StructField("cv_type", T.StringType()),
    T.StructField("cv_value", T.DoubleType()),
])

VIEW_SCHEMA = T.StructType([
    T.StructField("view_id", T.StringType()),
    T.StructField("user_identifier", T.StringType()),
    T.StructField("stitched_user_id", T.StringType()),
    T.StructField("derived_tstamp", T.TimestampNTZType()),
    T.StructField("start_tstamp", T.TimestampNTZType()),
    T.StructField("refr_urlpath", T.StringType()),
    T.StructField("mkt_campaign", T.StringType()),
    T.StructField("mkt_source", T.StringType()),
    T.StructField("mkt_medium", T.StringType()),
    T.StructField("page_urlhost", T.StringType()),
    T.StructField("view_in_session_index", T.LongType()),
])

MAP_SCHEMA = T.StructType([
    T.StructField("user_identifier", T.StringType()),
    T.StructField("user_id", T.StringType()),
])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def conv(spark, rows):
    """rows: (cv_id, sub_id, user_identifier, tstamp, type, value)"""
    data = [(c, f"e{c}", s, u, None, u, ts(t), ty, v) for c, s, u, t, ty, v in rows]
    return spark.createDataFrame(data, CONV_SCHEMA)


def views(spark, rows):
    """rows: (view_id, user_identifier, tstamp, campaign, medium)"""
    data = [(v, u, u, ts(t), ts(t), "/r", c, "src", m, "www.a.test", 1) for v, u, t, c, m in rows]
    return spark.createDataFrame(data, VIEW_SCHEMA)


def mapping(spark, rows=()):
    return spark.createDataFrame(list(rows), MAP_SCHEMA)
