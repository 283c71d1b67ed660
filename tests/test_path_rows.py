"""What a path's rows carry: its text is made once, and only its labels are shuffled."""

from __future__ import annotations

from helpers import conv, mapping, views
from pathcredit.config import AttributionConfig
from pathcredit.operators import attribution as att
from pathcredit.operators import paths as pth
from pathcredit.operators import touchpoints as tpo

CFG = AttributionConfig()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_a_path_has_its_text_made_once(spark):
    """Below the unnesting, not for each of its touches."""
    paths = spark.createDataFrame([("c1", "e1", "u", None, "t", 1.0, ["a", "b", ">"]), ("c2", "e2", "u", None, "t", 1.0, None)],
                                  "cv_id string, event_id string, customer_id string, cv_tstamp timestamp_ntz, cv_type string, revenue double, channel_transformed_path array<string>")
    rows = att.attribute(paths, "channel", CFG)
    physical = plan(rows).split("== Physical Plan ==")[1]
    above = physical.split("Generate")[0]
    assert "array_join" in physical and "array_join" not in above
    assert sorted((r.cv_id, r.channel_transformed_path, r.path_length) for r in rows.collect()) == [("c1", r"a > b > \>", 3)] * 3 + [("c2", None, None)]


def test_only_labels_of_a_path_are_shuffled(spark):
    convs = pth.ordinary_conversions(conv(spark, [("c1", None, "d1", "2024-01-20 10:00:00", "signup", None)]), mapping(spark), CFG)
    touches = tpo.touchpoints(views(spark, [("v2", "d1", "2024-01-12 00:00:00", "x", "cpc"), ("v1", "d1", "2024-01-12 00:00:00", None, "email"),
                                            ("v0", "d1", "2024-01-19 00:00:00", "y", None)]), mapping(spark), CFG)
    paths = pth.paths_to_conversion(convs, touches, CFG)
    logical = plan(paths).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    upper = logical.split("Join Inner")[0]
    assert "transform(slice(_touches" in upper
    row = paths.first()
    assert row.channel_path == ["Email", "Paid_Search", "Direct"] and row.campaign_path == ["No campaign", "x", "y"]
