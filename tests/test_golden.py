"""Golden literals per operator (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import conv, mapping, ts, views
from pathcredit.config import AttributionConfig
from pathcredit.functions.columns import collapse_repeats, unique_path, weights
from pathcredit.operators import attribution as att
from pathcredit.operators import overview as ov
from pathcredit.operators import paths as pth
from pathcredit.operators import subscriptions as sub
from pathcredit.operators import touchpoints as tpo
from pathcredit.streaming import incremental as inc
from pathcredit.sources.tables import upsert_frames

CFG = AttributionConfig(start_date=dt.datetime(2024, 1, 1))


@pytest.mark.parametrize("n,expected", [
    (1, {"first_touch": [1], "last_touch": [1], "linear": [1], "position_based": [1]}),
    (2, {"first_touch": [1, 0], "last_touch": [0, 1], "linear": [.5, .5], "position_based": [.5, .5]}),
    (3, {"first_touch": [1, 0, 0], "last_touch": [0, 0, 1], "linear": [1 / 3] * 3,
         "position_based": [.4, .2, .4]}),
    (5, {"first_touch": [1, 0, 0, 0, 0], "last_touch": [0, 0, 0, 0, 1], "linear": [.2] * 5,
         "position_based": [.4, .2 / 3, .2 / 3, .2 / 3, .4]}),
])
def test_weights_by_path_length(spark, n, expected):
    df = spark.range(n).select(F.col("id").alias("i"))
    w = weights(F.col("i"), F.lit(n).cast("bigint"))
    rows = df.select("i", *[w[m].alias(m) for m in expected]).orderBy("i").collect()
    for m, vals in expected.items():
        assert [r[m] for r in rows] == pytest.approx(vals)


def test_weights_null_path(spark):
    df = spark.createDataFrame([(None,)], "arr array<string>")
    paths = df.select(F.lit("c").alias("cv_id"), F.lit("e").alias("event_id"), F.lit("u").alias("customer_id"),
                      F.lit(ts("2024-01-02")).alias("cv_tstamp"), F.lit("x").alias("cv_type"),
                      F.lit(1.0).alias("revenue"), F.col("arr").alias("channel_transformed_path"))
    r = att.attribute(paths, "channel").collect()[0]
    assert (r.first_touch_attribution, r.last_touch_attribution) == (0.0, 0.0)
    assert r.linear_attribution is None and r.position_based_attribution is None
    assert r.composite_key is None


def _paths(spark, conv_rows, view_rows, cfg=CFG):
    c = pth.ordinary_conversions(conv(spark, conv_rows), mapping(spark), cfg)
    tp = tpo.touchpoints(views(spark, view_rows), mapping(spark), cfg)
    return {r.cv_id: r for r in pth.paths_to_conversion(c, tp, cfg).collect()}


def test_path_boundaries(spark):
    got = _paths(spark,
                 [("a", None, "u1", "2024-03-31 12:00:00", "purchase", 5.0)],
                 [("v1", "u1", "2024-03-31 12:00:00", "c_same", "cpc"),       # same instant: in
                  ("v2", "u1", "2024-03-01 00:05:00", "c_30d", "email"),      # 30 calendar days: in
                  ("v3", "u1", "2024-02-29 23:59:00", "c_31d", "social"),     # 31 days: out
                  ("v4", "u1", "2024-03-31 12:00:01", "c_after", None)])      # after: out
    assert got["a"].campaign_path == ["c_30d", "c_same"]
    assert got["a"].channel_path == ["Email", "Paid_Search"]
    assert got["a"].cv_path_start_tstamp == ts("2024-03-01 12:00:00")


def test_campaign_labels_and_no_touchpoint(spark):
    got = _paths(spark,
                 [("a", None, "u1", "2024-01-10 00:00:00", "purchase", 1.0),
                  ("b", None, "u2", "2024-01-10 00:00:00", "purchase", 1.0)],
                 [("v1", "u1", "2024-01-09 00:00:00", None, None),
                  ("v2", "u1", "2024-01-09 01:00:00", "", "")])
    assert got["a"].campaign_path == ["No campaign", "No campaign"]
    assert got["a"].channel_path == ["Direct", "Direct"]
    assert "b" not in got


def test_buckets_do_not_change_paths(spark):
    rows = [("a", None, "u1", "2024-02-15 08:00:00", "purchase", 1.0)]
    vrows = [(f"v{i}", "u1", (dt.datetime(2024, 1, 10) + dt.timedelta(hours=13 * i)).isoformat(),
              f"c{i % 3}", "cpc") for i in range(80)]
    base = _paths(spark, rows, vrows, CFG)["a"].campaign_path
    for b in (1, 3, 31, 64):
        assert _paths(spark, rows, vrows, CFG.with_(join_bucket_days=b))["a"].campaign_path == base


def _sub_events(spark, rows):
    return conv(spark, rows).select("cv_id", "event_id", "subscription_id", "user_identifier", "user_id",
                                    "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")


def test_rollup(spark):
    ev = _sub_events(spark, [
        ("c1", "s", "u", "2024-01-01 09:00:00", "free_trial", 0.0),
        ("c2", "s", "u", "2024-01-02 09:00:00", "subscribe", 10.0),
        ("c3", "s", "u", "2024-02-02 09:00:00", "renew", 10.0),
        ("c4", "s", "u", "2024-03-02 09:00:00", "renew", None),
    ])
    r = sub.build_subscriptions(ev, CFG).collect()[0]
    assert (r.free_trial_count, r.subscribe_count, r.renew_count) == (1, 1, 2)
    assert (r.free_trial_revenue, r.subscribe_revenue, r.renew_revenue) == (0.0, 10.0, 10.0)
    assert r.revenue == 20.0
    assert r.last_subscription_event_tstamp == ts("2024-03-02 09:00:00")


def test_rollup_null_and_duplicate_rules(spark):
    ev = _sub_events(spark, [
        ("c1", "s", "u", "2024-01-01 09:00:00", "free_trial", None),
        ("c1", "s", "u", "2024-01-01 09:00:00", "free_trial", None),   # duplicate cv_id: counted once
    ])
    r = sub.build_subscriptions(ev, CFG).collect()[0]
    assert r.free_trial_count == 1
    assert r.free_trial_revenue is None and r.revenue is None       # all null values
    assert r.subscribe_revenue == 0.0                                # other types: 0


def test_first_event(spark):
    ev = conv(spark, [("c1", "s", "late", "2024-01-01 10:00:00", "subscribe", 10.0),
                      ("c2", "s", "early", "2024-01-01 09:00:00", "free_trial", 0.0)])
    r = sub.build_subscriptions(ev.select(*sub.SUBSCRIPTION_EVENT_COLUMNS, "subscription_id"), CFG).collect()[0]
    assert r.subscription_start_tstamp == ts("2024-01-01 09:00:00")
    assert r.user_identifier == "early"


def test_touched_reads_history(spark):
    c = conv(spark, [("c1", "s", "u", "2023-01-05 00:00:00", "subscribe", 10.0),
                     ("c2", "s", "u", "2024-01-05 00:00:00", "renew", 10.0),
                     ("c3", "t", "u", "2023-06-05 00:00:00", "subscribe", 10.0),
                     ("c4", None, "u", "2024-01-05 00:00:00", "renew", 1.0)])
    touched = sub.touched_subscriptions(c, ts("2024-01-05 03:00:00"), CFG)
    ev = sub.subscription_events(c, touched, CFG)
    assert sorted(r.cv_id for r in ev.collect()) == ["c1", "c2"]


def test_new_and_refreshed_subscription(spark):
    this_run = _sub_events(spark, [("c1", "s1", "u", "2024-01-05 00:00:00", "subscribe", 10.0),
                                   ("c2", "s2", "u", "2024-01-06 00:00:00", "subscribe", 5.0),
                                   ("c3", "s2", "u", "2024-02-06 00:00:00", "renew", 5.0)])
    subs = sub.build_subscriptions(this_run, CFG)
    existing = spark.createDataFrame(
        [("s2", "null", "u", ts("2024-01-06 00:00:00"), "subscription", ts("2023-12-07 00:00:00"), 5.0,
          ["Direct"], ["Direct"], ["x"], ["x"])],
        "cv_id string, event_id string, customer_id string, cv_tstamp timestamp_ntz, cv_type string, "
        "cv_path_start_tstamp timestamp_ntz, revenue double, channel_path array<string>, "
        "channel_transformed_path array<string>, campaign_path array<string>, "
        "campaign_transformed_path array<string>")
    new = pth.new_subscription_conversions(subs, this_run, mapping(spark), CFG, existing_paths=existing)
    n = new.collect()
    assert [(r.cv_id, r.event_id, r.cv_type, r.revenue) for r in n] == [("s1", "null", "subscription", 10.0)]
    stored = existing.withColumn("cv_tstamp_date", F.to_date("cv_tstamp"))
    ref = pth.refresh_revenue(stored, subs, inc.stored_dates(stored, this_run, CFG), CFG).collect()
    assert len(ref) == 1 and ref[0].revenue == 10.0
    assert ref[0].cv_tstamp == ts("2024-01-06 00:00:00") and ref[0].channel_path == ["Direct"]


def test_merge_replaces_whole_rows(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    upd = spark.createDataFrame([("a", 10, None), ("c", 3, "z")], "k string, v int, w string")
    out = {r.k: (r.v, r.w) for r in upsert_frames(target, upd, ["k"]).collect()}
    assert out == {"a": (10, None), "b": (2, "y"), "c": (3, "z")}
    again = {r.k: (r.v, r.w) for r in upsert_frames(upsert_frames(target, upd, ["k"]), upd, ["k"]).collect()}
    assert again == out  # idempotent


def test_merge_appends_columns(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    upd = spark.createDataFrame([("b", 2, 7.0)], "k string, v int, extra double")
    out = {r.k: r.extra for r in upsert_frames(target, upd, ["k"]).collect()}
    assert out == {"a": None, "b": 7.0}


def _attr(spark, rows, dim="channel"):
    return spark.createDataFrame(rows, f"{dim} string, cv_tstamp timestamp_ntz")


def _spend(spark, rows):
    return spark.createDataFrame(rows, "spend_tstamp timestamp_ntz, channel string, campaign string, spend double")


def test_spend_window_strict_and_counted_once(spark):
    cv = ts("2024-06-01 12:00:00")
    attr = _attr(spark, [("A", cv), ("A", cv + dt.timedelta(hours=1)), ("A", cv + dt.timedelta(hours=2)),
                         ("B", cv)])
    spend = _spend(spark, [
        (cv - dt.timedelta(days=90), "B", None, 1.0),                       # exactly 90 days: out
        (cv, "B", None, 2.0),                                               # at the conversion: out
        (cv - dt.timedelta(days=89, hours=23), "B", None, 4.0),             # inside: in
        (cv - dt.timedelta(days=1), "A", None, 8.0),                        # three conversions: once
        (cv - dt.timedelta(days=1), None, None, 16.0),                      # no channel: out
    ])
    got = {r.channel: r.spend for r in ov.scoped_spend(spend, attr, "channel", CFG).collect()}
    assert got == {"A": 8.0, "B": 4.0}


def test_spend_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    attr_rows = [(rnd.choice("ABC"), base + dt.timedelta(minutes=rnd.randrange(0, 400 * 1440)))
                 for _ in range(300)]
    spend_rows = [(base + dt.timedelta(minutes=rnd.randrange(-100 * 1440, 400 * 1440)), rnd.choice("ABC"), None,
                   float(rnd.randrange(1, 100))) for _ in range(300)]
    expected: dict[str, float] = {}
    for s_ts, ch, _, amount in spend_rows:
        if any(a_ch == ch and s_ts < a_ts < s_ts + dt.timedelta(days=90) for a_ch, a_ts in attr_rows):
            expected[ch] = expected.get(ch, 0.0) + amount
    got = {r.channel: r.spend for r in
           ov.scoped_spend(_spend(spark, spend_rows), _attr(spark, attr_rows), "channel", CFG).collect()}
    assert got == pytest.approx(expected)


def test_roas(spark):
    prep_cols = {"cv_id": "a", "event_id": "e", "cv_tstamp": ts("2024-01-01 00:00:00"), "cv_type": "purchase"}
    rows = []
    for ch in ("X", "Y", "Z"):
        rows.append({**prep_cols, "channel": ch, "first_touch_attribution": 1.0, "last_touch_attribution": 1.0,
                     "linear_attribution": 1.0, "position_based_attribution": 1.0, "cv_total_revenue": 100.0,
                     **{f"{m}_attribution_revenue": 100.0 for m in ov.WEIGHT_MODELS},
                     **{f"{e}_{m}_attribution{r}": None for e in CFG.subscription_events
                        for m in ov.WEIGHT_MODELS for r in ("", "_revenue")}})
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'timestamp_ntz' if k == 'cv_tstamp' else 'double'}"
                       for k, v in rows[0].items())
    prep = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    spend = spark.createDataFrame([("X", 50.0), ("Y", 0.0)], "channel string, spend double")
    rep = ov.touch_point_report(prep, "channel", CFG, spend)
    got = {r.touch_point: r.ROAS for r in rep.filter("attribution_type = 'linear'").collect()}
    assert got == {"X": 2.0, "Y": None, "Z": None}


def test_path_transforms(spark):
    df = spark.createDataFrame([(["a", "a", "b", "a", "b", "b"],)], "p array<string>")
    r = df.select(unique_path(F.col("p")).alias("u"), collapse_repeats(F.col("p")).alias("c")).collect()[0]
    assert r.u == ["a", "b"]
    assert r.c == ["a", "b", "a", "b"]


def test_config_rejects_empty_model_list():
    with pytest.raises(ValueError):
        AttributionConfig(attribution_list=())


def test_hot_customer_paths_match_brute_force(spark):
    """One customer holds a third of all views and conversions; bucketing
    must neither lose nor duplicate touchpoints, for any bucket width."""
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    users = ["hot"] * 20 + [f"u{i}" for i in range(40)]
    vrows = [(f"v{i:04d}", rnd.choice(users), (base + dt.timedelta(minutes=rnd.randrange(0, 90 * 1440))).isoformat(),
              f"c{rnd.randrange(4)}", rnd.choice(["cpc", "email", None])) for i in range(600)]
    crows = [(f"cv{i:03d}", None, rnd.choice(users), (base + dt.timedelta(minutes=rnd.randrange(0, 90 * 1440))).isoformat(),
              "purchase", 1.0) for i in range(90)]
    expected = {}
    for cid, _, u, t, _, _ in crows:
        cts = ts(t)
        hits = sorted((ts(vt), vid, camp) for vid, vu, vt, camp, _ in vrows
                      if vu == u and ts(vt) <= cts and (cts.date() - ts(vt).date()).days <= 30)
        if hits:
            expected[cid] = [h[2] for h in hits]
    assert sum(1 for c in crows if c[2] == "hot") >= 20
    for b in (1, 8, 40):
        got = _paths(spark, crows, vrows, CFG.with_(join_bucket_days=b))
        assert {k: v.campaign_path for k, v in got.items()} == expected


def test_stored_upsert_moves_key_and_drops_empty_partition(spark):
    """A late event moves a subscription's start (its partition) earlier:
    the old row must go, and a partition left empty must disappear."""
    from pathcredit.session import new_state_dir
    from pathcredit.sources.tables import TableStore
    store = TableStore(spark, new_state_dir(spark, "test-upsert"))
    schema = "k string, v int, d date"
    first = spark.createDataFrame([("a", 1, dt.date(2024, 1, 2)), ("b", 2, dt.date(2024, 1, 3))], schema)
    store.upsert("t", first, ["k"], "d")
    moved = spark.createDataFrame([("a", 10, dt.date(2024, 1, 1)), ("c", 3, dt.date(2024, 1, 3))], schema)
    out = store.upsert("t", moved, ["k"], "d")
    snapshot = sorted(tuple(map(str, r)) for r in out.collect())
    assert sorted((r.k, r.v, str(r.d)) for r in out.collect()) == [
        ("a", 10, "2024-01-01"), ("b", 2, "2024-01-03"), ("c", 3, "2024-01-03")]
    assert sorted(str(r.d) for r in out.select("d").distinct().collect()) == ["2024-01-01", "2024-01-03"]
    # Same updates again: nothing changes (a DataFrame read before a rewrite
    # lists files that are gone, so compare collected rows).
    again = store.upsert("t", moved, ["k"], "d")
    assert sorted(tuple(map(str, r)) for r in again.collect()) == snapshot


def test_stored_upsert_with_null_partition_value(spark):
    from pathcredit.session import new_state_dir
    from pathcredit.sources.tables import TableStore
    store = TableStore(spark, new_state_dir(spark, "test-upsert-null"))
    schema = "k string, v int, d date"
    store.upsert("t", spark.createDataFrame([("a", 1, None), ("b", 2, dt.date(2024, 1, 3))], schema), ["k"], "d")
    out = store.upsert("t", spark.createDataFrame([("a", 5, dt.date(2024, 1, 3))], schema), ["k"], "d")
    assert sorted((r.k, r.v, str(r.d)) for r in out.collect()) == [("a", 5, "2024-01-03"), ("b", 2, "2024-01-03")]
