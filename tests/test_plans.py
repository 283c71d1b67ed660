"""Plan-shape checks: the scale properties the README promises, read from the
static physical plan (AQE off, so the plan is the one Catalyst chose)."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from pathcredit.operators import attribution as att
from pathcredit.operators import overview as ov
from pathcredit.operators import paths as pth
from pathcredit.operators import subscriptions as sub
from pathcredit.operators import touchpoints as tpo
from pathcredit.plans import queries as Q
from pathcredit.plans.pipeline import Pipeline
from pathcredit.session import new_state_dir
from pathcredit.sources import fixtures as fx
from pathcredit.streaming import incremental as inc


@contextlib.contextmanager
def static_plans(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else a scan's text ends within its filters
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipe(spark, sf_small):
    return Pipeline(fx.load_inputs(spark, sf_small), Q.BASE_CFG, materialize=False)


def test_path_join_is_keyed_on_customer_and_block(spark, pipe):
    with static_plans(spark):
        convs = pipe.ordinary.unionByName(pipe.new_subscriptions)
        p = plan(pth.paths_to_conversion(convs, pipe.touchpoints, pipe.cfg))
    smj = [line for line in p.splitlines() if "SortMergeJoin" in line and "_block" in line]
    assert smj, p
    assert "customer_id" in smj[0] and "Inner" in smj[0]
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_row_for_each_conversion_and_touch(spark, pipe):
    """What is shuffled after the path join is a row for each conversion and block: the touches come as one array
    row per customer and block, made before the join, and are cut by position, not exploded and collected again."""
    convs = pipe.ordinary.unionByName(pipe.new_subscriptions)
    with static_plans(spark):
        p = plan(pth.paths_to_conversion(convs, pipe.touchpoints, pipe.cfg))
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "_block" in line and "Inner" in line)
    above, below = lines[:join], lines[join:]
    assert sum("Exchange" in line for line in above) == 1 and not any("Generate" in line for line in above)
    assert any("slice(_touches" in line for line in above)
    assert any("collect_list" in line and "visit_start_tstamp" in line for line in below)
    blocks = -(-(pipe.cfg.path_lookback_days + 1) // pipe.cfg.join_bucket_days) + 1
    segments = pth.path_segments(convs, pipe.touchpoints, pipe.cfg)
    sizes = segments.agg(F.count("*").alias("rows"), F.sum(F.size("_segment")).alias("touches"), F.countDistinct("cv_id").alias("paths")).first()
    assert sizes.rows <= blocks * sizes.paths and sizes.touches > 4 * sizes.rows


def test_no_window_operators_and_no_python(spark, pipe):
    with static_plans(spark):
        p = plan(pipe.overview(with_spend=True))
    for op in ("Window", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert f"{op} " not in p and f"{op}[" not in p, op


def test_spend_meets_the_finished_report(spark, pipe):
    """The spend join sees one row per touch point: it stands above the report's aggregate."""
    with static_plans(spark):
        w = ov.window_bound(pipe.campaign_attributions, pipe.cfg)
        sp = ov.scoped_spend(pipe.inputs.spend, pipe.channel_attributions, "channel", pipe.cfg)
        prep = ov.overview_prep(pipe.channel_attributions, "channel", pipe.subscriptions, w, pipe.cfg)
        lines = plan(ov.touch_point_report(prep, "channel", pipe.cfg, sp)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "_sp_touch" in line)
    report = next(i for i, line in enumerate(lines) if "HashAggregate(keys=[channel" in line and "min(cv_tstamp" in line)
    assert join < report
    assert not any("Broadcast" in line for line in lines)


def test_incremental_scope_and_views_prune_partitions(spark, sf_small, tmp_path):
    state = new_state_dir(spark, "test-scope")
    inputs = fx.load_inputs(spark, sf_small)
    inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "r")
    paths = inc.read_table(spark, state, inc.PATHS)
    inputs.views.withColumn("derived_tstamp_date", F.to_date("derived_tstamp")).write.partitionBy("derived_tstamp_date").parquet(str(tmp_path / "v"))
    with static_plans(spark):
        scope = plan(att.attribution_scope(paths, None, None, Q.LAST_SUCCESS, Q.BASE_CFG.with_(path_lookback_days=3)))
        views = plan(tpo.touchpoints(spark.read.parquet(str(tmp_path / "v")), inputs.user_mapping, Q.BASE_CFG, since=Q.LAST_SUCCESS))
    assert "(cv_tstamp_date#" in scope.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "Join" not in scope
    assert "(derived_tstamp_date#" in views.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_filters_reach_the_scan(spark, pipe):
    with static_plans(spark):
        p = plan(pipe.touchpoints)
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [click,view])" in p or \
           "In(event_type, [click,view])" in p, p


def test_stored_tables_prune_partitions(spark, sf_small):
    state = new_state_dir(spark, "test-plans")
    inc.run_incremental(spark, fx.load_inputs(spark, sf_small), state, Q.BASE_CFG, "r")
    attr = inc.read_table(spark, state, inc.CAMPAIGN_ATTR)
    with static_plans(spark):
        p = plan(attr.filter(ov.window_bound(attr, Q.BASE_CFG.with_(conversion_window_days=3))))
    filters = p.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "isnotnull(cv_tstamp_date" in filters and ">= 20" in filters, p


def test_revenue_refresh_reads_only_the_dates_of_touched_subscriptions(spark, sf_small):
    state = new_state_dir(spark, "test-refresh")
    inputs = fx.load_inputs(spark, sf_small)
    inc.run_incremental(spark, Q._cut_inputs(inputs, Q.CUT), state, Q.BASE_CFG, "run1")
    store = inc.TableStore(spark, state)
    paths, subs = store.read(inc.PATHS), store.read(inc.SUBSCRIPTIONS)
    one = store.read(inc.THIS_RUN).orderBy("subscription_id").limit(1)
    dates = store.stage("dates", inc.stored_dates(paths, one, Q.BASE_CFG))
    refreshed = pth.refresh_revenue(paths, subs, dates, Q.BASE_CFG)
    scan = next(line for line in plan(refreshed).splitlines() if "FileScan" in line and "cv_path_start_tstamp" in line)
    assert "dynamicpruningexpression(cv_tstamp_date#" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert [r.cv_id for r in refreshed.collect()] == [r.cv_id for r in dates.collect()]
    with static_plans(spark):  # which dates those are is read from the ids alone
        ids = plan(inc.stored_dates(paths, store.read(inc.THIS_RUN), Q.BASE_CFG))
    assert "ReadSchema: struct<cv_id:string>" in ids


def test_marks_and_uniqueness_come_with_the_writes(spark, sf_small):
    """The run's marks are observed while its tables are written: no scan of the run's events or paths for a maximum."""
    state = new_state_dir(spark, "test-jobs")
    inputs = fx.load_inputs(spark, sf_small)
    inc.run_incremental(spark, Q._cut_inputs(inputs, Q.CUT), state, Q.BASE_CFG, "run1")
    seen = []
    whole = type(spark.range(1)).agg

    def agg(self, *exprs):
        seen.append([str(e) for e in exprs])
        return whole(self, *exprs)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark.range(1)), "agg", agg)
        inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "run2")
    assert not any("max(cv_tstamp)" in e or "max(cv_path_start" in e for es in seen for e in es)
    store = inc.TableStore(spark, state)
    latest = store.read(inc.PATHS).agg(F.max("cv_tstamp"), F.max("cv_path_start_tstamp")).first()
    marks = inc.Manifest(store).read()
    assert (marks[inc.ATTRIBUTION_MARK], marks[inc.PATHS_MARK]) == tuple(latest)


def test_a_run_refuses_repeated_conversions(spark, sf_small):
    """Found by the key's count in the upsert's own join, before the run is visible."""
    state = new_state_dir(spark, "test-repeated")
    inputs = fx.load_inputs(spark, sf_small)
    inc.run_incremental(spark, Q._cut_inputs(inputs, Q.CUT), state, Q.BASE_CFG, "run1")
    before = inc.read_table(spark, state, inc.PATHS).count()
    late = inputs.conversions.filter("cv_type = 'signup'").orderBy(F.col("cv_tstamp").desc()).limit(1)
    twice = inputs.conversions.unionByName(late.withColumn("event_id", F.lit("another")))
    with pytest.raises(ValueError, match="cv_id must be unique"):
        inc.run_incremental(spark, fx.Inputs(views=inputs.views, conversions=twice, user_mapping=inputs.user_mapping, spend=None), state, Q.BASE_CFG, "run2")
    assert inc.read_table(spark, state, inc.PATHS).count() == before


def test_devices_are_assigned_once_and_never_shuffled_again(spark, sf_small):
    pipe = Pipeline(fx.load_inputs(spark, sf_small), Q.BASE_CFG)
    lazy = Pipeline(fx.load_inputs(spark, sf_small), Q.BASE_CFG, materialize=False)
    with static_plans(spark):
        for stage in ("touchpoints", "ordinary", "new_subscriptions"):
            ours, plain = plan(getattr(pipe, stage)), plan(getattr(lazy, stage))
            shuffled = [x in p for p in (ours, plain) for x in ("hashpartitioning(_um_ui", "ReusedExchange [_um_ui")]
            assert "Bucketed: true" in ours and not any(shuffled[:2]) and any(shuffled[2:])
    pipe.cleanup()


def test_a_repeated_device_is_refused_as_its_bucket_is_written(spark, sf_small):
    inputs = fx.load_inputs(spark, sf_small)
    twice = inputs.user_mapping.unionByName(inputs.user_mapping.limit(1))
    with pytest.raises(ValueError, match="user_identifier must be unique"):
        Pipeline(fx.Inputs(views=inputs.views, conversions=inputs.conversions, user_mapping=twice), Q.BASE_CFG).mapping


def test_a_ledger_is_read_by_the_buckets_of_touched_subscriptions(spark, sf_small):
    cfg = Q.BASE_CFG.with_(subscription_ledger_buckets=16)
    store = inc.TableStore(spark, new_state_dir(spark, "test-ledger"))
    inputs = fx.load_inputs(spark, sf_small)
    whole = inc.events_by_ledger(store, inputs, cfg, cfg.start_date)
    assert whole.count() == 162  # FIXTURES.md: subscription events of a first build
    ledger = store.read("subscription_ledger_16")
    one = ledger.select("subscription_id").orderBy("subscription_id").limit(1)
    events = sub.ledger_events(ledger, one, cfg)
    with static_plans(spark):
        scans = [line for line in plan(events).splitlines() if "FileScan" in line and "cv_value" in line]
    filters = scans[0].split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "bucket#" in filters and len(scans) == 1
    mine = one.first()[0]
    assert events.count() == inputs.conversions.filter(F.col("subscription_id") == mine).count()
    # the next run writes only the buckets of its events anew
    n = store.number
    inc.events_by_ledger(store, inputs, cfg, Q.LAST_SUCCESS + (Q.dt.timedelta(days=9, hours=18)))
    parts = store.tables["subscription_ledger_16"].parts
    assert {v for v in parts.values()} == {1, n} and sum(v == 1 for v in parts.values()) > 0
