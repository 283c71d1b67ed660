
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pathcredit.plans import queries as Q
from pathcredit.plans.pipeline import Pipeline
from pathcredit.session import new_state_dir
from pathcredit.sources import fixtures as fx
from pathcredit.streaming import incremental as inc


@pytest.fixture(scope="module")
def pipe(spark, sf_small):
    return Pipeline(fx.load_inputs(spark, sf_small), Q.BASE_CFG)


def test_fixture_counts(pipe):
    # FIXTURES.md, sf0.001 column.
    assert pipe.inputs.views.count() == 398
    assert pipe.inputs.conversions.count() == 401
    assert pipe.this_run.count() == 162
    assert pipe.subscriptions.count() == 43
    assert pipe.paths.count() == 261
    assert pipe.channel_attributions.count() == 4248
    marked = Pipeline(pipe.inputs, Q.BASE_CFG, Q.LAST_SUCCESS)
    assert marked.this_run.count() == 131
    assert marked.subscriptions.count() == 30
    marked.cleanup()


def test_weights_sum_to_one(pipe):
    for dim in ("channel", "campaign"):
        sums = pipe.attributions(dim).groupBy("cv_id").agg(
            *[F.sum(f"{m}_attribution").alias(m) for m in Q.MODELS])
        bad = sums.filter(" OR ".join(f"abs({m} - 1) > 1e-9" for m in Q.MODELS)).count()
        assert bad == 0


def test_paths_aligned_and_unique(pipe):
    p = pipe.paths
    assert p.filter(F.size("channel_path") != F.size("campaign_path")).count() == 0
    assert p.select("cv_id").distinct().count() == p.count()


def test_attributed_conversions_sum_to_conversions(pipe):
    rep = pipe.overview(with_spend=False)
    window = rep.agg(F.min("min_cv_tstamp")).collect()[0][0]
    assert window is not None
    per_model = {r.attribution_type: r.total for r in rep.filter("path_type = 'channel'")
                 .groupBy("attribution_type").agg(F.sum("attributed_conversions").alias("total")).collect()}
    mark = pipe.campaign_attributions.agg(F.max("cv_tstamp")).collect()[0][0]
    n_conv = pipe.paths.filter(F.col("cv_tstamp") >= F.lit(mark - dt.timedelta(days=30))).count()
    for m in Q.MODELS:
        assert per_model[m] == pytest.approx(n_conv)


def test_rerun_is_idempotent(spark, sf_small):
    inputs = fx.load_inputs(spark, sf_small)
    state = new_state_dir(spark, "test-idem")
    inc.run_incremental(spark, Q._cut_inputs(inputs, Q.CUT), state, Q.BASE_CFG, "run1")
    inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "run2")

    def snapshot():
        out = {}
        for t in (inc.SUBSCRIPTIONS, inc.PATHS, inc.CHANNEL_ATTR, inc.CAMPAIGN_ATTR):
            df = inc.read_table(spark, state, t)
            out[t] = sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())
        return out

    before = snapshot()
    marks = inc.Manifest(inc.TableStore(spark, state)).read()
    # Same data again: nothing new, so the tables must not change.
    inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "run3")
    assert snapshot() == before
    assert inc.Manifest(inc.TableStore(spark, state)).read() == marks


def test_first_run_builds_everything(spark, sf_small):
    inputs = fx.load_inputs(spark, sf_small)
    state = new_state_dir(spark, "test-first")
    rep = inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "only")
    assert rep.first_paths_build and rep.notes == ()
    subs = inc.read_table(spark, state, inc.SUBSCRIPTIONS)
    assert subs.count() == 43  # every subscription (FIXTURES.md: 43 distinct at sf0.001)


@pytest.mark.parametrize("opts", [{}, {"pad_touchpoints": True, "attribution_replace_by_conversion": True}])
def test_two_runs_equal_one_full_run(spark, sf_small, opts):
    """SURVEY 5.3: when both runs cover every subscription and no path crosses
    a lookback bound (the data spans 30 days), run 1 + run 2 = one full run."""
    cfg = Q.BASE_CFG.with_(**opts)
    inputs = fx.load_inputs(spark, sf_small)
    two = new_state_dir(spark, "test-two")
    inc.run_incremental(spark, Q._cut_inputs(inputs, Q.CUT), two, cfg, "run1")
    inc.run_incremental(spark, inputs, two, cfg, "run2")
    one = new_state_dir(spark, "test-one")
    inc.run_incremental(spark, inputs, one, cfg, "full")

    def rows(state, table, cols):
        df = inc.read_table(spark, state, table).select(*cols)
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    path_cols = ["cv_id", "cv_tstamp", "revenue", "channel_path", "campaign_path"]
    assert rows(two, inc.PATHS, path_cols) == rows(one, inc.PATHS, path_cols)
    attr_cols = ["composite_key", "cv_total_revenue", "linear_attribution", "position_based_attribution"]
    assert rows(two, inc.CHANNEL_ATTR, attr_cols) == rows(one, inc.CHANNEL_ATTR, attr_cols)
    sub_cols = ["subscription_id", "revenue", "renew_count", "subscription_start_tstamp"]
    assert rows(two, inc.SUBSCRIPTIONS, sub_cols) == rows(one, inc.SUBSCRIPTIONS, sub_cols)


def test_inputs_have_unique_keys(spark, sf_small):
    from pathcredit.sources.tables import duplicate_keys
    inputs = fx.load_inputs(spark, sf_small)
    assert duplicate_keys(inputs.conversions, ["cv_id"]).count() == 0
    assert duplicate_keys(inputs.user_mapping, ["user_identifier"]).count() == 0
    assert duplicate_keys(inputs.views, ["view_id"]).count() == 0


def test_run_with_nothing_touched(spark, sf_small):
    inputs = fx.load_inputs(spark, sf_small)
    state = new_state_dir(spark, "test-empty")
    r1 = inc.run_incremental(spark, inputs, state, Q.BASE_CFG, "run1")
    n_paths = inc.read_table(spark, state, inc.PATHS).count()
    early = fx.Inputs(views=inputs.views, user_mapping=inputs.user_mapping, spend=inputs.spend,
                      conversions=inputs.conversions.filter(F.col("cv_tstamp") < F.lit("2024-01-02")
                                                            .cast("timestamp_ntz")))
    r2 = inc.run_incremental(spark, early, state, Q.BASE_CFG, "run2")
    assert inc.read_table(spark, state, inc.THIS_RUN).count() == 0
    assert r2.subscriptions_mark == r1.subscriptions_mark
    assert inc.read_table(spark, state, inc.PATHS).count() == n_paths


def test_cli_run_and_report(spark, sf_small, capsys):
    import json

    from pathcredit.cli import main
    state = new_state_dir(spark, "test-cli")
    assert main(["run", "--state", state, "--fixtures", sf_small]) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["first_paths_build"] is True
    assert main(["report", "--state", state, "--fixtures", sf_small]) == 0
    rows = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert rows and {"path_type", "attribution_type", "touch_point", "ROAS"} <= set(rows[0])
    assert {r["attribution_type"] for r in rows} == set(Q.MODELS)


def test_a_merging_run_notes_what_parity_means(spark, sf_small):
    assert len(inc.notes_on(Q.BASE_CFG)) == 2 and "composite key" in inc.notes_on(Q.BASE_CFG)[0]
    assert inc.notes_on(Q.BASE_CFG.with_(attribution_replace_by_conversion=True, pad_touchpoints=True)) == ()
    assert "ledger" in inc.notes_on(Q.BASE_CFG.with_(subscription_ledger_buckets=8))[-1]
