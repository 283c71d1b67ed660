"""
DuckDB oracle. Every query reads the driver's ``events`` table (through the
fixture adapter) in full; nothing runs on made-up input.

Fixture configuration (FIXTURES.md): start 2024-01-01, 30-day path lookback,
6-hour late window. Paths, attributions and reports are first builds: no mark,
every subscription since the start. Only the queries of the operators that a
mark bounds (O2-O6, O13) set ``last_success`` to 2024-01-20 00:00.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AttributionConfig, ChannelRule
from ..functions.columns import collapse_repeats, string_to_path, unique_path
from ..operators import attribution as att
from ..operators import overview as ov
from ..operators import paths as pth
from ..operators import subscriptions as sub
from ..operators import touchpoints as tpo
from ..session import new_state_dir
from ..sources import fixtures as fx
from ..sources.catalog import read_source, write_sink
from ..streaming import incremental as inc
from . import oracle as o
from .pipeline import Pipeline

LAST_SUCCESS = dt.datetime(2024, 1, 20)
SINCE = LAST_SUCCESS - dt.timedelta(hours=6)
BASE_CFG = AttributionConfig()
SUB_EVENTS = BASE_CFG.subscription_events
WINDOW_START = dt.datetime(2024, 1, 10)
WINDOW_END = dt.datetime(2024, 1, 25)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Round double columns to 6 places with the same IEEE formula as the
    oracle, ``floor(x * 1e6 + 0.5001) / 1e6``. Built-in ``round`` differs
    between engines on exact halves, and 2-decimal revenues times dyadic
    weights (1/2^k) land on exact halves often; the 1e-10 bias makes a
    1-ulp summation-order difference round the same way on both sides."""
    return df.select(*[(F.floor(F.col(c) * 1e6 + 0.5001) / 1e6).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def _pipe(spark: SparkSession, sf_dir: str, with_spend: bool = True, **changes) -> Pipeline:
    """A first build over all data."""
    cfg = BASE_CFG.with_(**changes) if changes else BASE_CFG
    return Pipeline(fx.load_inputs(spark, sf_dir, with_spend), cfg)


def _marked(spark: SparkSession, sf_dir: str) -> Pipeline:
    """A build of the subscriptions touched since the mark."""
    return Pipeline(fx.load_inputs(spark, sf_dir, with_spend=False), BASE_CFG, LAST_SUCCESS)


# --- column lists shared by both sides ---------------------------------------
SUB_COLS = (["subscription_id", "user_identifier", "user_id", "stitched_user_id", "subscription_start_tstamp",
             "last_subscription_event_tstamp", "revenue"] + [f"{e}_count" for e in SUB_EVENTS]
            + [f"{e}_revenue" for e in SUB_EVENTS])
SUB_DOUBLES = ["revenue"] + [f"{e}_revenue" for e in SUB_EVENTS]
ATTR_DOUBLES = ["cv_total_revenue", "first_touch_attribution", "last_touch_attribution", "linear_attribution",
                "position_based_attribution"]
PATH_SQL_COLS = ("cv_id, event_id, customer_id, cv_tstamp, cv_type, cv_tstamp_date, cv_path_start_tstamp, revenue, "
                 "channel_path, channel_transformed_path, campaign_path, campaign_transformed_path")
MODELS = ("first_touch", "last_touch", "linear", "position_based")
PREP_DOUBLES = ([f"{m}_attribution" for m in MODELS] + ["cv_total_revenue"]
                + [f"{m}_attribution_revenue" for m in MODELS]
                + [f"{e}_{m}_attribution{r}" for e in SUB_EVENTS for r in ("", "_revenue") for m in MODELS]
                + ["spend"])
REPORT_DOUBLES = (["attributed_conversions", "spend", "sum_cv_total_revenue", "attributed_revenue"]
                  + [f"{e}_attributed_conversions" for e in SUB_EVENTS]
                  + [f"{e}_attributed_revenue" for e in SUB_EVENTS])

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None, doubles=()):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = o.round_doubles(sql, list(doubles))
        return run
    return deco


# --- shared oracle steps ------------------------------------------------------
START = BASE_CFG.start_date - dt.timedelta(hours=BASE_CFG.lookback_window_hours)


def _path_steps(stitching=False, **journey) -> list[str]:
    return (o.adapter() + o.billing(START) + [o.touches(stitching=stitching)] + o.goals(stitching=stitching)
            + [o.journeys(**journey)])


def _credit_steps() -> list[str]:
    return _path_steps() + [o.credits("channel"), o.credits("campaign")]


def _paid_steps() -> list[str]:
    return _credit_steps() + [o.paid("channel"), o.paid("campaign")]


# --- O1-O6 subscriptions ------------------------------------------------------

@register("conversion_extract", o.with_ctes(o.adapter() + ["""raw AS (
  SELECT 'e' || event_id AS event_id, ui AS user_identifier, ts AS derived_tstamp, event_type, k,
         round(value, 2) AS price, 's' || user_id || '-' || (event_id % 3) AS sub_id
  FROM ev_raw)"""], "\nUNION ALL\n".join(
    [f"""SELECT event_id || '_{e}' AS cv_id, event_id, user_identifier, sub_id AS subscription_id,
       derived_tstamp AS cv_tstamp, '{e}' AS cv_type, price AS cv_value
FROM raw WHERE event_type = 'purchase' AND k % 4 = {i}""" for i, e in enumerate(SUB_EVENTS)]
    + ["""SELECT event_id || '_purchase', event_id, user_identifier, NULL, derived_tstamp, 'purchase', price
FROM raw WHERE event_type = 'purchase' AND k % 4 = 3""",
       """SELECT event_id || '_signup', event_id, user_identifier, NULL, derived_tstamp, 'signup', CAST(NULL AS DOUBLE)
FROM raw WHERE event_type = 'signup'"""])), ["cv_value"])
def q_conversion_extract(spark, sf_dir):
    """O1: conversion definitions over tracker-shaped events."""
    raw = fx.raw_events(spark, sf_dir)
    return sub.extract_conversions(raw, fx.FIXTURE_CONVERSION_DEFS, fx.FIXTURE_PASSTHROUGHS)


@register("touched_subscriptions", o.with_ctes(o.adapter() + o.billing(SINCE), "SELECT DISTINCT subscription_id FROM billed"))
def q_touched(spark, sf_dir):
    """O2: subscriptions with an event since the mark minus 6 hours."""
    return _marked(spark, sf_dir).touched


@register("subscription_events", o.with_ctes(o.adapter() + o.billing(SINCE), "FROM billed"), ["cv_value"])
def q_subscription_events(spark, sf_dir):
    """O3: full history of the touched subscriptions."""
    return _marked(spark, sf_dir).this_run.select(
        "cv_id", "event_id", "subscription_id", "user_identifier", "user_id", "stitched_user_id",
        "cv_tstamp", "cv_type", "cv_value")


@register("subscription_first_event", o.with_ctes(
    o.adapter() + o.billing(SINCE),
    "SELECT subscription_id, user_identifier, user_id, stitched_user_id, subscription_start_tstamp AS cv_tstamp, "
    "first_type AS cv_type, first_value AS cv_value FROM plans"), ["cv_value"])
def q_first_event(spark, sf_dir):
    """First event per subscription."""
    p = _marked(spark, sf_dir)
    return sub.first_subscription_event(p.this_run, p.cfg)


@register("subscription_rollup", o.with_ctes(
    o.adapter() + o.billing(SINCE),
    "SELECT subscription_id, last_subscription_event_tstamp, "
    + ", ".join(f"{e}_count" for e in SUB_EVENTS) + ", " + ", ".join(f"{e}_revenue" for e in SUB_EVENTS)
    + ", revenue FROM plans"), SUB_DOUBLES)
def q_rollup(spark, sf_dir):
    """Per-subscription counts and revenue."""
    p = _marked(spark, sf_dir)
    return sub.subscription_rollup(p.this_run, p.cfg)


@register("subscriptions", o.with_ctes(o.adapter() + o.billing(SINCE), f"SELECT {o.plan_columns()} FROM plans"), SUB_DOUBLES)
def q_subscriptions(spark, sf_dir):
    """The subscriptions table (of those touched since the mark)."""
    return _marked(spark, sf_dir).subscriptions.select(*SUB_COLS)


@register("subscriptions_all", o.with_ctes(o.adapter() + o.billing(START), f"SELECT {o.plan_columns()} FROM plans"), SUB_DOUBLES)
def q_subscriptions_all(spark, sf_dir):
    """The subscriptions table of a first build."""
    return _pipe(spark, sf_dir).subscriptions.select(*SUB_COLS)


# --- O7-O11 touchpoints -------------------------------------------------------

@register("customer_resolution", o.with_ctes(o.adapter(), """SELECT ev.cv_id, ev.user_identifier,
       coalesce(um.user_id, ev.user_identifier) AS customer_id
FROM conversions ev LEFT JOIN user_mapping um ON um.user_identifier = ev.user_identifier"""))
def q_customer_resolution(spark, sf_dir):
    """Mapped user id, else the device id."""
    inp = fx.load_inputs(spark, sf_dir, with_spend=False)
    return tpo.resolve_customer(inp.conversions, inp.user_mapping, BASE_CFG).select(
        "cv_id", "user_identifier", "customer_id")


def _tp_sql(**opts) -> str:
    return o.with_ctes(o.adapter() + [o.touches(**opts)], "FROM touches")


@register("touchpoints", _tp_sql())
def q_touchpoints(spark, sf_dir):
    """Touchpoints with channel and campaign."""
    return _pipe(spark, sf_dir).touchpoints


@register("touchpoints_hosts", _tp_sql(hosts=("shop.a.test",)))
def q_touchpoints_hosts(spark, sf_dir):
    """Host restriction."""
    return _pipe(spark, sf_dir, conversion_hosts=("shop.a.test",)).touchpoints


@register("touchpoints_intrasession", _tp_sql(intrasession=True))
def q_touchpoints_intrasession(spark, sf_dir):
    """One touchpoint per channel change within a session."""
    return _pipe(spark, sf_dir, consider_intrasession_channels=True).touchpoints


# --- O12-O19 paths ------------------------------------------------------------

@register("ordinary_conversions", o.with_ctes(o.adapter() + o.billing(START) + o.goals(), "FROM plain_goals"), ["revenue"])
def q_ordinary(spark, sf_dir):
    """Non-subscription conversions."""
    return _pipe(spark, sf_dir).ordinary


@register("new_subscriptions", o.with_ctes(o.adapter() + o.billing(SINCE) + o.goals(), "FROM plan_goals"), ["revenue"])
def q_new_subscriptions(spark, sf_dir):
    """Subscriptions touched since the mark as conversions (none has a path yet)."""
    return _marked(spark, sf_dir).new_subscriptions


def _paths_df(p: Pipeline) -> DataFrame:
    return pth.paths_as_strings(p.paths).select(*[c.strip() for c in PATH_SQL_COLS.split(",")])


@register("paths", o.with_ctes(_path_steps(), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths(spark, sf_dir):
    """Paths to conversion."""
    return _paths_df(_pipe(spark, sf_dir))


_ONLY = "t.channel <> 'Direct' AND t.campaign <> 'camp_5' AND t.campaign IN ('No campaign', 'camp_2', 'camp_3', 'camp_5')"


@register("paths_filtered", o.with_ctes(_path_steps(only=_ONLY), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths_filtered(spark, sf_dir):
    """Channel / campaign include and exclude lists shorten both paths."""
    return _paths_df(_pipe(spark, sf_dir, channels_to_exclude=("Direct",), campaigns_to_exclude=("camp_5",),
                           campaigns_to_include=("No campaign", "camp_2", "camp_3", "camp_5")))


@register("paths_unique", o.with_ctes(_path_steps(rewrite="first"), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths_unique(spark, sf_dir):
    """A path transform (first occurrence of each touch point)."""
    return _paths_df(_pipe(spark, sf_dir, path_transforms=(unique_path,)))


@register("paths_collapsed", o.with_ctes(_path_steps(rewrite="runs"), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths_collapsed(spark, sf_dir):
    """A path transform (runs of one touch point collapsed)."""
    return _paths_df(_pipe(spark, sf_dir, path_transforms=(collapse_repeats,)))


@register("paths_stitched", o.with_ctes(_path_steps(stitching=True), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths_stitched(spark, sf_dir):
    """O7 with stitching: the stitched id is the customer, no mapping join."""
    return _paths_df(_pipe(spark, sf_dir, conversion_stitching=True))


#: Labels that hold the separator, its sign or the escape sign, and what stands for them in a path's text.
_ODD_LABELS = {"Paid_Search": ("Paid > Search", r"Paid \> Search"), "Email": (r"\> Email >", r"\\> Email \>"), "Social": (">", r"\>")}


def _odd(side: int) -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v[side]}'" for k, v in _ODD_LABELS.items())
    return f"list_transform(channels, lambda c: CASE c {names} ELSE c END)"


@register("paths_reversible", o.with_ctes(_path_steps(), f"""SELECT cv_id, array_to_string({_odd(1)}, ' > ') AS channel_path,
       CAST(len(channels) AS BIGINT) AS n_labels, array_to_string({_odd(0)}, '|') AS labels FROM journeys"""))
def q_paths_reversible(spark, sf_dir):
    """O19 both ways: channels with the separator in their names, written as one text and read back from it."""
    rules = tuple(ChannelRule(r.condition, _ODD_LABELS[r.label][0]) for r in BASE_CFG.channel_rules)
    text = pth.paths_as_strings(_pipe(spark, sf_dir, channel_rules=rules).paths).select("cv_id", "channel_path")
    back = string_to_path(F.col("channel_path"))
    return text.select("cv_id", "channel_path", F.size(back).cast("long").alias("n_labels"), F.array_join(back, "|").alias("labels"))


# --- O22-O25 attributions -----------------------------------------------------

@register("channel_attributions", o.with_ctes(_credit_steps(), "FROM channel_credits"), ATTR_DOUBLES)
def q_channel_attributions(spark, sf_dir):
    """O23-O25 for channels."""
    return _pipe(spark, sf_dir).channel_attributions


@register("campaign_attributions", o.with_ctes(_credit_steps(), "FROM campaign_credits"), ATTR_DOUBLES)
def q_campaign_attributions(spark, sf_dir):
    """O23-O25 for campaigns."""
    return _pipe(spark, sf_dir).campaign_attributions


_WEIGHT_CHECK_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{d}' AS path_type, cv_id, {", ".join(f"sum({m}_attribution) AS {m}" for m in MODELS)},
       count(*) AS n_rows
FROM {d}_credits GROUP BY cv_id""" for d in ("channel", "campaign"))


@register("attribution_weight_check", o.with_ctes(_credit_steps(), _WEIGHT_CHECK_SQL), list(MODELS))
def q_weight_check(spark, sf_dir):
    """Property: every model's weights sum to 1 per conversion."""
    p = _pipe(spark, sf_dir)
    parts = [p.attributions(d).groupBy("cv_id").agg(
        *[F.sum(f"{m}_attribution").alias(m) for m in MODELS], F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(d).alias("path_type"), "*") for d in ("channel", "campaign")]
    return parts[0].unionByName(parts[1])


# --- O26-O31 overview ---------------------------------------------------------

def _spend_q(dim: str):
    def q(spark, sf_dir):
        p = _pipe(spark, sf_dir)
        return ov.scoped_spend(p.inputs.spend, p.attributions(dim), dim, p.cfg)
    q.__doc__ = f"O26: {dim} spend with at least one conversion in the 90 days after it."
    return q


for _d in ("channel", "campaign"):
    register(f"spend_by_{_d}", o.with_ctes(_credit_steps() + [o.paid(_d)], f"FROM {_d}_paid"), ["spend"])(_spend_q(_d))


def _prep_q(dim: str):
    def q(spark, sf_dir):
        p = _pipe(spark, sf_dir)
        window = ov.window_bound(p.campaign_attributions, p.cfg)
        sp = ov.scoped_spend(p.inputs.spend, p.attributions(dim), dim, p.cfg)
        return ov.with_spend(ov.overview_prep(p.attributions(dim), dim, p.subscriptions, window, p.cfg), sp, dim)
    q.__doc__ = f"O27: per conversion and {dim}: weights, revenue, subscription events, spend."
    return q


for _d in ("channel", "campaign"):
    register(f"overview_prep_{_d}", o.with_ctes(_paid_steps() + [o.shares(_d, o.span())], o.shares_select(_d)), PREP_DOUBLES)(_prep_q(_d))


def _report_sql(with_spend=True, **window) -> str:
    steps = _paid_steps() if with_spend else _credit_steps()
    steps = steps + [o.shares(d, o.span(**window), with_spend) for d in ("channel", "campaign")]
    return o.with_ctes(steps, o.report(with_spend=with_spend))


@register("overview", _report_sql(), REPORT_DOUBLES + ["ROAS"])
def q_overview(spark, sf_dir):
    """The attribution overview with spend and ROAS."""
    return _pipe(spark, sf_dir).overview()


@register("overview_no_spend", _report_sql(with_spend=False), REPORT_DOUBLES)
def q_overview_no_spend(spark, sf_dir):
    """O29 without a spend source: null spend, no ROAS column."""
    return _pipe(spark, sf_dir, with_spend=False).overview(with_spend=False)


@register("overview_window", _report_sql(start=WINDOW_START, end=WINDOW_END), REPORT_DOUBLES + ["ROAS"])
def q_overview_window(spark, sf_dir):
    """Explicit reporting window [start, end)."""
    return _pipe(spark, sf_dir, conversion_window_start_date=WINDOW_START,
                 conversion_window_end_date=WINDOW_END).overview()


@register("overview_window_days", _report_sql(days=7), REPORT_DOUBLES + ["ROAS"])
def q_overview_window_days(spark, sf_dir):
    """The default window, of 7 days here so that it bites."""
    return _pipe(spark, sf_dir, conversion_window_days=7).overview()


@register("overview_roas", f"SELECT path_type, attribution_type, touch_point, attributed_revenue, spend, ROAS FROM ({_report_sql()}) r",
          ["attributed_revenue", "spend", "ROAS"])
def q_overview_roas(spark, sf_dir):
    """Return on ad spend per touch point and model."""
    return _pipe(spark, sf_dir).overview().select(
        "path_type", "attribution_type", "touch_point", "attributed_revenue", "spend", "ROAS")


@register("overview_from_tables", _report_sql(), REPORT_DOUBLES + ["ROAS"])
def q_overview_from_tables(spark, sf_dir):
    """2.2 scans and sinks by table name: the inputs are written to tables of the session's catalog, read from there
    by name, and the report is written to a table and read back."""
    path = new_state_dir(spark, "catalog")
    db = "pathcredit_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    inp = fx.load_inputs(spark, sf_dir)
    for name, partition_by in (("views", None), ("conversions", "cv_tstamp_date"), ("user_mapping", None), ("spend", None)):
        write_sink(getattr(inp, name), f"{db}.{name}", partition_by)
    read = fx.Inputs(**{name: read_source(spark, f"{db}.{name}") for name in ("views", "conversions", "user_mapping", "spend")})
    write_sink(Pipeline(read, BASE_CFG).overview(), f"{db}.report")
    return read_source(spark, f"{db}.report")


# --- O20-O22, O32-O36: the two-run incremental scenario -----------------------
# Run 1 is a first build over the data before CUT; run 2 sees everything and
# works from run 1's stored tables (FIXTURES.md: at sf0.01 run 1 knows 380
# subscriptions, run 2 touches 320 = 270 refreshed + 50 new). Each query runs
# its own scenario from the inputs.

CUT = dt.datetime(2024, 1, 20)
_CFG7 = BASE_CFG.with_(path_lookback_days=7)


def _cut_inputs(inp: fx.Inputs, cut: dt.datetime, late_views: bool = False) -> fx.Inputs:
    views = inp.views.filter(F.col("derived_tstamp") < cut)
    if late_views:  # every tenth view arrives after run 1
        views = views.filter(F.substring("view_id", 2, 20).cast("long") % 10 != 0)
    return fx.Inputs(views=views, conversions=inp.conversions.filter(F.col("cv_tstamp") < cut),
                     user_mapping=inp.user_mapping, spend=inp.spend)


def _scenario(spark: SparkSession, sf_dir: str, runs: int, cfg1: AttributionConfig = BASE_CFG,
              cfg2: AttributionConfig | None = None, late_views: bool = False) -> tuple[str, fx.Inputs]:
    """Run the scenario into a new state folder (on the shared folder named by ``spark.checkpoint.dir``)."""
    state = new_state_dir(spark, "scenario")
    inp = fx.load_inputs(spark, sf_dir)
    inc.run_incremental(spark, _cut_inputs(inp, CUT, late_views), state, cfg1, "run1")
    if runs == 2:
        inc.run_incremental(spark, inp, state, cfg2 or cfg1, "run2")
    return state, inp


def _plan_run2(spark, sf_dir, cfg=BASE_CFG) -> inc.RunPlan:
    state, inp = _scenario(spark, sf_dir, 1, cfg)
    return inc.plan_run(spark, inp, state, cfg)


def _final(spark, sf_dir, table: str, cfg1=BASE_CFG, cfg2=None, late_views=False) -> DataFrame:
    return inc.read_table(spark, _scenario(spark, sf_dir, 2, cfg1, cfg2, late_views)[0], table)


def _two(final: str, **kw) -> str:
    return o.with_ctes(o.two_runs(CUT, BASE_CFG.start_date, **kw), final)


def _paths_df_any(paths: DataFrame) -> DataFrame:
    return pth.paths_as_strings(paths).select(*[c.strip() for c in PATH_SQL_COLS.split(",")])


def _bounded(suffix: str, cfg: AttributionConfig) -> None:
    """The queries whose time bounds depend on the lookback."""
    days = cfg.path_lookback_days

    @register(f"paths_incremental{suffix}", _two(f"{o.PATH_SELECT} FROM journeys_new", lookback=days), ["revenue"])
    def q_paths_incremental(spark, sf_dir):
        """What run 2 upserts into paths: conversions since max(path start)
        minus 6 hours, new subscriptions, refreshed subscription revenue."""
        return _paths_df_any(_plan_run2(spark, sf_dir, cfg).paths_updates)

    @register(f"paths_revenue_refresh{suffix}", _two(f"{o.PATH_SELECT} FROM renewed", lookback=days), ["revenue"])
    def q_paths_revenue_refresh(spark, sf_dir):
        """Stored subscription paths re-emitted with current revenue."""
        return _paths_df_any(_plan_run2(spark, sf_dir, cfg).revenue_refresh)

    @register(f"incremental_two_runs{suffix}", _two(f"{o.PATH_SELECT} FROM journeys_now", lookback=days), ["revenue"])
    def q_incremental_two_runs(spark, sf_dir):
        """O20-O21 + O32: the paths table after two runs."""
        return _paths_df_any(_final(spark, sf_dir, inc.PATHS, cfg))


_bounded("", BASE_CFG)
_bounded("_7", _CFG7)  # here the bounds bite: run 1 has data before them


@register("incremental_two_runs_padded", _two(f"{o.PATH_SELECT} FROM journeys_now", lookback=7, padded=True), ["revenue"])
def q_incremental_two_runs_padded(spark, sf_dir):
    """O20 with ``pad_touchpoints``: every conversion in scope gets its whole window."""
    return _paths_df_any(_final(spark, sf_dir, inc.PATHS, _CFG7.with_(pad_touchpoints=True)))


@register("paths_rebuilt", o.with_ctes(_path_steps(), f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_paths_rebuilt(spark, sf_dir):
    """A run after the paths table alone was dropped builds the paths of all stored subscriptions."""
    state, inp = new_state_dir(spark, "scenario"), fx.load_inputs(spark, sf_dir)
    inc.run_incremental(spark, inp, state, BASE_CFG, "run1")
    inc.TableStore(spark, state).drop(inc.PATHS)
    inc.run_incremental(spark, inp, state, BASE_CFG, "run2")
    return _paths_df_any(inc.read_table(spark, state, inc.PATHS))


@register("attribution_incremental", _two("FROM channel_credits_2", lookback=7), ATTR_DOUBLES)
def q_attribution_incremental(spark, sf_dir):
    """Run 2 re-attributes recent conversions (7-day lookback here, so
    the bound bites) OR subscriptions touched this run."""
    return _plan_run2(spark, sf_dir, _CFG7).attribution_updates("channel", _CFG7)


@register("merge_subscriptions", _two(f"SELECT {o.plan_columns()} FROM plans_now"), SUB_DOUBLES)
def q_merge_subscriptions(spark, sf_dir):
    """Subscriptions after two runs (keyed upsert)."""
    return _final(spark, sf_dir, inc.SUBSCRIPTIONS).select(*SUB_COLS)


_CFG_LEDGER = BASE_CFG.with_(subscription_ledger_buckets=64)


@register("merge_subscriptions_ledger", _two(f"SELECT {o.plan_columns()} FROM plans_now"), SUB_DOUBLES)
def q_merge_subscriptions_ledger(spark, sf_dir):
    """O32 with O3 from a ledger: subscriptions after two runs."""
    return _final(spark, sf_dir, inc.SUBSCRIPTIONS, _CFG_LEDGER).select(*SUB_COLS)


@register("subscription_events_ledger", _two("FROM billed_2"), ["cv_value"])
def q_subscription_events_ledger(spark, sf_dir):
    """O3 from a ledger: run 2 reads the whole history of the subscriptions it touches from their buckets."""
    return _final(spark, sf_dir, inc.THIS_RUN, _CFG_LEDGER).select(
        "cv_id", "event_id", "subscription_id", "user_identifier", "user_id", "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")


@register("merge_attributions", _two("FROM channel_credits_now"), ATTR_DOUBLES)
def q_merge_attributions(spark, sf_dir):
    """Channel attributions after two runs (upsert on composite_key)."""
    return _final(spark, sf_dir, inc.CHANNEL_ATTR).select(*att.attribution_columns("channel"))


@register("merge_attributions_by_conversion", _two(
    "SELECT cv_id, count(*) AS n_rows, " + ", ".join(f"sum({m}_attribution) AS {m}" for m in MODELS)
    + " FROM channel_credits_now GROUP BY cv_id", by_conversion=True, late_views=True), list(MODELS))
def q_merge_attributions_by_conversion(spark, sf_dir):
    """O32 by ``cv_id``: with views that arrive late, each conversion's weights still sum to 1."""
    cfg = BASE_CFG.with_(attribution_replace_by_conversion=True)
    return _final(spark, sf_dir, inc.CHANNEL_ATTR, cfg, late_views=True).groupBy("cv_id").agg(
        F.count("*").alias("n_rows"), *[F.sum(f"{m}_attribution").alias(m) for m in MODELS])


@register("subscription_events_replaced", _two("FROM billed_2"), ["cv_value"])
def q_subscription_events_replaced(spark, sf_dir):
    """The table of this run's events holds only the last run's."""
    return _final(spark, sf_dir, inc.THIS_RUN).select(
        "cv_id", "event_id", "subscription_id", "user_identifier", "user_id", "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")


@register("paths_one_date", _two(f"{o.PATH_SELECT} FROM journeys_now WHERE CAST(cv_tstamp AS DATE) = DATE '2024-01-15'"), ["revenue"])
def q_paths_one_date(spark, sf_dir):
    """One date partition of the stored paths."""
    return _paths_df_any(_final(spark, sf_dir, inc.PATHS).filter(F.col("cv_tstamp_date") == F.lit(dt.date(2024, 1, 15))))


@register("manifest_advance", _two("""SELECT 'subscriptions' AS model, greatest((SELECT max(cv_tstamp) FROM billed_1), (SELECT max(cv_tstamp) FROM billed_2)) AS last_success
UNION ALL SELECT 'attribution', max(cv_tstamp) FROM journeys_now
UNION ALL SELECT 'paths', max(cv_path_start_tstamp) FROM journeys_now"""))
def q_manifest_advance(spark, sf_dir):
    """High-water marks after two runs."""
    return inc.Manifest(inc.TableStore(spark, _scenario(spark, sf_dir, 2)[0])).current()


_CFG_2EV = BASE_CFG.with_(subscription_events=("free_trial", "subscribe"))


@register("merge_schema_append", _two(f"SELECT {o.plan_columns()} FROM plans_now", events1=("free_trial", "subscribe")), SUB_DOUBLES)
def q_merge_schema_append(spark, sf_dir):
    """Run 2 configures a third subscription event; its columns are
    appended and stay null on rows run 2 did not rewrite."""
    return _final(spark, sf_dir, inc.SUBSCRIPTIONS, _CFG_2EV, BASE_CFG).select(*SUB_COLS)


@register("conversions_from_events", o.with_ctes(o.adapter() + ["""raw_goals AS (
  SELECT 'e' || event_id || '_' || kind AS cv_id, 'e' || event_id AS event_id, ui AS user_identifier, ts AS cv_tstamp, kind AS cv_type,
         CASE WHEN event_type = 'purchase' THEN round(value, 2) END AS cv_value
  FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 'signup' ELSE ['free_trial', 'subscribe', 'renew', 'purchase'][k % 4 + 1] END AS kind
        FROM ev_raw WHERE event_type IN ('purchase', 'signup')))"""] + o.billing(START, conv="(SELECT *, 's' || substr(user_identifier, 2) || '-' || (CAST(substr(event_id, 2) AS BIGINT) % 3) AS subscription_id, NULL AS user_id, user_identifier AS stitched_user_id FROM raw_goals)")
    + [o.touches()] + o.goals(conv="raw_goals") + [o.journeys()], f"{o.PATH_SELECT} FROM journeys"), ["revenue"])
def q_conversions_from_events(spark, sf_dir):
    """O1 into O15: conversions extracted from raw events, built into paths."""
    inp = fx.load_inputs(spark, sf_dir, with_spend=False)
    raw = fx.raw_events(spark, sf_dir)
    conversions = sub.conversions_for_run(sub.extract_conversions(raw, fx.FIXTURE_CONVERSION_DEFS, fx.FIXTURE_PASSTHROUGHS), None)
    return _paths_df(Pipeline(fx.Inputs(views=inp.views, conversions=conversions, user_mapping=inp.user_mapping, spend=None), BASE_CFG))
