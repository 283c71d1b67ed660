"""Paths to conversion.

A path is the time-ordered list of a customer's touchpoints in the
``path_lookback_days`` calendar days up to (and including) the conversion.

Physical plan (see README "Scale"): the touches of a customer within a block of
``join_bucket_days`` days are sorted once into one array row. A conversion is
replicated to the few blocks that its window overlaps (``ceil((L+1)/B)+1`` at
most), joins their rows on ``(customer_id, block)`` and cuts its part out of the
first and the last of them by binary search; those between lie in the window as
a whole. So what is shuffled afterwards is a row for each conversion and block,
never one for each conversion and touch, and no path is sorted again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SUBSCRIPTION_CV_TYPE, SUBSCRIPTION_EVENT_ID, AttributionConfig
from ..functions.columns import day_number, path_to_string, ts_lit
from .touchpoints import resolve_customer, touch_filters

CONVERSION_COLUMNS = ("cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type", "revenue")
PATH_COLUMNS = ("cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type", "cv_path_start_tstamp",
                "revenue", "channel_path", "channel_transformed_path", "campaign_path",
                "campaign_transformed_path")


def ordinary_conversions(conversions: DataFrame, mapping: DataFrame | None, cfg: AttributionConfig,
                         since: dt.datetime | None = None) -> DataFrame:
    """Conversions that are not subscription events (a null type drops
    out, as ``NOT x IN (...)`` does), optionally bounded below in time."""
    ev = conversions.alias("ev")
    cond = F.expr(f"({cfg.conversion_clause})") & ~F.col("ev.cv_type").isin(*cfg.subscription_events)
    if since is not None:
        cond = cond & (F.col("ev.cv_tstamp") >= ts_lit(since))
        if "cv_tstamp_date" in conversions.columns:
            cond = cond & (F.col("ev.cv_tstamp_date") >= F.lit(since.date()))
    c = ev.filter(cond).select("ev.*")
    c = resolve_customer(c, mapping, cfg)
    return c.select("cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type",
                    F.col("cv_value").cast("double").alias("revenue"))


def new_subscription_conversions(subscriptions: DataFrame, this_run: DataFrame | None,
                                 mapping: DataFrame | None, cfg: AttributionConfig,
                                 existing_paths: DataFrame | None = None) -> DataFrame:
    """Subscriptions touched this run (without ``this_run``: all) that
    have no path yet. The whole subscription is one conversion at its start
    time. Of the existing paths only the ids of touched subscriptions are needed."""
    sid = cfg.subscription_id
    s = subscriptions if this_run is None else subscriptions.join(this_run.select(sid), sid, "left_semi")
    if existing_paths is not None:
        s = s.join(existing_paths.select(F.col("cv_id").alias(sid)), sid, "left_anti")
    s = resolve_customer(s, mapping, cfg)
    return s.select(
        F.col(sid).alias("cv_id"),
        F.lit(SUBSCRIPTION_EVENT_ID).alias("event_id"),
        "customer_id",
        F.col("subscription_start_tstamp").alias("cv_tstamp"),
        F.lit(SUBSCRIPTION_CV_TYPE).alias("cv_type"),
        F.col("revenue").cast("double").alias("revenue"),
    )



def _non_empty(arr: Column) -> Column:
    # String aggregation skips nulls and yields null for no value at all.
    kept = F.filter(arr, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, kept)


TOUCH = ("visit_start_tstamp", "view_id", "channel", "campaign")  # in path order


def _blocks_of(convs: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """One row per conversion and block of days that its window overlaps."""
    L, B = cfg.path_lookback_days, cfg.join_bucket_days
    cv = convs.withColumn("_cv_day", day_number(F.col("cv_tstamp")))
    return cv.withColumn("_block", F.explode(F.sequence(F.floor((F.col("_cv_day") - L) / B), F.floor(F.col("_cv_day") / B))))


def touch_blocks(convs: DataFrame, touchpoints: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """One row per customer and block of days with its touches in path order, of the blocks that some conversion
    needs (a visitor of very many touches and no conversion fills no row)."""
    tp = touchpoints
    tf = touch_filters(cfg)
    if tf is not None:
        tp = tp.filter(tf)
    tp = tp.select(F.col("customer_id").alias("_customer"), *TOUCH,
                   F.floor(day_number(F.col("visit_start_tstamp")) / cfg.join_bucket_days).alias("_block"))
    needed = _blocks_of(convs, cfg).select(F.col("customer_id").alias("_customer"), "_block").distinct()
    return (tp.join(needed, ["_customer", "_block"], "left_semi").groupBy("_customer", "_block")
            .agg(F.array_sort(F.collect_list(F.struct(*TOUCH))).alias("_touches")))


def _leading(touches: Column, holds) -> Column:
    """How many of the sorted touches lie before the first for which ``holds`` fails, by binary search."""

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        inside = holds(F.get(touches, middle)["visit_start_tstamp"])
        return F.when(span["low"] >= span["high"], span).otherwise(F.struct(
            F.when(inside, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(inside, span["high"]).otherwise(middle).alias("high")))

    steps = F.sequence(F.lit(0), F.floor(F.log2(F.size(touches))).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(touches).alias("high")), halve, lambda span: span["low"])


def _cut_blocks(convs: DataFrame, touchpoints: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """One row per conversion and block that holds touches of its path: the block's touches, and which of them."""
    L, B = cfg.path_lookback_days, cfg.join_bucket_days
    cv, blocks = _blocks_of(convs, cfg), touch_blocks(convs, touchpoints, cfg)
    both = cv.join(blocks, (cv["customer_id"] == blocks["_customer"]) & (cv["_block"] == blocks["_block"]), "inner").drop(blocks["_block"])
    touches = F.col("_touches")
    opens = F.date_sub(F.to_date("cv_tstamp"), L).cast("timestamp_ntz")  # calendar days: from midnight on
    before = F.when(F.col("_block") * B < F.col("_cv_day") - L, _leading(touches, lambda visit: visit < opens)).otherwise(0)
    until = (F.when((F.col("_block") + 1) * B > F.col("_cv_day"), _leading(touches, lambda visit: visit <= F.col("cv_tstamp")))
             .otherwise(F.size(touches)))
    cut = both.select(*CONVERSION_COLUMNS, "_block", "_touches", before.alias("_before"), until.alias("_until"))
    return cut.filter(F.col("_until") > F.col("_before"))


def _segment() -> Column:
    return F.slice("_touches", F.col("_before") + 1, F.col("_until") - F.col("_before"))


def path_segments(convs: DataFrame, touchpoints: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """O15 join: one row per conversion and block that holds touches of its path, with those touches in order."""
    return _cut_blocks(convs, touchpoints, cfg).select(*CONVERSION_COLUMNS, "_block", _segment().alias("_segment"))


def paths_to_conversion(convs: DataFrame, touchpoints: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """The ordered channel and campaign path of every conversion that
    has at least one touchpoint, as arrays (see ``paths_as_strings``).

    Both paths come from the same sorted touches (visit time, then view id), so
    they are aligned element by element even when visit times tie.
    """
    # the order within a segment stands: only labels are shuffled, as two plain arrays (smaller than one of pairs)
    labels = (F.transform(_segment(), lambda x: x["channel"]).alias("channel"),
              F.transform(_segment(), lambda x: x["campaign"]).alias("campaign"))
    grouped = _cut_blocks(convs, touchpoints, cfg).select(*CONVERSION_COLUMNS, F.struct("_block", *labels).alias("_labels")).groupBy(
        *CONVERSION_COLUMNS).agg(F.array_sort(F.collect_list("_labels")).alias("_t"))
    out = grouped.select(
        *CONVERSION_COLUMNS,
        _non_empty(F.flatten(F.transform("_t", lambda x: x["channel"]))).alias("channel_path"),
        _non_empty(F.flatten(F.transform("_t", lambda x: x["campaign"]))).alias("campaign_path"),
    )
    out = out.withColumn(
        "cv_path_start_tstamp",
        F.col("cv_tstamp") - F.make_dt_interval(F.lit(cfg.path_lookback_days)))
    out = transform_paths(out, cfg)
    return out.select(*PATH_COLUMNS)


def transform_paths(paths: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Apply the configured array rewrites, in order, to both paths."""
    ch, ca = F.col("channel_path"), F.col("campaign_path")
    for t in cfg.path_transforms:
        ch, ca = t(ch), t(ca)
    return paths.withColumn("channel_transformed_path", ch).withColumn("campaign_transformed_path", ca)


def paths_as_strings(paths: DataFrame) -> DataFrame:
    """The reference's table shape: paths as ``' > '``-joined strings
    and the date partition column."""
    cols = []
    for c in paths.columns:
        if c.endswith("_path") and dict(paths.dtypes)[c].startswith("array"):
            cols.append(path_to_string(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    out = paths.select(*cols)
    if "cv_tstamp_date" not in out.columns:
        out = out.withColumn("cv_tstamp_date", F.to_date("cv_tstamp"))
    return out


def rebalanced(paths: DataFrame, by: str) -> DataFrame:
    """Paths in tasks of few values of a column, as they are written by it. What is shuffled has a transformed path
    only where it isn't the raw one."""
    rest = [c for c in paths.columns if not c.endswith("_transformed_path")]
    raw = {f"{d}_transformed_path": F.col(f"{d}_path") for d in ("channel", "campaign")}
    lean = paths.select(*rest, *[F.when(~F.col(c).eqNullSafe(p), F.col(c)).alias(c) for c, p in raw.items()],
                        *[F.col(c).eqNullSafe(p).alias(f"_raw_{c}") for c, p in raw.items()]).hint("rebalance", by)
    whole = {c: F.when(F.col(f"_raw_{c}"), p).otherwise(F.col(c)).alias(c) for c, p in raw.items()}
    return lean.select(*[whole.get(c, F.col(c)) for c in paths.columns])


def refresh_revenue(existing_paths: DataFrame, subscriptions: DataFrame, dates: DataFrame,
                    cfg: AttributionConfig) -> DataFrame:
    """Paths of subscriptions already attributed and touched again this
    run are re-emitted with the subscription's current revenue; path, time
    and customer stay as they were.

    ``dates`` has the id and the date partition of those stored paths. Their
    distinct dates (bounded by the calendar, hence the broadcast) prune the
    stored paths when the query runs, so only these partitions are read."""
    sid = cfg.subscription_id
    days = F.broadcast(dates.groupBy("cv_tstamp_date").count().filter(F.col("count") > 0).select("cv_tstamp_date"))
    touched = existing_paths.join(days, "cv_tstamp_date", "left_semi").join(dates, ["cv_tstamp_date", "cv_id"], "left_semi")
    subs = subscriptions.select(F.col(sid).alias("_sub_id"), F.col("revenue").cast("double").alias("_sub_revenue"))
    out = touched.join(subs, touched["cv_id"] == subs["_sub_id"], "left")
    return out.withColumn("revenue", F.col("_sub_revenue")).drop("_sub_id", "_sub_revenue").select(*PATH_COLUMNS)
