"""Attribution report with spend and return on ad spend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.columns import day_number, ts_lit

WEIGHT_MODELS = ("first_touch", "last_touch", "linear", "position_based")


def spend_islands(attributions: DataFrame, dim: str, cfg: AttributionConfig) -> DataFrame:
    """One row per touch point: the times at which a spend counts, as disjoint open intervals in order.

    A conversion at ``c`` makes spend count in ``(c - D days, c)``. Those of one day overlap, so a day gives one
    interval, from its first conversion's to its last conversion; in the order of days both ends rise, so an
    island begins where an interval does not begin before the end of the one before it. Days are summed map-side:
    the table is bounded by touch points x calendar days, a row by the calendar.
    """
    D = cfg.spend_lookback_days
    days = (attributions.filter(F.col(dim).isNotNull())
            .groupBy(F.col(dim).alias("_tp"), day_number(F.col("cv_tstamp")).alias("_day"))
            .agg((F.min("cv_tstamp") - F.make_dt_interval(F.lit(D))).alias("opens"), F.max("cv_tstamp").alias("closes"))
            .filter(F.lit(D > 0)))
    one = days.groupBy("_tp").agg(F.array_sort(F.collect_list(F.struct("opens", "closes"))).alias("_days"))
    n = F.size("_days")
    first = F.filter("_days", lambda x, i: (i == 0) | (x["opens"] >= F.get("_days", i - 1)["closes"]))
    last = F.filter("_days", lambda x, i: (i == n - 1) | (F.get("_days", i + 1)["opens"] >= x["closes"]))
    return one.select("_tp", F.zip_with(first, last, lambda a, b: F.struct(
        a["opens"].alias("opens"), b["closes"].alias("closes"))).alias("_islands"))


def scoped_spend(spend: DataFrame, attributions: DataFrame, dim: str, cfg: AttributionConfig) -> DataFrame:
    """Total spend per touch point, counting a spend row (once) only if
    some attributed conversion of the same touch point falls strictly inside
    ``(spend_tstamp, spend_tstamp + lookback)``.

    No range join over the few touch-point keys (that would pair every spend
    row with every conversion of its channel), and no spread over the days of
    the lookback: the conversions' intervals are merged to disjoint islands,
    one row per touch point, which a spend row meets once.
    """
    islands = spend_islands(attributions, dim, cfg)
    s = spend.filter(F.col(dim).isNotNull()).select(F.col(dim).alias("_tp"), "spend_tstamp", "spend")
    at = F.col("spend_tstamp")
    inside = F.exists("_islands", lambda x: (x["opens"] < at) & (at < x["closes"]))
    return s.join(islands, "_tp", "inner").filter(inside).groupBy("_tp").agg(F.sum("spend").alias("spend")).withColumnRenamed("_tp", dim)


def window_bound(campaign_attributions: DataFrame, cfg: AttributionConfig) -> Column:
    """The reporting window as a predicate on ``cv_tstamp``: the
    configured ``[start, end)``, else the last ``conversion_window_days`` up to
    the latest campaign conversion (one value read on the driver; it becomes
    a literal, so the filter reaches the scan)."""
    # Each bound is repeated on the date partition column of the stored
    # attribution tables, so whole partitions outside the window are skipped.
    day = F.col("cv_tstamp_date")
    if cfg.conversion_window_start_date is not None and cfg.conversion_window_end_date is not None:
        start, end = cfg.conversion_window_start_date, cfg.conversion_window_end_date
        return ((F.col("cv_tstamp") >= ts_lit(start)) & (F.col("cv_tstamp") < ts_lit(end))
                & (day >= F.lit(start.date())) & (day <= F.lit(end.date())))
    mark = campaign_attributions.agg(F.max("cv_tstamp").alias("m")).collect()[0]["m"]
    if mark is None:
        return F.lit(False)
    lower = mark - dt.timedelta(days=cfg.conversion_window_days)
    return (F.col("cv_tstamp") >= ts_lit(lower)) & (day >= F.lit(lower.date()))


def overview_prep(attributions: DataFrame, dim: str, subscriptions: DataFrame, window: Column,
                  cfg: AttributionConfig) -> DataFrame:
    """One row per (conversion, touch point) inside the window: summed
    weights, the conversion's revenue, attributed revenue per model and per
    subscription event attributed counts and revenue.

    Aggregates first and joins the subscription rows afterwards: a
    subscription's counts are constant per ``cv_id``, so
    ``sum(count * w) = count * sum(w)`` and the join sees one row per
    (conversion, touch point) instead of one per path position.
    """
    sid = cfg.subscription_id
    events = cfg.subscription_events
    keys = ["cv_id", "event_id", "cv_tstamp", "cv_type", dim]
    a = attributions.filter(window).groupBy(*keys).agg(
        *[F.sum(f"{m}_attribution").alias(f"{m}_attribution") for m in WEIGHT_MODELS],
        F.coalesce(F.min("cv_total_revenue"), F.lit(0.0)).alias("cv_total_revenue"),
    )
    subs = subscriptions.select(
        F.col(sid).alias("_sub_id"),
        *[F.col(f"{e}_count").alias(f"_{e}_count") for e in events],
        *[F.col(f"{e}_revenue").alias(f"_{e}_revenue") for e in events],
    )
    a = a.join(subs, a["cv_id"] == subs["_sub_id"], "left")
    cols = [*keys, *[f"{m}_attribution" for m in WEIGHT_MODELS], "cv_total_revenue"]
    cols += [(F.col(f"{m}_attribution") * F.col("cv_total_revenue")).alias(f"{m}_attribution_revenue")
             for m in WEIGHT_MODELS]
    for e in events:
        cols += [(F.col(f"_{e}_count").cast("double") * F.col(f"{m}_attribution")).alias(f"{e}_{m}_attribution")
                 for m in WEIGHT_MODELS]
        cols += [(F.col(f"_{e}_revenue") * F.col(f"{m}_attribution")).alias(f"{e}_{m}_attribution_revenue")
                 for m in WEIGHT_MODELS]
    return a.select(*cols)


def with_spend(rows: DataFrame, spend_by_touch: DataFrame | None, dim: str) -> DataFrame:
    """Add ``spend`` by touch point (null without a source): for the finished
    report, whose rows are as few as the spend's, and for anyone who wants
    it beside every conversion."""
    if spend_by_touch is None:
        return rows.withColumn("spend", F.lit(None).cast("double"))
    sp = spend_by_touch.select(F.col(dim).alias("_sp_touch"), F.col("spend").cast("double").alias("spend"))
    return rows.join(sp, rows[dim] == sp["_sp_touch"], "left").drop("_sp_touch")


def touch_point_report(prep: DataFrame, dim: str, cfg: AttributionConfig,
                       spend_by_touch: DataFrame | None) -> DataFrame:
    """O29-O31 for one dimension: aggregate ONCE with every model side by
    side, join the spend to the result, then unpivot it into one row per
    model. ``prep`` has one row per conversion and touch point, so rows are
    counted, not distinct ids."""
    with_roas = spend_by_touch is not None
    events = cfg.subscription_events
    models = cfg.attribution_list
    aggs = [
        F.count("cv_id").alias("in_n_conversion_paths"),
        F.min("cv_tstamp").alias("min_cv_tstamp"),
        F.max("cv_tstamp").alias("max_cv_tstamp"),
        F.sum("cv_total_revenue").alias("sum_cv_total_revenue"),
    ]
    for m in models:
        aggs += [F.sum(f"{m}_attribution").alias(f"_{m}_conv"),
                 F.sum(f"{m}_attribution_revenue").alias(f"_{m}_rev")]
        for e in events:
            aggs += [F.sum(f"{e}_{m}_attribution").alias(f"_{e}_{m}_conv"),
                     F.sum(f"{e}_{m}_attribution_revenue").alias(f"_{e}_{m}_rev")]
    wide = with_spend(prep.groupBy(dim).agg(*aggs), spend_by_touch, dim).withColumnRenamed(dim, "touch_point")
    per_model = F.array(*[
        F.struct(
            F.lit(m).alias("attribution_type"),
            F.col(f"_{m}_conv").alias("attributed_conversions"),
            F.col(f"_{m}_rev").alias("attributed_revenue"),
            *[F.col(f"_{e}_{m}_conv").alias(f"{e}_attributed_conversions") for e in events],
            *[F.col(f"_{e}_{m}_rev").alias(f"{e}_attributed_revenue") for e in events],
        ) for m in models
    ])
    long = wide.select("*", F.explode(per_model).alias("_m"))
    cols = [
        F.lit(dim).alias("path_type"),
        F.col("_m.attribution_type").alias("attribution_type"),
        "touch_point", "in_n_conversion_paths",
        F.col("_m.attributed_conversions").alias("attributed_conversions"),
        "min_cv_tstamp", "max_cv_tstamp", F.col("spend").cast("double").alias("spend"),
        "sum_cv_total_revenue",
        F.col("_m.attributed_revenue").alias("attributed_revenue"),
        *[F.col(f"_m.{e}_attributed_conversions").alias(f"{e}_attributed_conversions") for e in events],
        *[F.col(f"_m.{e}_attributed_revenue").alias(f"{e}_attributed_revenue") for e in events],
    ]
    out = long.select(*cols).filter(F.col("touch_point").isNotNull())
    if with_roas:
        # Each report row is its own group, so ROAS is row-wise.
        out = out.withColumn("ROAS", F.col("attributed_revenue") / F.nullif(F.col("spend"), F.lit(0.0)))
    return out


def attribution_overview(channel_attr: DataFrame, campaign_attr: DataFrame, subscriptions: DataFrame,
                         spend: DataFrame | None, cfg: AttributionConfig) -> DataFrame:
    """The touch-point report for both dimensions."""
    window = window_bound(campaign_attr, cfg)
    parts = []
    for dim, attr in (("channel", channel_attr), ("campaign", campaign_attr)):
        sp = scoped_spend(spend, attr, dim, cfg) if spend is not None else None
        parts.append(touch_point_report(overview_prep(attr, dim, subscriptions, window, cfg), dim, cfg, sp))
    return parts[0].unionByName(parts[1]).orderBy("path_type", "attribution_type", "touch_point")
