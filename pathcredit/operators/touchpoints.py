"""Identity resolution and touchpoints."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.columns import campaign_label, classify_channel, ts_lit

TOUCHPOINT_COLUMNS = ("view_id", "customer_id", "visit_start_tstamp", "channel", "referral_path",
                      "campaign", "source", "medium", "visit_start_date")


def resolve_customer(df: DataFrame, mapping: DataFrame | None, cfg: AttributionConfig,
                     out: str = "customer_id") -> DataFrame:
    """``customer_id`` = mapped user id, else the device id.

    With stitching on, the already-stitched id is used and no join is made.
    Otherwise a left join on ``user_identifier``: the mapping is as large as
    the user base, so no broadcast hint; AQE broadcasts it only when its
    measured size is under the threshold, else it is a sort-merge join.
    """
    if cfg.conversion_stitching:
        return df.withColumn(out, F.col("stitched_user_id"))
    if mapping is None:
        raise ValueError("a user mapping is required unless conversion_stitching is on")
    m = mapping.select(F.col("user_identifier").alias("_um_ui"), F.col("user_id").alias("_um_uid"))
    joined = df.join(m, df["user_identifier"] == m["_um_ui"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_um_uid"), F.col("user_identifier"))).drop("_um_ui", "_um_uid")


def touchpoint_filter(cfg: AttributionConfig, since: dt.datetime | None = None) -> Column:
    """Row filter on the raw views (applied before the mapping join so that
    it reaches the parquet scan)."""
    cond = (F.col("start_tstamp") >= ts_lit(cfg.start_date)) & F.col("user_identifier").isNotNull()
    if since is not None:
        cond = cond & (F.col("derived_tstamp") >= ts_lit(since))
    if cfg.conversion_hosts:
        # Restrict to some host names.
        cond = cond & F.col("page_urlhost").isin(*cfg.conversion_hosts)
    if cfg.consider_intrasession_channels:
        # One row per channel change within a session.
        cond = cond & ((F.col("mkt_medium").isNotNull() & (F.col("mkt_medium") != ""))
                       | (F.col("view_in_session_index") == 1))
    return cond


def touchpoints(views: DataFrame, mapping: DataFrame | None, cfg: AttributionConfig,
                since: dt.datetime | None = None) -> DataFrame:
    """One row per qualifying view with its channel and campaign.

    ``visit_start_tstamp`` is the event time of the view (as in the
    reference); ``view_id`` is kept as the tie-break of the path order.
    """
    v = views.filter(touchpoint_filter(cfg, since))
    if since is not None and "derived_tstamp_date" in views.columns:  # the partition column of a stored views table
        v = v.filter(F.col("derived_tstamp_date") >= F.lit(since.date()))
    v = resolve_customer(v, mapping, cfg)
    tp = v.select(
        "view_id",
        "customer_id",
        F.col("derived_tstamp").alias("visit_start_tstamp"),
        F.col("mkt_medium").alias("medium"),
        F.col("mkt_source").alias("source"),
        F.col("refr_urlpath").alias("referral_path"),
        campaign_label(F.col("mkt_campaign")).alias("campaign"),
        F.to_date("start_tstamp").alias("visit_start_date"),
    )
    tp = tp.withColumn("channel", classify_channel(cfg.channel_rules, cfg.default_channel))
    return tp.select(*TOUCHPOINT_COLUMNS)


def touch_filters(cfg: AttributionConfig) -> Column | None:
    """Channel / campaign include and exclude lists. Applied to the
    touchpoints before the path join, so one filter shortens both paths.
    ``NOT IN`` drops null labels, like the SQL it stands for."""
    conds: list[Column] = []
    if cfg.channels_to_exclude:
        conds.append(~F.col("channel").isin(*cfg.channels_to_exclude))
    if cfg.channels_to_include:
        conds.append(F.col("channel").isin(*cfg.channels_to_include))
    if cfg.campaigns_to_exclude:
        conds.append(~F.col("campaign").isin(*cfg.campaigns_to_exclude) | F.col("campaign").isNull())
    if cfg.campaigns_to_include:
        conds.append(F.col("campaign").isin(*cfg.campaigns_to_include))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
