"""Conversions and subscriptions.

Repeated events of one subscription (free trial, subscribe, renewals) are
rolled up to ONE row per subscription whose revenue keeps growing. Only
subscriptions touched since the last run are recomputed, but each of them is
recomputed from its full event history.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig, ConversionDef
from ..functions.columns import ts_lit

SUBSCRIPTION_EVENT_COLUMNS = ("cv_id", "event_id", "user_identifier", "user_id",
                              "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")


def extract_conversions(events: DataFrame, defs: Sequence[ConversionDef],
                        passthroughs: Sequence[tuple[str, str]] = (),
                        event_id: str = "event_id",
                        tstamp: str = "derived_tstamp",
                        carry: Sequence[str] = ("user_identifier",)) -> DataFrame:
    """O1: one conversion row per (event, matching definition).

    All definitions are evaluated in a single pass: each yields a
    ``struct(name, value)`` or null, the nulls are filtered out of the array
    and the rest exploded. ``cv_id`` is ``event_id || '_' || cv_type`` (our
    contract; the reference generates it in a package that is not present).
    """
    if not defs:
        raise ValueError("at least one conversion definition is required")
    candidates = F.array(*[
        F.when(F.expr(d.condition),
               F.struct(F.lit(d.name).alias("name"),
                        (F.expr(d.value) if d.value else F.lit(None)).cast("double").alias("value")))
        for d in defs
    ])
    matched = F.filter(candidates, lambda c: c.isNotNull())
    cols = [F.col(event_id).alias("event_id"), F.col(tstamp).alias("cv_tstamp")]
    cols += [F.col(c) for c in carry]
    cols += [F.expr(sql).alias(alias) for sql, alias in passthroughs]
    out = events.select(*cols, F.explode(matched).alias("_cv"))
    return out.select(
        F.concat(F.col("event_id"), F.lit("_"), F.col("_cv.name")).alias("cv_id"),
        "event_id",
        *[F.col(c) for c in carry],
        *[F.col(alias) for _, alias in passthroughs],
        "cv_tstamp",
        F.col("_cv.name").alias("cv_type"),
        F.col("_cv.value").alias("cv_value"),
    )


def conversions_for_run(extracted: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """Extracted conversions (O1) in the columns a run reads: the mapped user, the stitched id and the date.
    Without a mapping the device stands for itself (paths then resolve it by their own mapping)."""
    if mapping is None:
        out = extracted.withColumn("user_id", F.lit(None).cast("string"))
    else:
        m = mapping.select(F.col("user_identifier").alias("_ui"), F.col("user_id"))
        out = extracted.join(m, extracted["user_identifier"] == m["_ui"], "left").drop("_ui")
    if "subscription_id" not in out.columns:
        out = out.withColumn("subscription_id", F.lit(None).cast("string"))
    return out.withColumn("stitched_user_id", F.coalesce("user_id", "user_identifier")).withColumn("cv_tstamp_date", F.to_date("cv_tstamp"))


def _clause(cfg: AttributionConfig) -> Column:
    # The configured clause is spliced into a conjunction: parenthesise it.
    return F.expr(f"({cfg.conversion_clause})")


def _is_subscription_event(cfg: AttributionConfig) -> Column:
    return F.col("ev.cv_type").isin(*cfg.subscription_events)


def lookback_since(last_success: dt.datetime, cfg: AttributionConfig) -> dt.datetime:
    """Lower bound of the touched-subscription scan: the high-water mark
    minus the late-arrival window (hours, see SURVEY B1)."""
    return last_success - dt.timedelta(hours=cfg.lookback_window_hours)


def touched_subscriptions(conversions: DataFrame, last_success: dt.datetime,
                          cfg: AttributionConfig) -> DataFrame:
    """O2: distinct ids with a subscription-type conversion since
    ``last_success - lookback_window_hours``."""
    since = lookback_since(last_success, cfg)
    ev = conversions.alias("ev")
    cond = _clause(cfg) & _is_subscription_event(cfg) & (F.col("ev.cv_tstamp") >= ts_lit(since))
    if "cv_tstamp_date" in conversions.columns:
        # Redundant with the timestamp bound; lets a date-partitioned table
        # skip whole partitions.
        cond = cond & (F.col("ev.cv_tstamp_date") >= F.lit(since.date()))
    sid = cfg.subscription_id
    return ev.filter(cond).select(F.col(f"ev.{sid}").alias(sid)).distinct()


def subscription_history(conversions: DataFrame, cfg: AttributionConfig, since: dt.datetime | None = None) -> DataFrame:
    """All subscription-type conversions in the columns of O3, or those since a time."""
    sid = cfg.subscription_id
    cond = _clause(cfg) & _is_subscription_event(cfg)
    if since is not None:
        cond = cond & (F.col("ev.cv_tstamp") >= ts_lit(since))
        if "cv_tstamp_date" in conversions.columns:
            cond = cond & (F.col("ev.cv_tstamp_date") >= F.lit(since.date()))
    return conversions.alias("ev").filter(cond).select(
        *[F.col(f"ev.{c}").alias(c) for c in ("cv_id", "event_id", sid)], *[F.col(f"ev.{c}").alias(c) for c in SUBSCRIPTION_EVENT_COLUMNS[2:]])


def subscription_events(conversions: DataFrame, touched: DataFrame,
                        cfg: AttributionConfig) -> DataFrame:
    """O3: the full history (no time bound) of every touched subscription.

    A left-semi join: only the touched id set is shuffled or broadcast (AQE
    decides from its measured size); null ids never match."""
    sid = cfg.subscription_id
    return subscription_history(conversions, cfg).join(touched.select(sid), sid, "left_semi")


def ledger_bucket(cfg: AttributionConfig) -> Column:
    """The ledger's partition of a subscription."""
    return F.pmod(F.xxhash64(cfg.subscription_id), F.lit(cfg.subscription_ledger_buckets)).cast("int")


def ledger_events(ledger: DataFrame, touched: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """O3 from the ledger: the history of every touched subscription, read from their buckets (of which there are at
    most as many as the ledger has, so their numbers become a literal that prunes the scan)."""
    sid = cfg.subscription_id
    buckets = [r["bucket"] for r in touched.select(ledger_bucket(cfg).alias("bucket")).distinct().collect()]
    return ledger.filter(F.col("bucket").isin(sorted(buckets))).join(touched.select(sid), sid, "left_semi").drop("bucket")


def _first_event_struct() -> Column:
    return F.struct("user_identifier", "user_id", "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")


def build_subscriptions(this_run: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """O4+O5+O6: one row per subscription.

    Two aggregation levels instead of a join of a ranking window with a
    rollup: level 1 groups by (subscription, cv_id, cv_type) so that the
    per-type counts are distinct on ``cv_id`` without Catalyst's Expand of
    several count-distincts; level 2 groups by subscription and is fully
    partial-aggregated, so a subscription holding a large share of all events
    is combined map-side before its single shuffle. The first event (ties by
    ``cv_id``) is carried by ``min_by`` on a struct at both levels.
    """
    sid = cfg.subscription_id
    events = cfg.subscription_events
    order_key = F.struct("cv_tstamp", "cv_id")
    lvl1 = this_run.groupBy(sid, "cv_id", "cv_type").agg(
        F.min_by(_first_event_struct(), order_key).alias("_first"),
        F.max("cv_tstamp").alias("_last"),
        F.sum("cv_value").alias("_revenue"),
        *[F.sum(F.when(F.col("cv_type") == e, F.col("cv_value")).otherwise(F.lit(0.0))).alias(f"_{e}_revenue")
          for e in events],
    )
    lvl2 = lvl1.groupBy(sid).agg(
        F.min_by("_first", F.struct(F.col("_first.cv_tstamp"), F.col("cv_id"))).alias("_first"),
        F.max("_last").alias("last_subscription_event_tstamp"),
        F.sum("_revenue").alias("revenue"),
        *[F.count(F.when((F.col("cv_type") == e) & F.col("cv_id").isNotNull(), F.lit(1))).alias(f"{e}_count")
          for e in events],
        *[F.sum(f"_{e}_revenue").alias(f"{e}_revenue") for e in events],
    )
    return lvl2.select(
        sid,
        F.col("_first.user_identifier").alias("user_identifier"),
        F.col("_first.user_id").alias("user_id"),
        F.col("_first.stitched_user_id").alias("stitched_user_id"),
        F.col("_first.cv_tstamp").alias("subscription_start_tstamp"),
        "last_subscription_event_tstamp",
        "revenue",
        *[f"{e}_count" for e in events],
        *[f"{e}_revenue" for e in events],
    )


def first_subscription_event(this_run: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """O4 on its own: the earliest event of each subscription (ties: cv_id)."""
    sid = cfg.subscription_id
    first = this_run.groupBy(sid).agg(
        F.min_by(_first_event_struct(), F.struct("cv_tstamp", "cv_id")).alias("_f"))
    return first.select(sid, *[F.col(f"_f.{c}").alias(c) for c in
                               ("user_identifier", "user_id", "stitched_user_id", "cv_tstamp", "cv_type", "cv_value")])


def subscription_rollup(this_run: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """O5 on its own: last event time, per-type distinct counts and revenue."""
    subs = build_subscriptions(this_run, cfg)
    events = cfg.subscription_events
    return subs.select(cfg.subscription_id, "last_subscription_event_tstamp",
                       *[f"{e}_count" for e in events], *[f"{e}_revenue" for e in events], "revenue")
