"""Adapter from the driver's ``events`` table to the pipeline's inputs.

The attribution pipeline consumes page views, conversions, a user mapping and
an optional spend ledger. The test data ships one generic ``events`` table;
the views below derive each input from it with plain column expressions
(FIXTURES.md section 2), so every query's work grows with ``events``.

All functions are lazy DataFrame transformations over one parquet scan.
The modulo expressions below derive attributes (medium, campaign, which
devices have a login, ...) from the event's own fields; no event is dropped
or sampled, so every query processes the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ConversionDef
from ..functions.columns import hour_floor


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _ui() -> Column:
    return F.concat(F.lit("d"), F.col("user_id").cast("string"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _mapped() -> Column:
    return F.col("user_id") % 3 != 0


def _mapped_user() -> Column:
    return F.concat(F.lit("u"), F.floor(F.col("user_id") / 2).cast("bigint").cast("string"))


def user_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device id; two devices can share a user, a third of the
    devices are unmapped."""
    ev = _events(spark, sf_dir).filter(_mapped()).select("user_id").distinct()
    return ev.select(_ui().alias("user_identifier"), _mapped_user().alias("user_id"))


def _own_user() -> Column:
    """The user whom the mapping gives an event's device; every event's device is in the mapping if it has one, so no
    join is needed."""
    return F.when(_mapped(), _mapped_user())


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views (touchpoint source) from ``view`` and ``click`` events."""
    ev = _events(spark, sf_dir).filter(F.col("event_type").isin("view", "click"))
    ev, k = ev.select("event_id", "user_id", "ts", _k().alias("_k")), F.col("_k")  # the text is parsed once a row
    return ev.select(
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("view_id"),
        _ui().alias("user_identifier"),
        F.col("ts").alias("derived_tstamp"),
        hour_floor(F.col("ts")).alias("start_tstamp"),
        F.concat(F.lit("/r/"), (k % 7).cast("string")).alias("refr_urlpath"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
        .when(k % 6 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("camp_"), (k % 6).cast("string"))).alias("mkt_campaign"),
        F.concat(F.lit("src_"), (k % 4).cast("string")).alias("mkt_source"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.lit(""))
        .when(k % 5 == 2, F.lit("cpc"))
        .when(k % 5 == 3, F.lit("email"))
        .otherwise(F.lit("social")).alias("mkt_medium"),
        F.when(k % 2 == 0, F.lit("www.a.test")).otherwise(F.lit("shop.a.test")).alias("page_urlhost"),
        (F.col("event_id") % 4 + 1).alias("view_in_session_index"),
        F.coalesce(_own_user(), _ui()).alias("stitched_user_id"),
    )


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions from ``purchase`` and ``signup`` events. Three quarters of
    the purchases are subscription events (free_trial, subscribe, renew) of
    one of three subscriptions per user."""
    ev = _events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "signup"))
    is_purchase = F.col("event_type") == "purchase"
    ev, k4 = ev.select("event_id", "user_id", "ts", "event_type", "value", F.when(is_purchase, _k() % 4).alias("_k4")), F.col("_k4")
    kinds = F.array(F.lit("free_trial"), F.lit("subscribe"), F.lit("renew"))  # one look at k4, which filters on the type parse
    base = ev.select(
        F.concat(F.lit("cv"), F.col("event_id").cast("string")).alias("cv_id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(is_purchase & (k4 < 3),
               F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                        (F.col("event_id") % 3).cast("string"))).alias("subscription_id"),
        _ui().alias("user_identifier"),
        _own_user().alias("user_id"),
        F.col("ts").alias("cv_tstamp"),
        F.when(~is_purchase, F.lit("signup")).otherwise(F.coalesce(F.get(kinds, k4), F.lit("purchase"))).alias("cv_type"),
        F.when(is_purchase, F.round("value", 2)).alias("cv_value"),
    )
    return (
        base.withColumn("stitched_user_id", F.coalesce("user_id", "user_identifier"))
        .withColumn("cv_tstamp_date", F.to_date("cv_tstamp"))
        .select("cv_id", "event_id", "subscription_id", "user_identifier", "user_id",
                "stitched_user_id", "cv_tstamp", "cv_type", "cv_value", "cv_tstamp_date")
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in spend ledger from ``error`` events."""
    ev = _events(spark, sf_dir).filter(F.col("event_type") == "error")
    k = _k()
    return ev.select(
        F.col("ts").alias("spend_tstamp"),
        F.when(k % 5 == 2, F.lit("Paid_Search"))
        .when(k % 5 == 3, F.lit("Email"))
        .when(k % 5 == 4, F.lit("Social")).alias("channel"),
        F.when(k % 6 > 1, F.concat(F.lit("camp_"), (k % 6).cast("string"))).alias("campaign"),
        F.round("value", 2).alias("spend"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracker-shaped events: an ``event_name`` and, for subscription events,
    a nested payload ``subscription_event{event_type, price, subscription_id}``.
    Input of conversion extraction (O1)."""
    ev = _events(spark, sf_dir)
    k4 = _k() % 4
    is_sub = (F.col("event_type") == "purchase") & (k4 < 3)
    payload = F.struct(
        F.when(k4 == 0, F.lit("free_trial")).when(k4 == 1, F.lit("subscribe"))
        .otherwise(F.lit("renew")).alias("event_type"),
        F.round("value", 2).alias("price"),
        F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                 (F.col("event_id") % 3).cast("string")).alias("subscription_id"),
    )
    return ev.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(is_sub, F.lit("subscription_event")).otherwise(F.col("event_type")).alias("event_name"),
        _ui().alias("user_identifier"),
        F.col("ts").alias("derived_tstamp"),
        F.when(is_sub, payload).alias("subscription_event"),
        F.when((F.col("event_type") == "purchase") & ~is_sub, F.round("value", 2)).alias("tr_total"),
    )


# Conversion definitions for ``raw_events``: the three subscription events of
# the reference configuration (condition on the event name and the payload's
# event type, value = payload price) plus two ordinary conversions.
FIXTURE_CONVERSION_DEFS = (
    ConversionDef("free_trial",
                  "event_name = 'subscription_event' and subscription_event.event_type = 'free_trial'",
                  "subscription_event.price"),
    ConversionDef("subscribe",
                  "event_name = 'subscription_event' and subscription_event.event_type = 'subscribe'",
                  "subscription_event.price"),
    ConversionDef("renew",
                  "event_name = 'subscription_event' and subscription_event.event_type = 'renew'",
                  "subscription_event.price"),
    ConversionDef("purchase", "event_name = 'purchase'", "tr_total"),
    ConversionDef("signup", "event_name = 'signup'", None),
)
FIXTURE_PASSTHROUGHS = (("subscription_event.subscription_id", "subscription_id"),)


@dataclass(frozen=True)
class Inputs:
    """The four inputs of one pipeline run."""

    views: DataFrame
    conversions: DataFrame
    user_mapping: DataFrame
    spend: DataFrame | None = None


def load_inputs(spark: SparkSession, sf_dir: str, with_spend: bool = True) -> Inputs:
    return Inputs(
        views=views(spark, sf_dir),
        conversions=conversions(spark, sf_dir),
        user_mapping=user_mapping(spark, sf_dir),
        spend=spend(spark, sf_dir) if with_spend else None,
    )
