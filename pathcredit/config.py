"""Run configuration: every knob a user of the attribution pipeline can set.

One frozen dataclass, built once per run and threaded through the operators.
Nothing here touches Spark; it only describes what the plan should look like.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import Column

# Fixed values that must equal the reference for right results: the names of
# the four attribution models and the order they are reported in, the path
# separator, the label given to missing campaigns, the literal event id and
# conversion type of subscription conversions, and the spend lookback.
ATTRIBUTION_MODELS = ("first_touch", "last_touch", "linear", "position_based")
PATH_SEPARATOR = " > "
NO_CAMPAIGN = "No campaign"
SUBSCRIPTION_EVENT_ID = "null"
SUBSCRIPTION_CV_TYPE = "subscription"
SPEND_LOOKBACK_DAYS = 90


@dataclass(frozen=True)
class ConversionDef:
    """One conversion definition: a SQL predicate over a raw event, the
    conversion type it yields, and a SQL expression for its value."""

    name: str
    condition: str
    value: str | None = None


@dataclass(frozen=True)
class ChannelRule:
    """One rule of the channel classification: SQL predicate -> label."""

    condition: str
    label: str


# Our channel classification (the reference keeps its body in a package that
# is not available); rules are tried in order, the default closes the chain.
DEFAULT_CHANNEL_RULES = (
    ChannelRule("medium = 'cpc'", "Paid_Search"),
    ChannelRule("medium = 'email'", "Email"),
    ChannelRule("medium = 'social'", "Social"),
)
DEFAULT_CHANNEL = "Direct"

PathTransform = Callable[[Column], Column]


@dataclass(frozen=True)
class AttributionConfig:
    start_date: dt.datetime = dt.datetime(2024, 1, 1)
    path_lookback_days: int = 30
    lookback_window_hours: int = 6
    subscription_id: str = "subscription_id"
    subscription_events: tuple[str, ...] = ("free_trial", "subscribe", "renew")
    conversion_clause: str = "ev.user_identifier is not null"
    conversion_stitching: bool = False
    conversion_hosts: tuple[str, ...] = ()
    consider_intrasession_channels: bool = False
    channels_to_exclude: tuple[str, ...] = ()
    channels_to_include: tuple[str, ...] = ()
    campaigns_to_exclude: tuple[str, ...] = ()
    campaigns_to_include: tuple[str, ...] = ()
    channel_rules: tuple[ChannelRule, ...] = DEFAULT_CHANNEL_RULES
    default_channel: str = DEFAULT_CHANNEL
    # Ordered Column -> Column array rewrites applied to both paths; empty
    # means the transformed paths equal the raw ones.
    path_transforms: tuple[PathTransform, ...] = field(default=(), compare=False)
    attribution_list: tuple[str, ...] = ATTRIBUTION_MODELS
    conversion_window_start_date: dt.datetime | None = None
    conversion_window_end_date: dt.datetime | None = None
    conversion_window_days: int = 30
    spend_lookback_days: int = SPEND_LOOKBACK_DAYS
    # Width of the time buckets the conversion x touchpoint range join is
    # keyed on. Any width gives the same result; narrower buckets emit fewer
    # candidate pairs, wider ones replicate each conversion fewer times.
    join_bucket_days: int = 8
    # Keep subscription events in a ledger of so many buckets by subscription
    # (0: none, the whole history of touched subscriptions is read from the
    # conversions in every run, as the reference does). With a ledger a run
    # reads the conversions since its mark and the buckets of touched
    # subscriptions only; an event that comes in later than the late-arrival
    # window then isn't seen until a new state is built.
    subscription_ledger_buckets: int = 0
    # Incremental runs:
    # lower the touchpoint bound so that every conversion in scope, including
    # old new-subscriptions, gets its full lookback window ...
    pad_touchpoints: bool = False
    # ... and upsert attributions by conversion (all old rows of a
    # reprocessed conversion replaced) instead of by composite key (a path
    # that got shorter would leave its old higher positions behind).
    attribution_replace_by_conversion: bool = False

    def __post_init__(self) -> None:
        if not self.attribution_list:
            raise ValueError("attribution_list must name at least one model")
        unknown = set(self.attribution_list) - set(ATTRIBUTION_MODELS)
        if unknown:
            raise ValueError(f"unknown attribution models: {sorted(unknown)}")
        if self.path_lookback_days < 0 or self.join_bucket_days < 1:
            raise ValueError("lookback must be >= 0 and bucket width >= 1 day")
        if self.subscription_ledger_buckets < 0:
            raise ValueError("subscription_ledger_buckets must be >= 0")

    def with_(self, **changes) -> "AttributionConfig":
        return replace(self, **changes)
