"""One run of the attribution pipeline as a lazily built DataFrame graph.

    conversions -> touched subscriptions -> this run's subscription events
                -> subscriptions
    views + mapping -> touchpoints
    ordinary conversions + new subscriptions -> paths -> channel / campaign
    attributions -> overview (with spend)

Each stage is a property; on first use it is computed and stored in the shared
folder (``materialize=False``: stays lazy), so each is computed once.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame

from ..config import AttributionConfig
from ..operators import attribution as att
from ..operators import overview as ov
from ..operators import paths as pth
from ..operators import subscriptions as sub
from ..operators import touchpoints as tpo
from ..session import delete_path, materialize, new_state_dir
from ..sources.catalog import bucketed, forget
from ..sources.fixtures import Inputs
from ..sources.tables import require_unique


class Pipeline:
    """A first (non-incremental) build of every table, given the
    subscription high-water mark ``last_success`` (``None``: no manifest yet,
    so every subscription since ``start_date`` counts as touched)."""

    def __init__(self, inputs: Inputs, cfg: AttributionConfig, last_success: dt.datetime | None = None,
                 materialize: bool = True):
        self.inputs = inputs
        self.cfg = cfg
        self.last_success = last_success if last_success is not None else cfg.start_date
        self._materialize = materialize
        self._stage_dirs: list[str] = []
        self._names: list[str] = []

    def _stage(self, df: DataFrame, label: str) -> DataFrame:
        # The reference stores these stages as tables; so do we (shared
        # folder), which also keeps later stages from recomputing them.
        return materialize(df, label, self._stage_dirs) if self._materialize else df

    def cleanup(self) -> None:
        """Delete the stage folders this build wrote (after its DataFrames
        are no longer needed)."""
        spark = self.inputs.conversions.sparkSession
        while self._names:
            forget(spark, self._names.pop())
        while self._stage_dirs:
            delete_path(spark, self._stage_dirs.pop())

    @cached_property
    def touched(self) -> DataFrame:
        return sub.touched_subscriptions(self.inputs.conversions, self.last_success, self.cfg)

    @cached_property
    def this_run(self) -> DataFrame:
        return self._stage(sub.subscription_events(self.inputs.conversions, self.touched, self.cfg), "this_run")

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self._stage(sub.build_subscriptions(self.this_run, self.cfg), "subscriptions")

    @cached_property
    def mapping(self) -> DataFrame | None:
        """The assignment of devices to customers, stored once by buckets of the device: views, conversions and
        subscriptions join it without shuffling it again."""
        m = self.inputs.user_mapping
        if m is None or self.cfg.conversion_stitching or not self._materialize:
            return m
        path = new_state_dir(m.sparkSession, "stage-mapping")
        held, name = bucketed(m.select("user_identifier", "user_id"), "user_identifier", "pathcredit_mapping", "user mapping", path)
        self._stage_dirs.append(path)
        self._names.append(name)
        return held

    @cached_property
    def touchpoints(self) -> DataFrame:
        return tpo.touchpoints(self.inputs.views, self.mapping, self.cfg)

    @cached_property
    def ordinary(self) -> DataFrame:
        return pth.ordinary_conversions(self.inputs.conversions, self.mapping, self.cfg)

    @cached_property
    def new_subscriptions(self) -> DataFrame:
        return pth.new_subscription_conversions(self.subscriptions, self.this_run, self.mapping, self.cfg)

    @cached_property
    def paths(self) -> DataFrame:
        convs = self.ordinary.unionByName(self.new_subscriptions)
        require_unique(convs, ["cv_id"], "conversions")
        return self._stage(pth.paths_to_conversion(convs, self.touchpoints, self.cfg), "paths")

    def attributions(self, dim: str) -> DataFrame:
        return self.channel_attributions if dim == "channel" else self.campaign_attributions

    @cached_property
    def channel_attributions(self) -> DataFrame:
        return self._stage(att.attribute(self.paths, "channel", self.cfg), "channel_attributions")

    @cached_property
    def campaign_attributions(self) -> DataFrame:
        return self._stage(att.attribute(self.paths, "campaign", self.cfg), "campaign_attributions")

    def overview(self, with_spend: bool = True) -> DataFrame:
        spend = self.inputs.spend if with_spend else None
        return ov.attribution_overview(self.channel_attributions, self.campaign_attributions,
                                       self.subscriptions, spend, self.cfg)
