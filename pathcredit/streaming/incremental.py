"""Incremental runs.

The reference is batch-incremental: each scheduled run processes what
arrived since the last run's high-water mark, re-reads a lookback window for
late data, and merges its output into the stored tables. One call of
``run_incremental`` is one such run; the stored tables and the manifest live
in a folder on shared storage (``state_dir``).

Order of a run (every stage reads the previous one back from storage, which
also cuts the lineage):

    manifest mark -> this run's subscription events (replaced)
                  -> subscriptions (upsert on the subscription id)
                  -> paths (upsert on cv_id): new conversions since
                     max(cv_path_start) - 6h, new subscriptions, and revenue
                     refresh of already-attributed subscriptions
                  -> channel / campaign attributions (upsert on composite_key)
                  -> manifest advanced last
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.columns import ts_lit
from ..operators import attribution as att
from ..operators import paths as pth
from ..operators import subscriptions as sub
from ..operators import touchpoints as tpo
from ..sources.catalog import bucketed, forget
from ..sources.fixtures import Inputs
from ..sources.tables import MANIFEST_SCHEMA, TableStore, rows_of_keys, upsert_frames

SUBSCRIPTIONS_MARK = "subscriptions"
ATTRIBUTION_MARK = "attribution"
PATHS_MARK = "paths"  # latest path start stored

THIS_RUN = "subscription_events_this_run"
SUBSCRIPTIONS = "subscriptions"
LEDGER = "subscription_ledger"
PATHS = "paths_to_conversion"
CHANNEL_ATTR = "channel_attributions"
CAMPAIGN_ATTR = "campaign_attributions"


class Manifest:
    """Run high-water marks, one row per model, written when a run has
    written all its tables, which makes them visible. An advance is
    ``greatest(old, new)``; a failed run never gets to it and changes nothing."""

    def __init__(self, store: TableStore):
        self.store = store

    def read(self) -> dict[str, dt.datetime]:
        return {model: mark for model, mark, _ in self.store.marks if model is not None}

    def current(self) -> DataFrame | None:
        rows = [r for r in self.store.marks if r[0] is not None]
        return self.store.spark.createDataFrame(rows, MANIFEST_SCHEMA).select("model", "last_success") if rows else None

    def advance(self, marks: dict[str, dt.datetime | None], run_id: str) -> None:
        old = self.read()
        new = {k: max(v, old.get(k, v)) for k, v in marks.items() if v is not None}
        self.store.commit([(k, v, run_id) for k, v in {**old, **new}.items()])


def observed(df: DataFrame, **columns: str) -> tuple[DataFrame, Observation]:
    """``df`` with the greatest value of each named column observed while it is written: no job of its own."""
    seen = Observation()
    return df.observe(seen, *[F.max(c).alias(k) for k, c in columns.items()]), seen


def paths_observed(paths: DataFrame) -> tuple[DataFrame, Observation]:
    """Paths with their latest time and start, and how large a path's attribution rows are on average, observed."""
    seen = Observation()
    return paths.observe(seen, F.max("cv_tstamp").alias("last"), F.max("cv_path_start_tstamp").alias("start"),
                         F.avg(att.bytes_written()).alias("bytes")), seen


#: Bytes of attribution rows, before they are encoded, that the paths of one file of the scope make. A task reads at
#: most 32 files, as each counts 4 MB (spark.sql.files.openCostInBytes) beside its size, of 128 MB in all.
SCOPE_FILE = 40_000_000


def scope_files(bytes_of_a_path: float | None) -> int:
    """How many paths a file of the scope has."""
    return max(1, int(SCOPE_FILE / max(bytes_of_a_path or 0, 300)))


def dealt_by_date(scope: DataFrame, touches: int, most: int = 500_000) -> DataFrame:
    """Paths in the order of their dates, in tasks of about ``most`` touches: unnested there, their rows are written
    by date without a shuffle of their own (each row has its whole path's text)."""
    n = max(scope.sparkSession.sparkContext.defaultParallelism, -(-touches // most))
    return scope.repartitionByRange(n, F.to_date("cv_tstamp"), "cv_id")


def low_water(df: DataFrame | None, col: str) -> dt.datetime | None:
    if df is None:
        return None
    return df.agg(F.min(col).alias("m")).collect()[0]["m"]


def attribution_key(cfg: AttributionConfig) -> list[str]:
    return ["cv_id"] if cfg.attribution_replace_by_conversion else ["composite_key"]


@dataclass
class RunReport:
    run_id: str
    subscriptions_mark: dt.datetime
    paths_mark: dt.datetime | None
    attribution_mark: dt.datetime | None
    first_paths_build: bool
    timings: dict[str, float]
    notes: tuple[str, ...] = ()


def subscription_stage(spark: SparkSession, store: TableStore, inputs: Inputs, cfg: AttributionConfig,
                       mark: dt.datetime) -> tuple[DataFrame, DataFrame, DataFrame, dt.datetime | None]:
    """O2-O6 + O32/O34: returns (this run's events, subscription updates, subscriptions table after the upsert,
    the time of the run's latest event)."""
    if cfg.subscription_ledger_buckets:
        events = events_by_ledger(store, inputs, cfg, mark)
    else:
        events = sub.subscription_events(inputs.conversions, sub.touched_subscriptions(inputs.conversions, mark, cfg), cfg)
    this_run, seen = observed(events, latest="cv_tstamp")
    this_run = store.overwrite(THIS_RUN, this_run.withColumn("cv_tstamp_date", F.to_date("cv_tstamp")))
    updates = sub.build_subscriptions(this_run, cfg).withColumn("subscription_start_date", F.to_date("subscription_start_tstamp"))
    subs = store.upsert(SUBSCRIPTIONS, updates, [cfg.subscription_id], "subscription_start_date")
    return this_run, store.updates(SUBSCRIPTIONS), subs, seen.get["latest"]


def events_by_ledger(store: TableStore, inputs: Inputs, cfg: AttributionConfig, mark: dt.datetime) -> DataFrame:
    """O2-O3 with a ledger: events since the mark go into the buckets of their subscriptions (all events where there
    is no ledger yet), and the history of the touched ones is read from those buckets."""
    name = f"{LEDGER}_{cfg.subscription_ledger_buckets}"  # another number of buckets is another ledger
    since = sub.lookback_since(mark, cfg)
    fresh = sub.subscription_history(inputs.conversions, cfg, since if store.exists(name) else None)
    fresh = fresh.filter(F.col(cfg.subscription_id).isNotNull()).withColumn("bucket", sub.ledger_bucket(cfg))
    ledger = store.upsert(name, fresh, ["cv_id"], "bucket", stable_partition=True)
    touched = store.stage("touched", store.updates(name).filter(F.col("cv_tstamp") >= ts_lit(since)).select(cfg.subscription_id).distinct())
    return sub.ledger_events(ledger, touched, cfg)


def stored_dates(existing: DataFrame, this_run: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Id and date partition of the stored paths whose id is a subscription touched this run: of the stored paths
    only the ids are read, where few are touched only of the row groups whose Bloom filter has one."""
    ids = this_run.select(F.col(cfg.subscription_id).alias("cv_id")).distinct()
    return rows_of_keys(existing.select("cv_id", "cv_tstamp_date"), ids, ["cv_id"])


def paths_updates(inputs: Inputs, cfg: AttributionConfig, this_run: DataFrame, subs: DataFrame,
                  existing: DataFrame | None, mark: dt.datetime | None = None, dates: DataFrame | None = None) -> DataFrame:
    """O12-O21 for one run: rows to upsert into the paths table.

    First build (or the table was dropped): every ordinary conversion and
    every stored subscription. Incremental (M = max ``cv_path_start_tstamp`` stored): ordinary
    conversions since ``M - 6h``, touchpoints since ``M - lookback``,
    subscriptions touched and not yet stored, plus the stored paths of
    touched subscriptions re-emitted with current revenue (SURVEY 2.6); which
    those are, and in which partitions, ``dates`` tells (``stored_dates``).
    """
    mapping = inputs.user_mapping
    if existing is None or mark is None:
        ordinary = pth.ordinary_conversions(inputs.conversions, mapping, cfg)
        tps = tpo.touchpoints(inputs.views, mapping, cfg)
        new_subs = pth.new_subscription_conversions(subs, None, mapping, cfg)
        return pth.paths_to_conversion(ordinary.unionByName(new_subs), tps, cfg)
    m = mark
    since_cv = m - dt.timedelta(hours=cfg.lookback_window_hours)
    since_tp = m - dt.timedelta(days=cfg.path_lookback_days)
    ordinary = pth.ordinary_conversions(inputs.conversions, mapping, cfg, since=since_cv)
    dates = dates if dates is not None else stored_dates(existing, this_run, cfg)
    new_subs = pth.new_subscription_conversions(subs, this_run, mapping, cfg, existing_paths=dates)
    if cfg.pad_touchpoints:
        # Cover the whole window of the oldest conversion in scope.
        oldest = low_water(new_subs, "cv_tstamp")
        first = min(since_cv, oldest) if oldest is not None else since_cv
        since_tp = min(since_tp, first - dt.timedelta(days=cfg.path_lookback_days + 1))
    tps = tpo.touchpoints(inputs.views, mapping, cfg, since=since_tp)
    fresh = pth.paths_to_conversion(ordinary.unionByName(new_subs), tps, cfg)
    refreshed = pth.refresh_revenue(existing, subs, dates, cfg)
    return fresh.unionByName(refreshed)


def run_incremental(spark: SparkSession, inputs: Inputs, state_dir: str, cfg: AttributionConfig,
                    run_id: str | None = None) -> RunReport:
    """One scheduled run over the inputs, merging into the tables in
    ``state_dir``. Safe to repeat after a failure."""
    store = TableStore(spark, state_dir)
    if inputs.user_mapping is None or cfg.conversion_stitching:
        return _run(spark, store, inputs, cfg, run_id or uuid.uuid4().hex[:12])
    # Devices are assigned to customers once, by buckets that views, conversions and subscriptions join unshuffled.
    mapping, assigned = bucketed(inputs.user_mapping.select("user_identifier", "user_id"), "user_identifier", "pathcredit_mapping",
                                 "user mapping", store.stage_path("mapping"))
    try:
        return _run(spark, store, replace(inputs, user_mapping=mapping), cfg, run_id or uuid.uuid4().hex[:12])
    finally:
        forget(spark, assigned)


def _run(spark: SparkSession, store: TableStore, inputs: Inputs, cfg: AttributionConfig, run_id: str) -> RunReport:
    manifest = Manifest(store)
    timings: dict[str, float] = {}
    clock = time.perf_counter()

    def lap(name: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        timings[name] = round(now - clock, 3)
        clock = now

    marks = manifest.read()
    sub_mark = marks.get(SUBSCRIPTIONS_MARK, cfg.start_date)
    lap("manifest")

    this_run, _, subs, latest = subscription_stage(spark, store, inputs, cfg, sub_mark)
    lap("subscriptions")

    existing = store.read(PATHS)
    path_mark = marks.get(PATHS_MARK) if existing is not None else None
    dates = store.stage("dates", stored_dates(existing, this_run, cfg)) if path_mark is not None else None
    updates, seen = paths_observed(paths_updates(inputs, cfg, this_run, subs, existing, path_mark, dates))
    updates = pth.rebalanced(updates.withColumn("cv_tstamp_date", F.to_date("cv_tstamp")), "cv_tstamp_date")
    # cv_tstamp of a stored conversion never changes (refreshes keep it), so
    # its date partition is stable.
    paths = store.upsert(PATHS, updates, ["cv_id"], "cv_tstamp_date", stable_partition=True, unique="paths of this run", dealt=True)
    updates = store.updates(PATHS)
    lap("paths")

    # Everything stored later than an older mark came in with some run's updates,
    # so the new marks follow from the old ones and this run's updates.
    attr_mark = marks.get(ATTRIBUTION_MARK)
    # Stored paths lie by date, and so does the scope (the older ones are dealt). Its files are small enough to be
    # unnested as they are read: neither paths nor their rows are shuffled for it.
    scope = att.attribution_scope(paths, updates, this_run, attr_mark, cfg, lambda older: dealt_by_date(older, 0))
    scope = scope.select(*att.PATH_INPUT, F.to_date("cv_tstamp").alias("cv_tstamp_date"))
    scope = store.by_files_of(scope_files(seen.get["bytes"]), "cv_tstamp_date").stage("scope", scope)
    by_date = store.by_ranges(scope, "cv_tstamp_date")
    for dim, table in (("channel", CHANNEL_ATTR), ("campaign", CAMPAIGN_ATTR)):
        # A conversion keeps its date, so keyed by cv_id the partition is stable;
        # composite keys can collide across conversions: look through the updates' dates.
        store.upsert(table, att.attribute(by_date, dim, cfg), attribution_key(cfg), "cv_tstamp_date", stable_partition=cfg.attribution_replace_by_conversion,
                     date_limited=True, dealt=True, same=None if cfg.attribution_replace_by_conversion else att.paths_held(scope, dim),
                     runs=att.texts_of_path(dim))
        lap(f"{dim}_attributions")

    new_sub_mark = max(sub_mark, latest) if latest is not None else sub_mark
    manifest.advance({SUBSCRIPTIONS_MARK: new_sub_mark, ATTRIBUTION_MARK: seen.get["last"], PATHS_MARK: seen.get["start"]}, run_id)
    store.clear_stages()
    lap("manifest_advance")
    now = manifest.read()
    return RunReport(run_id, new_sub_mark, now.get(PATHS_MARK), now.get(ATTRIBUTION_MARK), existing is None, timings,
                     notes_on(cfg) if existing is not None else ())


def notes_on(cfg: AttributionConfig) -> tuple[str, ...]:
    """What the settings kept for parity mean for a run that merges into stored tables."""
    out = []
    if not cfg.attribution_replace_by_conversion:
        out.append("attributions are merged by composite key: where late views changed a conversion's path, its old rows can stay beside "
                   "the new ones and its credit exceed 1; attribution_replace_by_conversion replaces whole conversions")
    if not cfg.pad_touchpoints:
        out.append("conversions before the latest path start lack touches of before the bound, and their stored paths are replaced by such "
                   "shorter ones; pad_touchpoints reads every conversion's whole window")
    if cfg.subscription_ledger_buckets:
        out.append("subscription events later than the late-arrival window aren't in the ledger")
    return tuple(out)


@dataclass
class RunPlan:
    """A run's outputs as lazy DataFrames, without writing anything: what
    ``run_incremental`` would merge, given the tables stored so far."""

    this_run: DataFrame
    subscription_updates: DataFrame
    subscriptions: DataFrame
    paths_updates: DataFrame
    revenue_refresh: DataFrame | None
    paths: DataFrame
    scope: DataFrame

    def attribution_updates(self, dim: str, cfg: AttributionConfig) -> DataFrame:
        return att.attribute(self.scope, dim, cfg)


def plan_run(spark: SparkSession, inputs: Inputs, state_dir: str, cfg: AttributionConfig) -> RunPlan:
    store = TableStore(spark, state_dir)
    marks = Manifest(store).read()
    sid = cfg.subscription_id
    touched = sub.touched_subscriptions(inputs.conversions, marks.get(SUBSCRIPTIONS_MARK, cfg.start_date), cfg)
    this_run = sub.subscription_events(inputs.conversions, touched, cfg)
    sub_updates = sub.build_subscriptions(this_run, cfg)
    stored_subs = store.read(SUBSCRIPTIONS)
    subs = upsert_frames(stored_subs.drop("subscription_start_date") if stored_subs is not None else None,
                         sub_updates, [sid])
    existing = store.read(PATHS)
    existing_core = existing.select(*pth.PATH_COLUMNS) if existing is not None else None
    updates = paths_updates(inputs, cfg, this_run, subs, existing, marks.get(PATHS_MARK))
    refresh = None
    if existing_core is not None:
        refresh = pth.refresh_revenue(existing, subs, stored_dates(existing, this_run, cfg), cfg)
    paths = upsert_frames(existing_core, updates, ["cv_id"])
    scope = att.attribution_scope(paths, updates, this_run, marks.get(ATTRIBUTION_MARK), cfg)
    return RunPlan(this_run, sub_updates, subs, updates, refresh, paths, scope)


def read_table(spark: SparkSession, state_dir: str, name: str) -> DataFrame | None:
    return TableStore(spark, state_dir).read(name)
