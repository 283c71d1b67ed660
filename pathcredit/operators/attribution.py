"""Per-touchpoint credit under four models.

One function serves both dimensions. The path is unnested in place with
``posexplode_outer`` (narrow, no shuffle, no self join); ``is_last`` is
``index == size - 1``, which equals the reference's window max because
``cv_id`` is unique in the paths table.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.columns import path_to_string, ts_lit, weights
from .paths import PATH_COLUMNS

DIMENSIONS = ("channel", "campaign")
#: What attribution reads of a path.
PATH_INPUT = ("cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type", "revenue", *[f"{d}_transformed_path" for d in DIMENSIONS])


def attribution_columns(dim: str) -> tuple[str, ...]:
    return ("composite_key", "cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type", "cv_tstamp_date",
            "cv_total_revenue", f"{dim}_transformed_path", dim, "source_index", "path_length",
            "first_touch_attribution", "last_touch_attribution", "linear_attribution",
            "position_based_attribution")


def texts_of_path(dim: str) -> tuple[str, ...]:
    """The columns that all rows of a path, which lie together, have in common, and the key, which begins alike in them."""
    return ("composite_key", "cv_id", "event_id", "customer_id", f"{dim}_transformed_path")


def attribution_scope(paths: DataFrame, updates: DataFrame | None, this_run: DataFrame | None,
                      last_processed: dt.datetime | None, cfg: AttributionConfig,
                      deal: Callable[[DataFrame], DataFrame] = lambda older: older) -> DataFrame:
    """Rows to (re)attribute on an incremental run: recent conversions
    (``cv_tstamp >= last_processed - lookback``) OR subscriptions touched this
    run.

    The recent ones are read from the stored paths by date partition. Every
    path of a touched subscription is among this run's ``updates`` (a new one
    or a refreshed one), so the older ones come from there and the stored
    paths need no join; ``deal`` says how the tasks that write the scope get them."""
    if last_processed is None:
        return paths
    since = last_processed - dt.timedelta(days=cfg.path_lookback_days)
    recent = paths.filter(F.col("cv_tstamp") >= ts_lit(since))
    if "cv_tstamp_date" in paths.columns:
        recent = recent.filter(F.col("cv_tstamp_date") >= F.lit(since.date()))
    if updates is None or this_run is None:
        return recent
    older = updates.filter(F.col("cv_tstamp") < ts_lit(since)).join(
        this_run.select(F.col(cfg.subscription_id).alias("cv_id")), "cv_id", "left_semi")
    return recent.select(*PATH_COLUMNS).unionByName(deal(older.select(*PATH_COLUMNS)))


def bytes_written() -> Column:
    """About how many bytes the rows of a path take before they are encoded, in the dimension that has more: each of
    its touches is a row with the whole path's text."""
    sizes = [F.coalesce(F.size(F.coalesce(f"{d}_transformed_path", F.array())).cast("double"), F.lit(0.0)) for d in DIMENSIONS]
    n = F.greatest(F.lit(1.0), *sizes)  # a path without touches has one row
    return n * (300.0 + 12.0 * n)


def paths_held(paths: DataFrame, dim: str) -> tuple[dict[str, Column], DataFrame]:
    """What tells an attribution row's whole path (conversion, length and the digest of its text), and these of the
    given paths: a stored row of one of them has the key of the same row made anew, as the text can be read back. Not
    so with null labels, which a text leaves out."""
    arr = F.col(f"{dim}_transformed_path")

    def digest(text: Column) -> Column:
        return F.unhex(F.sha2(text, 256))

    told = {"_path_of": F.col("cv_id"), "_path_size": F.col("path_length"), "_path_text": digest(arr)}
    clear = paths.filter(~F.exists(arr, lambda x: x.isNull()))
    return told, clear.select(F.col("cv_id").alias("_path_of"), F.size(arr).cast("bigint").alias("_path_size"),
                              digest(path_to_string(arr)).alias("_path_text"))


def attribute(paths: DataFrame, dim: str, cfg: AttributionConfig | None = None) -> DataFrame:
    """One row per (conversion, position in its transformed path)."""
    if dim not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {DIMENSIONS}")
    arr = F.col(f"{dim}_transformed_path")
    # a path's text and length once for each conversion, not for each of its touches
    one = paths.select(
        "cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type",
        F.col("revenue").cast("double").alias("cv_total_revenue"),
        arr.alias("_arr"),
        path_to_string(arr).alias("_text"),
        F.when(arr.isNotNull(), F.size(arr)).cast("bigint").alias("_n"),  # size(null) depends on the session
    )
    x = one.select("*", F.posexplode_outer("_arr").alias("_pos", "_touch"))
    idx, n = F.col("_pos").cast("bigint"), F.col("_n")
    w = weights(idx, n)
    out = x.select(
        F.concat(F.col("cv_id"), F.col("_touch"), idx.cast("string")).alias("composite_key"),
        "cv_id", "event_id", "customer_id", "cv_tstamp", "cv_type",
        F.to_date("cv_tstamp").alias("cv_tstamp_date"),
        "cv_total_revenue",
        F.col("_text").alias(f"{dim}_transformed_path"),
        F.col("_touch").cast("string").alias(dim),
        idx.alias("source_index"),
        n.alias("path_length"),
        *[w[m].alias(f"{m}_attribution") for m in ("first_touch", "last_touch", "linear", "position_based")],
    )
    return out
