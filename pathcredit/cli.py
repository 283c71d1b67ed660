"""Command line: one scheduled incremental run, and the report.

    python -m pathcredit run    --state PATH (--fixtures SF_DIR | --views P --mapping P (--conversions P | --events P))
                                [--config FILE] [--start-date 2024-01-01] [--lookback-days 30] [--window-hours 6]
    python -m pathcredit report --state PATH [--spend P | --fixtures SF_DIR] [--out PATH_OR_TABLE]

Inputs are Parquet paths or table names of the session's catalog (one to three
words: ``db.views``) with the schemas of FIXTURES.md section 1, or the
driver's test tables through the fixture adapter (``--fixtures``). The
session comes from ``SparkSession.builder.getOrCreate()``, so ``spark-submit``
settings (master, executors) apply. ``--config`` is a JSON file with any
setting of ``AttributionConfig``; options override it.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .config import AttributionConfig, ChannelRule, ConversionDef
from .functions.columns import collapse_repeats, unique_path
from .operators.overview import attribution_overview
from .operators.subscriptions import conversions_for_run, extract_conversions
from .sources import fixtures as fx
from .sources.catalog import read_source, write_sink
from .streaming import incremental as inc


#: Named path transforms for a configuration file.
TRANSFORMS = {"unique_path": unique_path, "collapse_repeats": collapse_repeats}


def config_from(told: dict) -> AttributionConfig:
    """An ``AttributionConfig`` from plain values, as a JSON file holds them: any field by its name; times in
    ISO form, lists for tuples, ``channel_rules`` as [condition, label] pairs, ``path_transforms`` by name."""
    known = {f.name for f in dataclasses.fields(AttributionConfig)}
    if unknown := set(told) - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    out = dict(told)
    for k in ("start_date", "conversion_window_start_date", "conversion_window_end_date"):
        if out.get(k):
            out[k] = dt.datetime.fromisoformat(out[k])
    if "channel_rules" in out:
        out["channel_rules"] = tuple(ChannelRule(*r) for r in out["channel_rules"])
    if "path_transforms" in out:
        out["path_transforms"] = tuple(TRANSFORMS[t] for t in out["path_transforms"])
    return AttributionConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in out.items()})


def _config(args: argparse.Namespace) -> tuple[AttributionConfig, dict]:
    """Settings of the configuration file, then of the options; and the file's ``events`` part (for --events)."""
    told = json.loads(Path(args.config).read_text()) if args.config else {}
    events = told.pop("events", {})
    options = {"start_date": args.start_date, "path_lookback_days": args.lookback_days,
               "lookback_window_hours": args.window_hours, "conversion_window_days": args.report_days}
    return config_from(told | {k: v for k, v in options.items() if v is not None}), events


def _conversions(spark: SparkSession, args: argparse.Namespace, events: dict, mapping: DataFrame) -> DataFrame:
    """Conversions as stored, or extracted from raw events (O1): the file's ``events`` part gives
    ``definitions`` ([name, condition, value] each), ``passthroughs`` ([expression, name]), ``event_id`` and ``tstamp``."""
    if not args.events:
        return read_source(spark, args.conversions)
    found = extract_conversions(
        read_source(spark, args.events), [ConversionDef(*d) for d in events.get("definitions", [])],
        [tuple(x) for x in events.get("passthroughs", [])], events.get("event_id", "event_id"), events.get("tstamp", "derived_tstamp"))
    return conversions_for_run(found, mapping)


def _inputs(spark: SparkSession, args: argparse.Namespace, events: dict, need_paths: bool = True) -> fx.Inputs | None:
    if args.fixtures:
        return fx.load_inputs(spark, args.fixtures)
    if not need_paths:
        return None
    missing = [n for n in ("views", "conversions", "mapping") if not (getattr(args, n) or n == "conversions" and args.events)]
    if missing:
        raise SystemExit(f"missing inputs: {', '.join('--' + m for m in missing)} (or --fixtures)")
    def read(told: str) -> DataFrame:
        return read_source(spark, told)

    mapping = read(args.mapping)
    return fx.Inputs(views=read(args.views), conversions=_conversions(spark, args, events, mapping), user_mapping=mapping,
                     spend=read(args.spend) if args.spend else None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m pathcredit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "report"):
        p = sub.add_parser(name)
        p.add_argument("--state", required=True, help="shared folder holding the stored tables")
        p.add_argument("--fixtures", help="driver test-data folder (uses the fixture adapter)")
        p.add_argument("--views")
        p.add_argument("--conversions")
        p.add_argument("--mapping")
        p.add_argument("--spend")
        p.add_argument("--events", help="raw events to extract conversions from, instead of --conversions")
        p.add_argument("--config", help="JSON file with any setting of AttributionConfig, and for --events an \"events\" part")
        p.add_argument("--start-date")
        p.add_argument("--lookback-days", type=int)
        p.add_argument("--window-hours", type=int)
        p.add_argument("--report-days", type=int)
        if name == "report":
            p.add_argument("--out", help="write the report to this Parquet path or table instead of printing it")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    cfg, events = _config(args)
    if args.cmd == "run":
        rep = inc.run_incremental(spark, _inputs(spark, args, events), args.state, cfg)
        print(json.dumps({"run_id": rep.run_id, "first_paths_build": rep.first_paths_build,
                          "subscriptions_mark": str(rep.subscriptions_mark),
                          "attribution_mark": str(rep.attribution_mark), "timings": rep.timings, "notes": rep.notes}))
        return 0
    tables = {t: inc.read_table(spark, args.state, t) for t in (inc.CHANNEL_ATTR, inc.CAMPAIGN_ATTR, inc.SUBSCRIPTIONS)}
    if any(v is None for v in tables.values()):
        raise SystemExit(f"no stored tables under {args.state}: run first")
    inputs = _inputs(spark, args, events, need_paths=False)
    spend = read_source(spark, args.spend) if args.spend else (inputs.spend if inputs else None)
    report = attribution_overview(tables[inc.CHANNEL_ATTR], tables[inc.CAMPAIGN_ATTR], tables[inc.SUBSCRIPTIONS],
                                  spend, cfg)
    if args.out:
        write_sink(report, args.out)
    else:
        for row in report.toLocalIterator():  # the report is one row per touch point and model
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
