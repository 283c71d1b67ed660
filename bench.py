"""Benchmark the headline stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (full execution,
nothing collected to the driver); reported time is the median of
$BENCH_REPS runs after one warm-up. The incremental stage times run 2 of the
two-run scenario on a fresh copy of run 1's state each time.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pathcredit.plans import queries as Q  # noqa: E402
from pathcredit.plans.pipeline import Pipeline  # noqa: E402
from pathcredit.session import delete_path, local_session, new_state_dir  # noqa: E402
from pathcredit.sources import fixtures as fx  # noqa: E402
from pathcredit.streaming import incremental as inc  # noqa: E402


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus * 2, 8), app="pathcredit-bench")
    cfg = Q.BASE_CFG

    def pipe() -> Pipeline:
        return Pipeline(fx.load_inputs(spark, sf_dir), cfg)

    def q_subscriptions(p: Pipeline):
        _force(p.subscriptions)

    def q_paths(p: Pipeline):
        _force(p.paths)

    def q_attributions(p: Pipeline):
        _force(p.channel_attributions)
        _force(p.campaign_attributions)

    def q_overview(p: Pipeline):
        _force(p.overview(with_spend=True))

    inputs = fx.load_inputs(spark, sf_dir)
    run1_inputs = Q._cut_inputs(inputs, Q.CUT)

    def setup_run1() -> str:
        state = new_state_dir(spark, "bench")
        inc.run_incremental(spark, run1_inputs, state, cfg, "run1")
        return state

    def q_incremental(state: str):
        inc.run_incremental(spark, inputs, state, cfg, "run2")

    # stage -> (untimed setup, timed body, untimed teardown of what it wrote)
    stages = {
        "subscriptions": (pipe, q_subscriptions, Pipeline.cleanup),
        "paths": (pipe, q_paths, Pipeline.cleanup),
        "attributions": (pipe, q_attributions, Pipeline.cleanup),
        "overview": (pipe, q_overview, Pipeline.cleanup),
        "incremental_run2": (setup_run1, q_incremental, lambda state: delete_path(spark, state)),
    }
    results: dict[str, float] = {}
    for name, (setup, fn, teardown) in stages.items():
        times = []
        for i in range(reps + 1):
            arg = setup()
            t0 = time.perf_counter()
            fn(arg)
            dt = time.perf_counter() - t0
            teardown(arg)
            if i > 0:
                times.append(dt)
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "attribution_pipeline_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
    }))


if __name__ == "__main__":
    main()
