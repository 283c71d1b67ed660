"""Stored tables: what a stopped write leaves, empty tables, uniqueness, dropped tables."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pathcredit.config import AttributionConfig
from pathcredit.functions.columns import path_to_string, string_to_path
from pathcredit.session import new_state_dir
from pathcredit.sources import fixtures as fx
from pathcredit.sources.tables import TableStore, require_unique, rows_of_keys
from pathcredit.streaming import incremental as inc

CFG = AttributionConfig()


def rows(spark, values):
    return spark.createDataFrame([(k, dt.date(2024, 1, d), v) for k, d, v in values], "k string, d date, v int")


def content(store):
    return sorted((r.k, r.d.day, r.v) for r in store.read("t").collect())


@pytest.mark.parametrize("step", ["_write", "commit"])
def test_a_stopped_upsert_changes_nothing_and_can_be_repeated(spark, monkeypatch, step):
    root = new_state_dir(spark, "test-stop")
    store = TableStore(spark, root)
    store.upsert("t", rows(spark, [("a", 1, 1), ("b", 1, 1), ("c", 2, 1)]), ["k"], "d")
    store.commit()
    before = content(store)
    updates = store.stage("u", rows(spark, [("a", 2, 9), ("d", 1, 9)]))

    whole = getattr(TableStore, step)

    def stop(self, *a, **k):
        if step == "_write":
            whole(self, *a, **k)  # all files are there, nothing names them
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(TableStore, step, stop)
        with pytest.raises(RuntimeError):
            store.upsert("t", updates, ["k"], "d")
            store.commit()
    store = TableStore(spark, root)
    assert content(store) == before
    store.upsert("t", updates, ["k"], "d")
    store.commit()
    assert content(TableStore(spark, root)) == [("a", 2, 9), ("b", 1, 1), ("c", 2, 1), ("d", 1, 9)]


def test_a_reader_keeps_its_version_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path / "state")
    store = TableStore(spark, root)
    store.upsert("t", rows(spark, [("a", 1, 1), ("z", 9, 1)]), ["k"], "d")
    store.commit()
    held = store.read("t")
    for v in range(2, 6):
        store.upsert("t", store.stage("u", rows(spark, [("a", 1, v)])), ["k"], "d")
        store.commit()
        if v == 2:
            assert [r.v for r in held.filter("k = 'a'").collect()] == [1]
    assert content(TableStore(spark, root)) == [("a", 1, 5), ("z", 9, 1)]
    files = sorted(str(p.relative_to(tmp_path / "state" / "t").parent) for p in (tmp_path / "state" / "t").rglob("*.parquet"))
    assert len(files) == 3 and sum("d=2024-01-09" in f for f in files) == 1  # two versions of one date, one of the other


def test_only_written_dates_are_written_anew(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "state"))
    store.upsert("t", rows(spark, [(f"k{d}", d, 1) for d in range(1, 9)]), ["k"], "d")
    store.upsert("t", store.stage("u", rows(spark, [("k3", 5, 2)])), ["k"], "d")
    written = {p.parent.name for p in (tmp_path / "state" / "t" / "write=2").rglob("*.parquet")}
    assert written == {"d=2024-01-05"}  # the 3rd is left without rows
    assert content(store) == [(f"k{d}", d, 1) for d in (1, 2)] + [("k3", 5, 2)] + [(f"k{d}", d, 1) for d in range(4, 9)]


def test_older_rows_of_few_keys_are_found_by_bloom_filters(spark, tmp_path):
    """Row groups whose filter lacks the keys aren't read, though their range of keys covers them."""
    store = TableStore(spark, str(tmp_path / "state"))
    every = spark.range(40_000).selectExpr("sha1(string(id)) as k", "date_add(date'2024-01-01', cast(id % 20 as int)) as d", "cast(id as int) as v")
    store.upsert("t", every, ["k"], "d")
    keys = store.stage("u", every.filter("v in (7, 11)")).select("k")
    found = rows_of_keys(store.read("t").select("k", "d"), keys, ["k"])
    assert sorted(str(r.d) for r in found.collect()) == ["2024-01-08", "2024-01-12"]

    def scanned(df) -> int:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
        leaves, most = plan.collectLeaves(), 0
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            leaf = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf
            inner = leaf.collectLeaves()
            for j in range(inner.size()):
                metrics = inner.apply(j).metrics()
                if metrics.contains("numOutputRows"):
                    most = max(most, metrics.apply("numOutputRows").value())
        return most

    assert scanned(rows_of_keys(store.read("t").select("k", "d"), keys, ["k"])) <= 4_000
    assert scanned(rows_of_keys(store.read("t").select("k", "d"), keys, ["k"], few=1)) == 40_000


def test_empty_tables(spark):
    store = TableStore(spark, new_state_dir(spark, "test-empty"))
    assert store.read("t") is None
    store.upsert("t", rows(spark, []), ["k"], "d")
    assert content(store) == []
    store.upsert("t", store.stage("u", rows(spark, [("a", 1, 1)])), ["k"], "d")
    assert content(store) == [("a", 1, 1)]


def test_a_first_run_without_subscriptions(spark, sf_small):
    inp = fx.load_inputs(spark, sf_small)
    only = fx.Inputs(views=inp.views, conversions=inp.conversions.filter("cv_type = 'signup'"), user_mapping=inp.user_mapping, spend=inp.spend)
    state = new_state_dir(spark, "test-signups")
    inc.run_incremental(spark, only, state, CFG, "run1")
    n = inc.read_table(spark, state, inc.PATHS).count()
    assert n > 0 and inc.read_table(spark, state, inc.SUBSCRIPTIONS).count() == 0
    inc.run_incremental(spark, inp, state, CFG, "run2")
    assert inc.read_table(spark, state, inc.PATHS).count() > n


def test_repeated_keys_are_refused(spark):
    with pytest.raises(ValueError, match="must be unique"):
        require_unique(rows(spark, [("a", 1, 1), ("a", 2, 1)]), ["k"], "table")


def test_path_strings_round_trip(spark):
    """Any labels come back, those with the separator, its sign or the escape sign too; ordinary ones are written as they are."""
    r = random.Random(1)
    parts = [" > ", ">", " ", "\\", "a", "b", "\\>", " \\> ", "> ", " >", "$1", ""]
    values = [["a", "b c", "d"], ["x"], ["a>b", "c->d", "\\"], *([("".join(r.choice(parts) for _ in range(r.randint(0, 5)))) for _ in range(r.randint(1, 4))]
                                                         for _ in range(3000))]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "p array<string>")
    got = df.select("p", path_to_string(F.col("p")).alias("s")).withColumn("q", string_to_path(F.col("s"))).collect()
    assert all(r.p == r.q for r in got) and got[-1].s is None
    assert [r.s for r in got[:3]] == ["a > b c > d", "x", "a>b > c->d > \\"]
    plain = [r for r in got[:-1] if not any(re.search(r"(^| )\\*>( |$)", x) for x in r.p)]
    assert len(plain) > 100 and all(r.s == " > ".join(r.p) for r in plain)


def test_settings_from_plain_values():
    from pathcredit.cli import config_from

    cfg = config_from({"start_date": "2024-02-01", "channels_to_exclude": ["Direct"], "channel_rules": [["medium = 'cpc'", "Paid"]],
                       "path_transforms": ["unique_path"], "conversion_stitching": True})
    assert cfg.start_date == dt.datetime(2024, 2, 1) and cfg.channels_to_exclude == ("Direct",)
    assert cfg.channel_rules[0].label == "Paid" and len(cfg.path_transforms) == 1 and cfg.conversion_stitching
    with pytest.raises(ValueError):
        config_from({"no_such": 1})


def test_sources_and_sinks_by_name_or_path(spark, tmp_path):
    from pathcredit.sources.catalog import is_name, read_source, write_sink

    assert [is_name(x) for x in ("views", "db.views", "cat.db.views", "`odd name`.views", "./views", "/a/views", "s3://b/views", "a b")] \
        == [True, True, True, True, False, False, False, False]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sinks LOCATION '{tmp_path}/db'")
    for told in ("sinks.t", str(tmp_path / "t")):
        write_sink(rows(spark, [("a", 1, 1), ("b", 2, 2)]), told, "d")
        assert sorted(r.k for r in read_source(spark, told).collect()) == ["a", "b"]
        write_sink(rows(spark, [("c", 3, 3)]), told, "d")
        if told == "sinks.t":
            spark.catalog.refreshTable(told)
        assert [(r.k, r.v) for r in read_source(spark, told).collect()] == [("c", 3)]
    spark.sql("DROP DATABASE sinks CASCADE")


def test_the_command_line_reads_and_writes_tables_by_name(spark, sf_small, tmp_path, monkeypatch, capsys):
    from pathcredit import cli
    from pathcredit.sources.catalog import write_sink

    spark.sql(f"CREATE DATABASE IF NOT EXISTS told LOCATION '{tmp_path}/db'")
    inp = fx.load_inputs(spark, sf_small)
    for name in ("views", "conversions", "user_mapping", "spend"):
        write_sink(getattr(inp, name), f"told.{name}")
    state = new_state_dir(spark, "test-cli")
    assert cli.main(["run", "--state", state, "--views", "told.views", "--conversions", "told.conversions", "--mapping", "told.user_mapping"]) == 0
    assert cli.main(["report", "--state", state, "--spend", "told.spend", "--out", "told.report"]) == 0
    assert spark.table("told.report").count() == 36
    spark.sql("DROP DATABASE told CASCADE")
