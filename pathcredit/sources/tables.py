"""Stored tables of the incremental pipeline: Parquet folders written and read
by plain DataFrame writes and reads, with a keyed upsert.

    <root>/<table>/write=<n>/<date column>=<date>/   rows of the n-th write to the folder
    <root>/_contents/write=<n>/                      the write that holds each partition of each table at a run's end
    <root>/manifest/write=<n>/                       the high-water marks of that run, written last

MERGE INTO needs a lakehouse catalog (Delta / Iceberg), which is not available
here. The upsert (O32) writes the updates under the next number (new columns are
appended, O33) and beside them, into the same folder, those rows of the date
partitions it changes whose keys aren't updated. Which rows stay is found on
keys alone; only rows that stay are read whole and written again. Readers take each partition
from the write that the contents of the last finished run name, a filter on the
two partition columns. A run that stops before its manifest is there changes
nothing that readers see, and its repetition has the same numbers and
overwrites what it left. One run at a time writes to a state folder.
"""

from __future__ import annotations

import copy
import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path

# Directory name Spark gives the partition of null values (fixed value).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WRITE = "write"  # first folder level: the number of the write
CONTENTS = "_contents"
MANIFEST = "manifest"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("last_success", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()),
])
CONTENTS_SCHEMA = "name string, schema string, date_column string, part string, held_by int"
#: Up to so many updated keys are looked for by equality, which the Bloom filters of stored files answer.
FEW_KEYS = 500


@dataclass(frozen=True)
class Stored:
    """A table: its schema, its date column, and the write that holds each partition."""

    schema: str
    date_column: str | None
    parts: dict[str | None, int]


class TableStore:
    """The tables as of the last finished run, and what the run in progress has written. ``commit`` ends it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        numbered = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField(WRITE, T.IntegerType())])
        told = self._rows(MANIFEST, numbered)
        self.commits = sorted({r[WRITE] for r in told})  # the last two or three
        done = self.commits[-1] if told else 0
        self.number = done + 1
        self.marks = [tuple(r)[:-1] for r in told if r[WRITE] == done]
        self.tables = self._contents(done)
        self._updates: dict[str, DataFrame] = {}
        self._runs: dict[str, Sequence[str]] = {}
        self._stage_by: tuple[int, str] | None = None

    # -- what is there ----------------------------------------------------------
    def _rows(self, where: str, schema) -> list:
        """A small table (marks, contents: bounded by tables x calendar); none where nothing was written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{where}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _contents(self, number: int) -> dict[str, Stored]:
        out: dict[str, Stored] = {}
        for r in self._rows(f"{CONTENTS}/{WRITE}={number}", CONTENTS_SCHEMA) if number else []:
            held = out.setdefault(r["name"], Stored(r["schema"], r["date_column"], {}))
            if r["held_by"] is not None:
                held.parts[r["part"]] = r["held_by"]
        return out

    def exists(self, name: str) -> bool:
        return name in self.tables

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _held(self, stored: Stored, number: int) -> Column:
        """The partitions that a write holds, as a filter on partition columns only."""
        if stored.date_column is None:
            return F.col(WRITE) == number
        day = F.col(stored.date_column)
        kind = T.StructType.fromJson(json.loads(stored.schema))[stored.date_column].dataType
        days = [F.lit(p).cast(kind) for p, n in sorted(stored.parts.items(), key=str) if n == number and p is not None]
        tests = ([day.isin(*days)] if days else []) + ([day.isNull()] if stored.parts.get(None) == number else [])
        return (F.col(WRITE) == number) & reduce(or_, tests)

    def read(self, name: str) -> DataFrame | None:
        """The table, ``None`` if it was never written. The stored schema spares readers the footers of all files;
        columns that older files lack are null."""
        stored = self.tables.get(name)
        if stored is None:
            return None
        schema = T.StructType.fromJson(json.loads(stored.schema))
        writes = sorted(set(stored.parts.values()))
        if not writes:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField(WRITE, T.IntegerType())])
        base = self.path(name)
        rows = self.spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{WRITE}={n}" for n in writes])
        return rows.filter(reduce(or_, [self._held(stored, n) for n in writes])).select(*schema.names)

    # -- writes -----------------------------------------------------------
    def _write(self, df: DataFrame, name: str, date_column: str | None, key: Sequence[str] = (), dealt: bool = False,
               mode: str = "overwrite") -> None:
        where = f"{self.path(name)}/{WRITE}={self.number}"
        if date_column is not None and not dealt:
            # REBALANCE on the partition column: AQE coalesces small output
            # partitions (few files per date) and splits skewed ones (a date
            # holding a large share of rows is written by several tasks).
            df = df.hint("rebalance", date_column)
        writer = df.write.mode(mode).option("parquet.bloom.filter.adaptive.enabled", "true")
        # the second version's pages hold what a string has in common with the one before it once, as most of a key is
        writer = writer.option("parquet.writer.version", "v2")
        for k in key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        for c in self._runs.get(name, ()):
            # a dictionary would hash and compare every value's bytes; the difference from the one before is nothing or little
            writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
        (writer.partitionBy(date_column) if date_column else writer).parquet(where)

    def _now(self, name: str, schema: T.StructType, date_column: str | None, parts: dict[str | None, int]) -> DataFrame:
        self.tables[name] = Stored(json.dumps(schema.jsonValue()), date_column, parts)
        self.number += 1
        return self.read(name)

    def _written(self, name: str, schema: T.StructType) -> DataFrame:
        """What the write in progress holds so far; files added later aren't seen."""
        return self.spark.read.schema(schema).parquet(f"{self.path(name)}/{WRITE}={self.number}").select(*schema.names)

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Replace the whole table (the table of this run's events)."""
        self._write(df, name, None)
        return self._now(name, df.schema, None, {None: self.number})

    def stage_path(self, name: str) -> str:
        return f"{self.root}/_staging/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once beside the tables and read back; ``clear_stages`` removes it."""
        where = self.stage_path(name)
        if self._stage_by is None:
            df.write.parquet(where)
        else:
            rows, column = self._stage_by
            df.write.option("maxRecordsPerFile", rows).partitionBy(column).parquet(where)
        return self.spark.read.schema(df.schema).parquet(where).select(*df.columns)

    def by_files_of(self, rows: int, date_column: str) -> TableStore:
        """The same store, whose stages have a folder for each date and at most so many rows a file."""
        same = copy.copy(self)
        same._stage_by = rows, date_column
        return same

    def by_ranges(self, df: DataFrame, date_column: str, most: int = 32) -> DataFrame:
        """A table stored by date in the order of its dates, read by at most so many scans: a task has few dates."""
        dates = self._values(df, date_column)
        known = sorted(d for d in dates if d is not None)
        step = max(1, -(-len(known) // most))
        spans = [known[a : a + step] for a in range(0, len(known), step)]
        day = F.col(date_column)
        tests = [day.between(*[F.lit(d).cast(df.schema[date_column].dataType) for d in (span[0], span[-1])]) for span in spans]
        tests += [day.isNull()] if None in dates else []
        return reduce(DataFrame.unionAll, [df.filter(t) for t in tests]) if tests else df

    def clear_stages(self) -> None:
        delete_path(self.spark, f"{self.root}/_staging")

    def upsert(self, name: str, updates: DataFrame, key: Sequence[str], date_column: str,
               stable_partition: bool = False, date_limited: bool = False, unique: str | None = None,
               dealt: bool = False, same: tuple[dict[str, Column], DataFrame] | None = None,
               runs: Sequence[str] = ()) -> DataFrame:
        """Replace whole rows whose key is in ``updates``, insert the
        others, delete nothing. Returns the table as read back. The updates are
        computed once, as they are written (``dealt``: they come in tasks of few
        dates and moderate size, and aren't shuffled for it); ``updates`` has
        them as read back.

        Older rows of an updated key are looked for in all partitions (of which
        only the key is read); with ``date_limited`` in those from the
        updates' first date to their last, which are few and get no Bloom filters; with ``stable_partition`` (a key
        never changes its date) in the updates' own partitions only, without a
        scan to find them. With ``unique`` (what the updates are) a key that
        occurs twice among them is an error; the keys' join counts them.

        ``same`` spares most keys the search: expressions over a stored row, by name, and a table of values. A stored
        row that has one of them (none of it null) has an updated key; only other rows' keys are looked for.

        ``runs``: text columns whose values mostly are, or begin like, those of the row before."""
        key = list(key)
        self._runs[name] = runs
        target = self.read(name)
        schema = updates.schema if target is None else target.unionByName(updates, allowMissingColumns=True).schema
        updates = updates.select(*[F.col(c).cast(schema[c].dataType) for c in updates.columns])
        filtered = [] if date_limited else key
        self._write(updates, name, date_column, filtered, dealt)
        new = self._updates[name] = self._written(name, updates.schema)
        dates = self._values(new, date_column)
        if target is not None and not dates:  # no updates
            return target
        parts = self.tables[name].parts if target is not None else {}
        keys = new.select(*key)
        if not stable_partition:
            # partitions without updates that may hold an older row of an updated key
            known = [d for d in dates if d is not None]
            others = {d for d in parts if d not in dates
                      and (not date_limited or d is None or (known and min(known) <= d <= max(known)))}
            if others:
                near = target.filter(self._among(date_column, others))
                dates |= self._values(rows_of_keys(near.select(*key, date_column), keys, key), date_column)
        changed = {d for d in dates if d in parts}
        if changed:
            rows = target.filter(self._among(date_column, changed))
            if same is not None:
                rows, keys = self._unlike(rows, keys, key, *same)
            kept = self._kept(rows, keys, key, unique) if rows is not None else None
            if kept is not None:
                kept = kept.select(*[F.col(c).cast(schema[c].dataType) for c in kept.columns])
                self._write(kept, name, date_column, filtered, mode="append")
        elif unique:
            require_unique(keys, key, unique)
        return self._now(name, schema, date_column, parts | dict.fromkeys(dates, self.number))

    def updates(self, name: str) -> DataFrame:
        """The rows of this run's upsert into a table."""
        return self._updates[name]

    def _unlike(self, rows: DataFrame, keys: DataFrame, key: list[str], told: dict[str, Column], values: DataFrame
                ) -> tuple[DataFrame | None, DataFrame]:
        """The stored rows without one of the told values (``None`` if there are none), and the updated keys among theirs."""
        marked = rows.select("*", *[c.alias(n) for n, c in told.items()])
        rest = self.stage("unlike", marked.select(*told).distinct().join(values, list(told), "left_anti"))
        if rest.isEmpty():
            return None, keys
        found = marked.join(rest, reduce(and_, [marked[n].eqNullSafe(rest[n]) for n in told]), "left_semi").select(*rows.columns)
        near = self.stage("near", found.select(*key).distinct())
        return found, keys.join(near, key, "left_semi")

    def _kept(self, rows: DataFrame, keys: DataFrame, key: list[str], unique: str | None) -> DataFrame | None:
        """The rows whose key isn't among ``keys``; ``None`` if there are none. Which keys those are is found on keys
        alone: where a run replaces nearly all rows, as one over its lookback does, no old row is read whole."""
        if unique:
            counted = self.stage("keys", keys.groupBy(*key).count())
            if not counted.filter("count > 1").isEmpty():
                require_unique(keys, key, unique)
            keys = counted.select(*key)
        else:
            keys = keys.distinct()
        stay = self.stage("kept", rows.select(*key).distinct().join(keys, key, "left_anti"))
        n = stay.count()
        if not n:
            return None
        if 2 * n > rows.count():
            return rows.join(keys, key, "left_anti")
        return rows.join(stay, reduce(and_, [rows[k].eqNullSafe(stay[k]) for k in key]), "left_semi")

    @staticmethod
    def _among(date_column: str, dates: set[str | None]) -> Column:
        test = F.col(date_column).cast("string").isin(sorted(d for d in dates if d is not None))
        return test | F.col(date_column).isNull() if None in dates else test

    @staticmethod
    def _values(df: DataFrame, col: str) -> set[str | None]:
        """Distinct values of a date partition column (bounded by the
        calendar), as partition directory strings; ``None`` for null."""
        return {None if r[0] is None else str(r[0]) for r in df.select(col).distinct().collect()}

    # -- the end of a run -----------------------------------------------------------
    def commit(self, marks: Sequence[tuple] | None = None) -> None:
        """End a run: its contents, then its marks (those of the run before where none are given), are written, and
        readers see its tables. What neither this run nor the one before it holds is deleted afterwards."""
        marks = [tuple(m) for m in (self.marks if marks is None else marks)] or [(None, None, None)]
        rows = [(name, t.schema, t.date_column, part, n) for name, t in self.tables.items() for part, n in (t.parts or {None: None}).items()]
        for kind, values, schema in ((CONTENTS, rows, CONTENTS_SCHEMA), (MANIFEST, marks, MANIFEST_SCHEMA)):
            self.spark.createDataFrame(values, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{kind}/{WRITE}={self.number}")
        self.commits.append(self.number)
        self.marks, self.number = marks, self.number + 1
        self._tidy()

    def _tidy(self) -> None:
        while len(self.commits) > 2:
            old = self.commits.pop(0)
            kept = self._contents(self.commits[0])
            for name, t in self._contents(old).items():
                for part, n in t.parts.items():
                    if name not in kept or kept[name].parts.get(part) != n:
                        folder = "" if t.date_column is None else f"/{t.date_column}={NULL_PARTITION if part is None else part}"
                        delete_path(self.spark, f"{self.path(name)}/{WRITE}={n}{folder}")
            for kind in (MANIFEST, CONTENTS):
                delete_path(self.spark, f"{self.root}/{kind}/{WRITE}={old}")

    def drop(self, name: str) -> None:
        """Forget a table, as a run of its own."""
        if self.tables.pop(name, None) is not None:
            self.commit()


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: Sequence[str], few: int = FEW_KEYS) -> DataFrame:
    """The rows whose key is among ``keys``. A few keys are read on the driver and become equality tests, which
    skip every stored row group whose Bloom filter lacks them; more are joined."""
    first = key[0]
    # an estimate without a shuffle tells whether it's worth collecting them
    told = keys.agg(F.approx_count_distinct(first)).first()[0]
    told = keys.select(first).distinct().limit(few + 1).collect() if told <= 2 * few else None
    if told is not None and len(told) <= few:
        values = [r[0] for r in told if r[0] is not None]
        # tests of ten, as many as are pushed to the files one by one
        tests = [F.col(first).isin(*values[a : a + 10]) for a in range(0, len(values), 10)]
        rows = rows.filter(reduce(or_, tests, F.lit(False)) if tests else F.lit(False))
    return rows.join(keys, list(key), "left_semi")


def upsert_frames(target: DataFrame | None, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """The upsert as a pure DataFrame expression (no storage): the target's
    rows without an updated key, union the updates, columns appended."""
    if target is None:
        return updates
    key = list(key)
    kept = target.join(updates.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (SURVEY 2.4: conversions must be unique
    on ``cv_id`` and the user mapping on ``user_identifier``; duplicates fan
    out joins). An aggregate, so it runs distributed; callers take a few."""
    return df.groupBy(*key).count().filter(F.col("count") > 1)


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    """Raise if a key occurs twice, naming a few."""
    found = duplicate_keys(df.select(*key), key).limit(3).collect()
    if found:
        raise ValueError(f"{what}: {', '.join(key)} must be unique; repeated: " + "; ".join(str(tuple(r)[:-1]) for r in found))
