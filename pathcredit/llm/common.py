"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, where that folder exists for
    them too (local mode, a shared home); elsewhere the package is installed or sent with --py-files."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark (the folder may be in any store Spark reads)."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text modulo ``modulus``; null ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def smallest(rows: DataFrame, by: str, n: int, most: int) -> DataFrame:
    """Up to ``most`` of ``n`` rows: those of smallest hash of ``by``. A bound on the hash that leaves about a
    fifth more than are wanted comes first, so that tasks don't each send ``most`` rows."""
    mark = F.pmod(F.xxhash64(by), F.lit(1 << 30))
    return rows.filter(mark < int(min(1.0, 1.2 * most / max(1, n)) * (1 << 30)) + 1).orderBy(mark, by).limit(most)


class Memo(dict):
    """``make(key)`` remembered for at most ``most`` keys; full, it starts afresh, so memory is bounded."""

    def __init__(self, make: Callable, most: int = 300_000, widest: int = 64):
        super().__init__()
        self.make, self.most, self.widest = make, most, widest

    def __missing__(self, key):
        value = self.make(key)
        if not hasattr(key, "__len__") or len(key) <= self.widest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def batches(found: Iterable[tuple], schema: pa.Schema, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples to record batches of at most ``rows`` rows."""
    held: list[tuple] = []
    for row in found:
        held.append(row)
        if len(held) >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def strings(column: pa.Array) -> Iterator[str]:
    """Each value of a text column as str, null as the empty text, without a list of them all."""
    for value in column:
        yield value.as_py() or ""


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def by_group(df: DataFrame, keys: list[str], each: Callable[[tuple, pa.Table], Iterable[tuple]], out: pa.Schema, out_sql: str,
             rows_a_batch: int = 4096) -> DataFrame:
    """``each(key, rows)`` for every group of ``keys`` (the first columns of df): tuples of ``out``.

    Groups stream through sorted partitions, so a partition of very many small groups costs no call into
    Python for each; callers bound the size of a group.
    """
    n = len(keys)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            held: list[pa.Table] = []
            last = None
            for batch in rows:
                if not batch.num_rows:
                    continue
                t = pa.Table.from_batches([batch])
                cols = [t.column(k).to_numpy() for k in range(n)]
                cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist(), t.num_rows]
                for a, b in zip(cuts, cuts[1:]):
                    key = tuple(c[a].item() for c in cols)
                    if key != last and held:
                        yield last, pa.concat_tables(held)
                        held = []
                    last = key
                    held.append(t.slice(a, b - a))
            if held:
                yield last, pa.concat_tables(held)

        yield from batches((row for key, own in groups() for row in each(key, own)), out, rows_a_batch)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, out_sql)
