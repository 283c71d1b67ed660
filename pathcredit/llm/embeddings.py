"""Near-duplicate vectors by cross-polytope hashing.

A hash turns a unit vector by pseudo-random rotations (three rounds of sign
flips and a fast Hadamard transform) and answers the nearest of the 2 d signed
axes. A table's bucket is the answer of several hashes; each vector is also
put in the buckets in which one hash answers its second-nearest axis. The
number of hashes grows with the logarithm of the number of vectors, so buckets
stay small, and the number of tables with it, so recall stays (``plan``).

Links are counted, not listed, where vectors crowd. First vectors close to
a leader of their bucket form a cell: all within half the linking angle of the
leader, so that all of a cell are linked with each other whatever its size.
Then cells that share a bucket are compared by their leaders. The angle
between leaders and the cells' radii show for most pairs of cells that all
their members are linked, or none; members are held against each other, in
blocks of bounded size, only for the rest. A group of thousands of copies is
one cell: it costs one row for each vector.

Two vectors are linked if their cosine in double precision reaches 0.9, and
only pairs that share a bucket are found (recall in the README).

Vectors of different lengths are never linked; a bucket belongs to one length,
and each length has its own number of hashes and tables.

Defined results: one row for each row. A vector that is null, zero, or holds a
null or non-finite component links with nothing and is its own component. Rows
without a vec_id aren't compared: no links, null component, kept. Repeated
rows of one vec_id count as one vector, the least of theirs, and each gets its
result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import batches, by_group, mix64
from pathcredit.llm.components import components
from pathcredit.session import materialize

COSINE = 0.9
MARGIN = 1e-7  # of an angle: nearer to a bound, vectors themselves are compared
BLOCK = 2048  # vectors or cells compared in one task with as many others, at most
HELD = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("keys", pa.list_(pa.int64()))])


def plan(n: int, size: int, cosine: float = COSINE) -> tuple[int, int]:
    """Hashes in a table and tables: buckets about as many as vectors; a pair at the cosine is missed by all
    tables with a probability of about one in fifty."""
    hashes = max(1, round(math.log(max(2, n)) / math.log(2 * size)))
    tau2 = 2 * (1 - cosine)
    one = math.exp(-tau2 / (4 - tau2) * math.log(size)) * 0.9  # of agreeing, or nearly so, in one hash
    return hashes, max(4, math.ceil(math.log(0.02) / math.log(1 - one**hashes)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis, whose length is a power of two; orthonormal."""
    size = x.shape[-1]
    half = 1
    while half < size:
        x = x.reshape(*x.shape[:-1], size // (2 * half), 2, half) if x.shape[-1] == size else x
        x = np.stack([x[..., 0, :] + x[..., 1, :], x[..., 0, :] - x[..., 1, :]], -2).reshape(*x.shape[:-3], size)
        half *= 2
    return x / math.sqrt(size)


def signs(size: int, table: int, which: int, turn: int) -> np.ndarray:
    at = np.arange(size, dtype=np.uint64) + np.uint64((table * 64 + which) * 4 + turn) * np.uint64(1 << 20)
    return np.where(mix64(at + np.uint64(1)) >> np.uint64(63), 1.0, -1.0)


def bucket_keys(x: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """Of unit vectors (rows): for each table the bucket and its probes, as numbers that differ between tables."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.hstack([x, np.zeros((len(x), size - x.shape[1]))])
    rows = np.arange(len(x))
    out = []
    for t in range(tables):
        best, second = [], []
        for h in range(hashes):
            y = x
            for turn in range(3):
                y = hadamard(y * signs(size, t, h, turn))
            near = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            swap = np.abs(y[rows, near[:, 0]]) < np.abs(y[rows, near[:, 1]])
            near[swap] = near[swap][:, ::-1]
            axis = 2 * near + (y[rows[:, None], near] < 0)
            best.append(axis[:, 0])
            second.append(axis[:, 1])
        for probe in range(-1, hashes):
            key = np.full(len(x), t, np.int64)
            for h in range(hashes):
                key = key * (2 * size) + (second[h] if h == probe else best[h])
            out.append(key)
    return np.stack(out, 1)


def unit_vectors(vectors: DataFrame, column: str, plans: dict[int, tuple[int, int]]) -> DataFrame:
    """vec_id, unit vector (bytes of doubles) and bucket keys of the rows whose vector can be linked. ``plans`` has
    the hashes and tables of each length; keys of different lengths differ."""
    place = {size: k for k, size in enumerate(sorted(plans))}

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                ids, raw = own.column(0), own.column(1)
                x = np.array(raw.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
                top = np.abs(x).max(1, keepdims=True)
                x = x / np.where(top > 0, top, 1.0)  # or squares of huge or tiny components leave the range of doubles
                length = np.sqrt((x * x).sum(1))
                good = np.isfinite(length) & (length > 0)
                x = x[good] / length[good, None]
                keys = bucket_keys(x, *plans[size]) * len(plans) + place[size]
                yield from batches(((i, v.tobytes(), k) for i, v, k in zip(ids.filter(pa.array(good)).to_pylist(), x, keys)), HELD)

    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")) \
        .filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return whole.groupBy("vec_id").agg(F.min("x").alias("x")).mapInArrow(run, "vec_id long, v binary, keys array<long>")


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    held = column.to_pylist()
    return np.frombuffer(b"".join(held), np.float64).reshape(len(held), -1)


def cells_of(x: np.ndarray, nearest: float) -> tuple[np.ndarray, np.ndarray]:
    """Greedy: the first vector not in a cell leads one of all that are near enough to it. Leader's row and cosine to it."""
    leader, cosine = np.full(len(x), -1), np.ones(len(x))
    for k in range(len(x)):
        if leader[k] < 0:
            free = np.flatnonzero(leader[k:] < 0) + k
            like = x[free] @ x[k]
            mine = free[(like >= nearest) | (free == k)]
            leader[mine] = k
            cosine[mine] = np.minimum(1.0, x[mine] @ x[k])
            cosine[k] = 1.0
    return leader, cosine


def dealt(rows: DataFrame, key: str, who: str) -> DataFrame:
    """Members of each bucket (``n`` of them) in blocks of about BLOCK; each pair of blocks i <= j is a group."""
    own = F.pmod(F.xxhash64(who), F.col("s")).cast("int")
    return (
        rows.withColumn("s", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    )


def near_vectors(vectors: DataFrame, column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    sizes = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("size")).agg(F.count("*").alias("n")).collect()
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if not sizes:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    angle = math.acos(cosine)
    held = materialize(unit_vectors(vectors, column, {r["size"]: plan(r["n"], r["size"], cosine) for r in sizes}), "vectors")

    # cells, from the first table's buckets; a crowded bucket is cut by hash, which makes more cells and loses nothing
    first = held.select(F.col("keys")[0].alias("key"), "vec_id", "v")
    many = first.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    alone_or_not = first.join(many, "key").select("key", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / BLOCK)).cast("int").alias("part"), "vec_id", "v")
    nearest = math.cos(angle / 2 - MARGIN)

    def cell(key: tuple, rows: pa.Table) -> Iterable[tuple]:
        who, x = rows.column("vec_id").to_numpy(), matrix(rows.column("v"))
        order = np.argsort(who)
        leader, like = cells_of(x[order], nearest)
        return zip(who[order].tolist(), who[order][leader].tolist(), like.tolist())

    grouped = by_group(alone_or_not, ["key", "part"], cell, pa.schema([("vec_id", pa.int64()), ("cell", pa.int64()), ("like", pa.float64())]),
                       "vec_id long, cell long, like double")
    cells = materialize(held.select("vec_id").join(grouped, "vec_id", "left").select(
        "vec_id", F.coalesce("cell", "vec_id").alias("cell"), F.coalesce("like", F.lit(1.0)).alias("like")), "cells")
    about = cells.groupBy("cell").agg(F.count("*").alias("size"), F.acos(F.min("like")).alias("radius"))

    # pairs of cells that share a bucket, by their leaders
    postings = materialize(cells.select("vec_id", "cell").join(held.select("vec_id", F.explode("keys").alias("key")), "vec_id").select("cell", "key").distinct(), "postings")
    crowded = postings.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    centers = about.join(held.select(F.col("vec_id").alias("cell"), "v"), "cell")
    met = dealt(postings.join(crowded, "key").join(centers, "cell"), "key", "cell").select("key", "i", "j", "own", "cell", "radius", "v")

    def compare(key: tuple, rows: pa.Table) -> Iterable[tuple]:
        who, own, radius, x = rows.column("cell").to_numpy(), rows.column("own").to_numpy(), rows.column("radius").to_numpy(), matrix(rows.column("v"))
        for k in range(0, len(who), 256):
            apart = np.arccos(np.clip(x[k : k + 256] @ x.T, -1.0, 1.0))
            reach = radius[k : k + 256, None] + radius[None, :]
            near = (apart <= angle + reach + MARGIN) & (who[k : k + 256, None] < who[None, :])
            if key[1] != key[2]:
                near &= own[k : k + 256, None] != own[None, :]
            for a, b in zip(*np.nonzero(near)):
                yield int(who[k + a]), int(who[b]), bool(apart[a, b] + reach[a, b] <= angle - MARGIN)

    pairs = materialize(by_group(met, ["key", "i", "j"], compare, pa.schema([("a", pa.int64()), ("b", pa.int64()), ("all", pa.bool_())]),
                                 "a long, b long, all boolean").distinct(), "pairs")

    # pairs of cells that are partly linked: members against members, counted in blocks of the larger cell
    open_ = pairs.filter("not all").join(about.select(F.col("cell").alias("a"), F.col("size").alias("size_a")), "a") \
        .join(about.select(F.col("cell").alias("b"), F.col("size").alias("size_b")), "b") \
        .select(F.when(F.expr("size_a >= size_b"), F.col("a")).otherwise(F.col("b")).alias("large"),
                F.when(F.expr("size_a >= size_b"), F.col("b")).otherwise(F.col("a")).alias("small"),
                F.greatest("size_a", "size_b").alias("n_large"), F.least("size_a", "size_b").alias("n_small"))
    counts = links = None
    if not open_.isEmpty():
        where = cells.select("vec_id", "cell").join(held.select("vec_id", "v"), "vec_id")
        part = lambda n: F.pmod(F.xxhash64("vec_id"), F.ceil(F.col(n) / BLOCK)).cast("int")
        both = [F.col("large"), F.col("small")]
        left = open_.join(where.withColumnRenamed("cell", "large"), "large").select(
            *both, part("n_large").alias("i"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_small") / BLOCK).cast("int") - 1)).alias("j"), F.lit(0).alias("side"), "vec_id", "v")
        right = open_.join(where.withColumnRenamed("cell", "small"), "small").select(
            *both, F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_large") / BLOCK).cast("int") - 1)).alias("i"), part("n_small").alias("j"), F.lit(1).alias("side"), "vec_id", "v")

        def members(key: tuple, rows: pa.Table) -> Iterable[tuple]:
            side, who, x = rows.column("side").to_numpy(), rows.column("vec_id").to_numpy(), matrix(rows.column("v"))
            linked = x[side == 0] @ x[side == 1].T >= cosine
            for ids, n in ((who[side == 0], linked.sum(1)), (who[side == 1], linked.sum(0))):
                for i, m in zip(ids[n > 0].tolist(), n[n > 0].tolist()):
                    yield i, m, key[0], key[1]

        some = materialize(by_group(left.unionByName(right), ["large", "small", "i", "j"], members,
                                    pa.schema([("vec_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]),
                                    "vec_id long, n long, a long, b long"), "some")
        counts = some.groupBy("vec_id").agg(F.sum("n").alias("some"))
        links = some.select("a", "b").distinct()

    whole = pairs.filter("all").select("a", "b")
    sums = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        .join(about.select(F.col("cell").alias("b"), "size"), "b").groupBy(F.col("a").alias("cell")).agg(F.sum("size").alias("others"))
    # components of cells; the leader of a cell has its least vec_id
    edges = whole if links is None else whole.unionByName(links)
    named = cells.select("vec_id", "cell").join(components(edges, "a", "b").withColumnRenamed("vertex", "cell"), "cell", "left").select(
        "vec_id", F.coalesce("component", "cell").alias("component"))
    counted = cells.join(about.select("cell", "size"), "cell").join(sums, "cell", "left")
    counted = counted.withColumn("some", F.lit(0)) if counts is None else counted.join(counts, "vec_id", "left")
    counted = counted.select("vec_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0)) + F.coalesce("some", F.lit(0))).cast("long").alias("n_links"))
    return ids.join(counted, "vec_id", "left").join(named, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        (F.col("vec_id").isNull() | (F.coalesce("component", "vec_id") == F.col("vec_id"))).alias("kept"))
