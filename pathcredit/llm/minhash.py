"""Near-duplicate documents by DartMinHash signatures and banded joining.

Signature: each element (a hashed five-word shingle, weight 1, or its number
of occurrences with ``weighted``) receives darts: a Poisson process over
weight and rank, generated from the element's hash alone, region by region of
dyadic weight and rank intervals. A dart counts if its weight coordinate is
under the element's weight; it falls into one of ``bands * rows`` coordinates,
and each coordinate keeps the dart of least rank. Regions are thrown in order
of rank until every coordinate is filled, so a long text throws few darts for
each element and a short one many. Two sets agree in a coordinate with the
probability of their (weighted) Jaccard similarity.

Joining: texts of the same words are one node, so copies cost one row each.
Nodes that agree in a whole band share a bucket. Each member of a bucket is
held against the bucket's least node, exactly, by shingles. Members of
a bucket of three or more that are in different components after this are then
compared with each other by their signatures, in blocks of bounded size, and
the pairs that may reach the similarity are held against each other exactly,
in the task that has them; only links that join components leave it. So no
link is lost that a band shows (1 - (1 - 0.8^6)^21 = 0.998 of pairs at 0.8,
more above), and a bucket of thousands of like texts costs a row for each in
each block, not its pairs. Components of the verified links are the classes.

Defined results: texts without words (null, empty, white space) are like
nothing, each its own class. Texts under five words have one shingle, the
whole; they are like texts of the same words. Words are compared lower-cased.
Rows without a doc_id aren't compared; their class is null and they are kept.
Rows of one doc_id count as one document. Ties: the least doc_id of a class
names it and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import Memo, batches, by_group, mix64, strings
from pathcredit.llm.components import components
from pathcredit.session import materialize

FIRST = 2  # the first rank region ends at 2 ** -FIRST, each further one at twice the end before it
FACTORS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
SKETCH = pa.schema([("doc_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])
SKETCH_SQL = "doc_id long, hi long, lo long, signature binary, bands array<long>"
HELD = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])


@dataclass(frozen=True)
class MinHashParams:
    words: int = 5
    similarity: float = 0.8
    bands: int = 21
    rows: int = 6
    weighted: bool = False
    slack: float = 0.1  # two members of a bucket are verified if their signatures agree in similarity - slack: 2.8 standard errors at the similarity
    block: int = 1024  # members of a bucket in one block; a task compares two blocks

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def _hash_word(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


@lru_cache(maxsize=1)
def word_hashes() -> Memo:
    return Memo(_hash_word, most=500_000)


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def shingles(found: list[bytes], size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; of a shorter text, of the whole."""
    h = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(size, len(h))
    with np.errstate(over="ignore"):
        total = np.full(len(h) - size + 1, np.uint64(size))
        for k in range(size):
            total += h[k : len(h) - size + 1 + k] * FACTORS[k]
    return mix64(total)


@lru_cache(maxsize=64)
def poisson_steps(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson count."""
    top = int(mean + 12 * math.sqrt(mean) + 24)
    return np.cumsum(np.exp([k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(top)]))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(elements: np.ndarray, weights: np.ndarray | None, owner: np.ndarray, owners: int, coordinates: int) -> np.ndarray:
    """For each owner and coordinate 32 bits of its earliest dart.

    ``elements`` are hashes, distinct within an owner; every owner (0 to
    ``owners`` - 1, in order) has at least one.
    """
    best = np.full(owners * coordinates, ~np.uint64(0))
    empty = np.ones(owners * coordinates, bool)
    level = 0
    while len(elements):
        low, high = (0.0, 2.0**-FIRST) if level == 0 else (2.0 ** (level - 1 - FIRST), 2.0 ** (level - FIRST))
        filled = []
        nu = 0
        while nu == 0 or (weights is not None and 2.0**nu - 1 < weights.max()):
            start, width = 2.0**nu - 1, 2.0**nu
            reached = slice(None) if weights is None else weights > start
            with np.errstate(over="ignore"):
                seed = mix64(elements[reached] + FACTORS[nu] * np.uint64(level + 1))
            n = np.searchsorted(poisson_steps(width * (high - low)), unit(seed), side="right")
            at = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            with np.errstate(over="ignore"):
                dart = mix64(seed[at] + FACTORS[63] * (nth + 1).astype(np.uint64))
                rank = mix64(dart + np.uint64(1))  # the upper half orders, the lower half names the dart
            place = owner[reached][at] * coordinates + ((dart >> np.uint64(32)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
            counts = empty[place]
            if weights is not None:
                counts &= start + width * unit(mix64(dart + np.uint64(2))) < weights[reached][at]
            np.minimum.at(best, place[counts], rank[counts])
            filled.append(place[counts])
            nu += 1
        for place in filled:
            empty[place] = False
        open_ = empty.reshape(owners, coordinates).any(1)[owner]
        elements, owner = elements[open_], owner[open_]
        weights = None if weights is None else weights[open_]
        level += 1
    return best.astype(np.uint32).reshape(owners, coordinates)


def sketch_texts(found: list[list[bytes]], p: MinHashParams) -> np.ndarray:
    """Signatures of texts of at least one word each."""
    each = [np.unique(shingles(ws, p.words), return_counts=True) for ws in found]
    weights = np.concatenate([n for _, n in each]).astype(float) if p.weighted else None
    return signatures(np.concatenate([e for e, _ in each]), weights, np.repeat(np.arange(len(each)), [len(e) for e, _ in each]), len(each), p.coordinates)


def band_keys(sig: np.ndarray, p: MinHashParams) -> np.ndarray:
    parts = sig.reshape(p.bands, p.rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix64((mix64(parts + FACTORS[: p.rows]) * FACTORS[: p.rows]).sum(1) + FACTORS[: p.bands]).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, weighted: bool) -> float:
    """Jaccard similarity of two sorted arrays of 32-bit shingle hashes (with repeats if weighted)."""
    if not len(a) or not len(b):
        return 0.0
    if weighted:
        values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = np.bincount(where[: len(a)], minlength=len(values)), np.bincount(where[len(a) :], minlength=len(values))
        return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def sketches(docs: DataFrame, p: MinHashParams) -> DataFrame:
    """Of every row with a doc_id and at least one word: digest of its words, signature, band keys."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch):
            ids, texts, n = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                if found := words(text):
                    ids.append(doc_id)
                    texts.append(found)
                    n += len(found)
                if n > 100_000:
                    yield from sketched(ids, texts)
                    ids, texts, n = [], [], 0
            if ids:
                yield from sketched(ids, texts)

        def sketched(ids, texts):
            for doc_id, found, sig in zip(ids, texts, sketch_texts(texts, p)):
                digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(found)), ">i8")
                yield doc_id, int(digest[0]), int(digest[1]), sig.tobytes(), band_keys(sig, p)

        for batch in rows:
            yield from batches(made(batch), SKETCH)

    return ids_and_texts(docs).mapInArrow(run, SKETCH_SQL)


def ids_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")


def held(docs: DataFrame, p: MinHashParams) -> DataFrame:
    """Shingles of every text, 32 bits each, sorted; distinct unless weighted."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                own = (shingles(words(text), p.words) >> np.uint64(32)).astype(np.uint32)
                yield doc_id, (np.sort(own) if p.weighted else np.unique(own)).tobytes()

        for batch in rows:
            yield from batches(made(batch), HELD)

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, shingles binary")


def verified(pairs: DataFrame, docs: DataFrame, p: MinHashParams) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity.

    Shingles travel once from all texts, dealt by id, and then only those of
    the pairs' ends. Both ends of a pair meet as two rows of a join on the pair.
    """
    ends = pairs.select("a", "b", F.col("a").alias("doc_id")).unionByName(pairs.select("a", "b", F.col("b").alias("doc_id")))
    found = materialize(ends.hint("merge").join(held(docs, p), "doc_id"), "ends")  # one plan at every size, not a broadcast for small inputs
    both = found.filter("doc_id = a").withColumnRenamed("shingles", "x").drop("doc_id").join(
        found.filter("doc_id = b").withColumnRenamed("shingles", "y").drop("doc_id"), ["a", "b"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            like = [similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), p.weighted) >= p.similarity
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(like, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def apart_links(members: DataFrame, p: MinHashParams) -> DataFrame:
    """Links (a < b) between members of one bucket that were in different groups.

    ``members``: band, n (members of the bucket), node, grp, signature, shingles. A bucket over ``block``
    members is cut into blocks; each task sees two of them. Pairs whose signatures agree well are held against
    each other by their shingles where they are, the likeliest first; a pair whose groups earlier links
    have joined is passed over, so what leaves the task joins groups: fewer rows than it has members.
    """
    blocks = F.ceil(F.col("n") / p.block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("s")).cast("int")
    dealt = (
        members.withColumn("s", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
        .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "grp", "signature", "shingles")
    )
    least = math.ceil((p.similarity - p.slack) * p.coordinates)

    def each(key: tuple, rows: pa.Table):
        node, grp, block = (rows.column(c).to_numpy() for c in ("node", "grp", "own"))
        sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(len(node), p.coordinates)
        text = rows.column("shingles")
        joined = {g: g for g in set(grp.tolist())}

        def root(g: int) -> int:
            while joined[g] != g:
                joined[g] = g = joined[joined[g]]
            return g

        found = [], [], []
        for k in range(len(node)):
            later = np.flatnonzero(grp[k + 1 :] != grp[k]) + k + 1
            if key[1] != key[2]:
                later = later[block[later] != block[k]]
            agree = (sig[later] == sig[k]).sum(1)
            at = np.flatnonzero(agree >= least)
            for held_, new in zip(found, (np.full(len(at), k, np.int32), later[at].astype(np.int32), agree[at].astype(np.int16))):
                held_.append(new)
        x, y, agree = (np.concatenate(v) for v in found)
        opened = Memo(lambda k: np.frombuffer(text[k[0]].as_py(), np.uint32), most=4096)
        for at in np.lexsort((node[y], node[x], -agree)).tolist():
            i, j = int(x[at]), int(y[at])
            one, two = root(int(grp[i])), root(int(grp[j]))
            if one != two and similarity(opened[(i,)], opened[(j,)], p.weighted) >= p.similarity:
                joined[max(one, two)] = min(one, two)
                yield min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))

    return by_group(dealt, ["band", "i", "j"], each, pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a long, b long")


def near_duplicates(docs: DataFrame, params: MinHashParams = MinHashParams()) -> DataFrame:
    """doc_id, class_id and kept of every document (rows of one doc_id give one row)."""
    p = params
    found = materialize(sketches(docs, p), "sketches")
    nodes = found.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"))
    members = materialize(found.select("doc_id", "hi", "lo").join(nodes, ["hi", "lo"]).select("doc_id", "node"), "members")
    firsts = found.join(nodes, (found.hi == nodes.hi) & (found.lo == nodes.lo) & (found.doc_id == nodes.node)).select("node", "bands")
    postings = materialize(firsts.select("node", F.explode("bands").alias("band")), "postings")
    leaders = postings.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    led = materialize(postings.join(leaders, "band"), "led")
    star = led.filter("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(verified(star, docs, p), "links")

    # what the least nodes left apart: members of a bucket that are in different components so far
    groups = components(links, "a", "b").select(F.col("vertex").alias("node"), F.col("component").alias("grp"))
    grouped = led.filter("n > 2").join(groups, "node", "left").select("band", "n", "node", F.coalesce("grp", "node").alias("grp"))
    torn = grouped.groupBy("band").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low < high").select("band")
    open_ = materialize(grouped.join(torn, "band"), "open")
    texts = open_.select("node").distinct().hint("merge").join(held(docs, p).withColumnRenamed("doc_id", "node"), "node") \
        .join(found.select(F.col("doc_id").alias("node"), "signature"), "node").dropDuplicates(["node"])
    links = links.unionByName(materialize(apart_links(open_.join(texts, "node"), p), "links"))

    named = components(links.unionByName(members.filter("doc_id != node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))), "a", "b")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return ids.join(named.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("class_id"),
        (F.col("doc_id").isNull() | (F.coalesce("component", "doc_id") == F.col("doc_id"))).alias("kept"))


def one_of_each(docs: DataFrame, params: MinHashParams = MinHashParams()) -> DataFrame:
    """One row of each class, all columns as they were: the one of least doc_id, and among rows
    of that doc_id an arbitrary one. Rows without a doc_id all stay."""
    classes = near_duplicates(docs, params).filter("doc_id is not null")
    gone = classes.filter("not kept").select(F.col("doc_id").alias("_gone"))
    stay = docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    again = docs.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_again")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_again")
    match = F.col("doc_id").cast("long") == F.col("_again")
    once = stay.join(again, match, "left_anti")
    return once.unionByName(stay.join(again, match, "left_semi").dropDuplicates(["doc_id"]))
