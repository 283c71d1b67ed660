"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with a smallest period q that is at least twice as
long as q and that no neighbouring word extends. For each power of two L the
dictionary names the factors of L words: equal factors of a document get equal
names, which follow from two names of half the length. A run of period q, with
L <= q < 2 L, has at its first word a factor that occurs again q words on. Its
occurrences at most L/2 apart lie in arithmetic progressions (the factor's own
period is their step), and a distance below 2 L skips at most two
progressions. So for each occurrence only the first occurrences of the next three
progressions, and for each progression's first one only the occurrences in the
next three, have to be proposed as periods:
if the run's first word is not where its progression begins, the word q
on begins the other one, or else the run would go further left. That is a
bounded number of proposals an occurrence. Each is extended both ways by the
names, longest first, and of proposals that come to the same stretch the
smallest period stays.

Many documents are taken together, words between them that occur nowhere else;
factors that occur once are left out of the longer ones. One pass, no shuffle.

Defined results: a null, empty or blank text has no words, no runs, and
collapses to the empty text. Repeated rows are judged each. Other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.automaton import heaps
from pathcredit.llm.common import batches, strings

LEAST = 12
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
FOUND_SQL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def factor_names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... words, up to ``longest`` or until none occurs twice: equal factors have
    equal names from 0 on, those that occur once have negative ones."""
    n = len(words)
    levels, at, key, length = [], np.arange(n), words, 1
    while len(at) and length <= longest:
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times > 1
        if not again.any():
            break
        name = np.cumsum(again) - 1
        names = np.arange(-1, -n - 1, -1)
        kept = again[which]
        names[at[kept]] = name[which[kept]]
        levels.append(names.astype(np.int32))
        at = at[kept]
        at = at[at < n - length]
        at = at[names[at + length] >= 0]
        key = names[at] * (int(again.sum()) + 1) + names[at + length]
        length *= 2
    return levels


def proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from ``length`` to twice that, from the occurrences of the factors of ``length`` words."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name = names[at]
    begins = np.r_[True, (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > length)]
    of = np.cumsum(begins) - 1  # the progression of each occurrence
    first, called = at[begins], name[begins]
    places, periods = [], []
    for ahead in (1, 2, 3):
        for there, forward in ((of + ahead, True), (of - ahead, False)):
            some = np.flatnonzero((there >= 0) & (there < len(first)))
            some = some[called[there[some]] == name[some]]
            other = first[there[some]]
            place, period = (at[some], other - at[some]) if forward else (other, at[some] - other)
            fit = (period >= length) & (period < 2 * length)
            places.append(place[fit])
            periods.append(period[fit])
    return np.concatenate(places), np.concatenate(periods)


def agreement(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from places a and b on (or before them)."""
    n, a, b = len(levels[0]), a.copy(), b.copy()
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length = 1 << k
        if forward:
            inside = b + length <= n
            same = inside & (levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 1 if n > 1 else 0)])
            moved = np.where(same, length, 0)
        else:
            inside = a >= length
            same = inside & (levels[k][np.where(inside, a - length, 0)] == levels[k][np.where(inside, b - length, 0)])
            moved = np.where(same, -length, 0)
        a, b, total = a + moved, b + moved, total + np.abs(moved)
    return total


def runs_of(words: np.ndarray, least: int = LEAST, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run of ``least`` words or more, by start and period. ``longest`` is the
    most words that a run can have, where that is known to be fewer than all."""
    none = np.zeros(0, np.int64)
    longest = len(words) if longest is None else longest
    levels = factor_names(words, longest)
    places, periods = [none], [none]
    for k, names in enumerate(levels):
        if 2 << k <= longest:
            place, period = proposals(names, 1 << k)
            places.append(place)
            periods.append(period)
    size = len(words) + 1
    key = np.unique(np.concatenate(periods) * size + np.concatenate(places))
    key = key[np.r_[True, key[1:] != key[:-1] + 1]] if len(key) else key  # neighbours lie in the same run
    if not len(key):
        return none, none, none
    period, place = key // size, key % size
    start = place - agreement(levels, place, place + period, False)
    stop = place + period + agreement(levels, place, place + period, True)
    long = stop - start >= np.maximum(least, 2 * period)
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])] if len(start) else np.zeros(0, bool)
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def of_documents(documents: list[list[str]], least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each document, words counted from 0 in each."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    own = np.repeat(np.arange(len(sizes)), sizes + 1)
    is_word = np.ones(total, bool)
    is_word[starts + sizes] = False
    index = pa.array([w for d in documents for w in d], pa.large_string()).dictionary_encode().indices.to_numpy()
    words = np.empty(total, np.int64)
    words[is_word] = own[is_word] * (int(index.max(initial=0)) + 1) + index
    words[~is_word] = -1 - np.arange(len(sizes))
    start, length, period = runs_of(words, least, int(sizes.max(initial=0)))
    cuts = np.searchsorted(start, np.r_[starts, total])
    return [(start[a:b] - s, length[a:b], period[a:b]) for s, a, b in zip(starts, cuts, cuts[1:])]


def collapsed(words: list[str], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """Every document with its number of words, its runs of ``least`` words or more (by start and period) and its
    text without repetitions, words joined by one space. ``rewrite`` may change a document's words first."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch):
            for held in heaps(zip(batch.column(0).to_pylist(), strings(batch.column(1)))):
                documents = [WORD.findall(text) for _, text in held]
                if rewrite is not None:
                    documents = [rewrite(doc_id, words) for (doc_id, _), words in zip(held, documents)]
                for (doc_id, _), words, (start, length, period) in zip(held, documents, of_documents(documents, least)):
                    runs = [{"start": s, "length": n, "period": p} for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())]
                    yield doc_id, len(words), runs, " ".join(collapsed(words, start, length, period))

        for batch in rows:
            yield from batches(made(batch), FOUND, 1024)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, FOUND_SQL)


def described(found: DataFrame) -> DataFrame:
    """Of each document's runs their number, the greatest (ties: smallest start, then period) and digests."""
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.array_min(ranked))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
