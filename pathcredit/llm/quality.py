"""Quality rules: base counts of each text and divergence from its language.

The references of a language are learnt from all documents: the median share
of each character class over its documents (a median, so that a few per cent
of junk don't bend it) and the shares of its common words. A document is
rejected if its own shares lie further from the nearest language's, in
Jensen-Shannon distance, than ``start + slope / sqrt(words)``: short texts
scatter, so the allowed distance grows for them, and below
``least_words`` words nothing is judged by divergence at all. Base rules
(too few words, too much repetition) reject on their own.

Two passes: one counts words and class shares by language (pre-aggregated in
each task, then summed by key; only common words and bounded bins come to the
driver), one judges each whole text without a shuffle.

Defined results: a null or empty text has no words, all counts 0 and fails the
base rule. A ``lang`` has a reference from ``least_share`` of the documents
on, or from ``least_chars`` characters in ``least_docs`` documents on. A
document of any other ``lang`` is held against the nearest reference with
limits ``wider`` times as far, one without ``lang`` with the plain limits.
Without any reference only the base rules act.
Repeated rows are judged each; other columns are neither read nor changed.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import batches, strings

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ("space", "break", "lower", "upper", "digit", "symbol", "point", "ascii", "letter", "number", "mark", "other")
BINS = 1000
JUDGED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("language", pa.string()), ("class_distance", pa.float64()), ("word_distance", pa.float64())])
JUDGED_SQL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, language string, class_distance double, word_distance double")


@dataclass(frozen=True)
class QualityParams:
    least_share: float = 0.01  # of the documents, for a language to have a reference; fewer do if it has
    least_chars: int = 200_000  # this many characters, some 30,000 words,
    least_docs: int = 50  # in this many documents, for the median
    most_languages: int = 100  # with a reference: those of most characters
    wider: float = 2.0  # limits of documents whose language has no reference
    common: float = 1.5e-4  # occurrences per character of the language, for a word to be common: bounds their number
    least_words: int = 50
    class_start: float = 0.08
    class_slope: float = 1.6
    word_start: float = 0.14
    word_slope: float = 3.0


@dataclass(frozen=True)
class References:
    languages: tuple[str, ...]
    classes: tuple[tuple[float, ...], ...]  # by language, shares by CLASSES
    words: tuple[tuple[tuple[bytes, float], ...], ...]  # by language, (word, share)


def class_of(code: int) -> int:
    c = chr(code)
    if c in WHITE:
        return 0 if c == " " else 1
    if code < 128:
        return 2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit() else 5 if c in SYMBOLS else 6 if c in ".,;:!?'\"()-" else 7
    return {"L": 8, "M": 8, "N": 9, "P": 10}.get(unicodedata.category(c)[0], 11)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of each code point of the first plane, by rule; the planes above share the last entry's class."""
    return np.array([class_of(i) if not 0xD800 <= i < 0xE000 else 11 for i in range(0x10000)], np.uint8)


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(class_table()[np.minimum(codes, 0xFFFF)], minlength=len(CLASSES))


def words(text: str) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated(ids: np.ndarray) -> int:
    """Positions covered by three-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    kinds = int(ids.max()) + 1
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds >= 1 << 20:  # three numbers of a very long text don't fit 64 bits: number its pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    runs = pairs[:-1] * kinds + ids[2:]
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.isin(runs, twice)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(at)] |= at
    return int(covered.sum())


def base_counts(text: str) -> tuple[tuple[int, int, int, int, int], dict[bytes, int], np.ndarray]:
    """The five base counts, the text's distinct words numbered, and how often each occurs."""
    found = words(text)
    number = dict(zip(dict.fromkeys(found), count()))
    ids = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    counts = (len(found), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(ids))
    return counts, number, np.bincount(ids, minlength=len(number))


def base_fails(counts: tuple[int, ...]) -> bool:
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def entropy(x: np.ndarray) -> np.ndarray:
    return -(x * np.log2(x + 1e-300)).sum(-1)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2: 0 to 1; along the last axis."""
    return np.sqrt(np.clip(entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2, 0.0, 1.0))


def part_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``distance`` of whole distributions, given only the columns where p isn't 0: elsewhere half of q counts."""
    inside = entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2
    return np.sqrt(np.clip(inside + (1 - q.sum(-1)) / 2, 0.0, 1.0))


def with_rest(x: np.ndarray) -> np.ndarray:
    """Rows of shares, with what is missing to 1 as a last column."""
    return np.hstack([x, np.clip(1 - x.sum(1, keepdims=True), 0, 1)])


class Judge:
    """Distances of texts from all references at once."""

    def __init__(self, refs: References, p: QualityParams):
        self.refs, self.p = refs, p
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in refs.words for w, _ in ws}))}
        self.classes = np.array(refs.classes).reshape(len(refs.languages), len(CLASSES))
        self.shares = np.zeros((len(refs.languages), len(self.vocabulary)))
        for k, ws in enumerate(refs.words):
            for w, share in ws:
                self.shares[k, self.vocabulary[w]] = share
        self.known = (self.shares > 0).astype(float)
        self.rest = with_rest(self.shares)[:, -1:]

    def distances(self, text: str, number: dict[bytes, int], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By language: of the character classes and of its common words (all others are one bin)."""
        chars = class_counts(text)
        seen = [(self.vocabulary[w], times[number[w]]) for w in self.vocabulary.keys() & number.keys()]
        at = np.array([i for i, _ in seen], np.int64)
        p = self.known[:, at] * (np.array([n for _, n in seen], float) / max(1, times.sum()))
        return distance(chars / max(1, chars.sum()), self.classes), part_distance(with_rest(p), np.hstack([self.shares[:, at], self.rest]))

    def __call__(self, text: str, lang: str | None) -> tuple:
        counts, number, times = base_counts(text)
        failed = base_fails(counts)
        n = counts[0]
        if failed or not self.refs.languages or n < self.p.least_words:
            return *counts, failed, not failed, None, None, None
        by_class, by_word = self.distances(text, number, times)
        at = int(np.argmin(by_class + by_word))
        wide = 1.0 if lang is None or lang in self.refs.languages else self.p.wider
        near = (by_class[at] <= wide * (self.p.class_start + self.p.class_slope / n**0.5)
                and by_word[at] <= wide * (self.p.word_start + self.p.word_slope / n**0.5))
        return *counts, failed, not failed and bool(near), self.refs.languages[at], float(by_class[at]), float(by_word[at])


def learn(docs: DataFrame, params: QualityParams = QualityParams()) -> References:
    """References of the languages that ``lang`` names, from all documents."""
    sizes = docs.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")) \
        .filter("lang is not null")
    total = docs.agg(F.count("*").alias("n")).first()["n"]
    enough = (F.col("n") >= max(1, params.least_share * total)) | ((F.col("chars") >= params.least_chars) & (F.col("n") >= params.least_docs))
    most = sizes.filter(enough).orderBy(F.desc_nulls_last("chars"), "lang").limit(params.most_languages)
    sizes = {r["lang"]: r["chars"] or 0 for r in most.collect()}
    if not sizes:
        return References((), (), ())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("bin", pa.int32()), ("n", pa.int64())])
        held: dict[str, Counter] = {k: Counter() for k in sizes}
        bins: Counter = Counter()

        def out():
            yield from batches(((lang, w, None, n) for lang, ws in held.items() for w, n in ws.items()), schema, 20_000)
            yield from batches(((lang, None, at, n) for (lang, at), n in bins.items()), schema, 20_000)
            bins.clear()
            for ws in held.values():
                ws.clear()

        for batch in rows:
            for lang, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                if lang not in held:
                    continue
                found = words(text)
                held[lang].update(found)
                bins[lang, -1] += len(found)
                if len(found) >= params.least_words:
                    counts = class_counts(text)
                    for at, share in enumerate(np.rint(BINS * counts / counts.sum()).astype(int).tolist()):
                        bins[lang, at * (BINS + 1) + share] += 1
                if sum(map(len, held.values())) > 500_000:
                    yield from out()
        yield from out()

    least = F.coalesce(*[F.when(F.col("lang") == k, F.lit(max(2.0, params.common * v))) for k, v in sorted(sizes.items())])
    rows = (
        docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "lang string, word binary, bin int, n long")
        .groupBy("lang", "word", "bin").agg(F.sum("n").alias("n"))
        .filter(F.col("word").isNull() | (F.col("n") >= least)).collect()
    )
    languages = tuple(sorted(sizes))
    classes, common = [], []
    for lang in languages:
        own = [r for r in rows if r["lang"] == lang]
        n_words = max(1, sum(r["n"] for r in own if r["bin"] == -1))
        bins = np.zeros((len(CLASSES), BINS + 1))
        for r in own:
            if r["bin"] is not None and r["bin"] >= 0:
                bins[divmod(r["bin"], BINS + 1)] = r["n"]
        middle = np.array([np.searchsorted(np.cumsum(b), b.sum() / 2) if b.sum() else 0 for b in bins], float)
        classes.append(tuple(float(x) for x in middle / max(1.0, middle.sum())))
        common.append(tuple(sorted((bytes(r["word"]), r["n"] / n_words) for r in own if r["word"] is not None)))
    taught = [k for k in range(len(languages)) if sum(classes[k]) > 0 and common[k]]
    return References(tuple(languages[k] for k in taught), tuple(classes[k] for k in taught), tuple(common[k] for k in taught))


def judge(docs: DataFrame, refs: References, params: QualityParams = QualityParams()) -> DataFrame:
    """Counts, verdict, nearest language and distances of every row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = Judge(refs, params)
        for batch in rows:
            found = ((i, *verdict(t, lang)) for i, lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2))))
            yield from batches(found, JUDGED, 1 << 20)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, JUDGED_SQL)


def drop_poor(docs: DataFrame, refs: References, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    text_at, lang_at = docs.columns.index("text"), docs.columns.index("lang")
    kept_at = JUDGED.names.index("kept") - 1

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = Judge(refs, params)
        for batch in rows:
            keep = [verdict(t, lang)[kept_at] for t, lang in zip(strings(batch.column(text_at)), batch.column(lang_at).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
