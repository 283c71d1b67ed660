"""Toxicity by compression distance.

Two zstandard dictionaries are trained from labelled documents: one on
ordinary text, one on toxic text. Both hold the common strings of the
language, so only the strings that set toxic text apart make a difference: a
window that the toxic dictionary shortens by more bytes than the ordinary one
counts towards its document. A window is one word between two fixed frames
that both dictionaries know (zstandard's fixed costs swamp a bare word, and
the noise of neighbouring words swamps a longer window; figures in the
README). The threshold on a window's saved bytes and the weights that
turn a document's total into a probability are calibrated on the labels.

Fitting reads a bounded sample of the labelled rows (``ToxicityParams``);
scoring reads every whole text in one pass, without a shuffle.

Defined results: a null or empty text has no window and scores as a document
that saved nothing. Without labels of both kinds the score is the smoothed
share of toxic labels, (n1 + 0.5) / (n + 2), for every text. A doc_id with
both labels teaches nothing. Repeated rows are scored each. Columns beyond
doc_id and text are neither read nor changed.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import Memo, batches, fold, mix64, smallest, strings

SCORE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
#: What tells the hash functions of a text's marks apart.
MARKS = tuple((2654435761 + 2 * 40503 * i) << 24 for i in range(16))
#: ASCII bytes other than letters and digits part words.
PARTS = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
#: Frames of a word, in the dictionaries and in a window: a whole word that a dictionary holds is one match with both its frames.
OPEN, CLOSE = bytes(range(2, 9)), bytes(range(14, 21))


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds and settings of the fit."""

    max_toxic: int = 1500  # labelled toxic documents read for the fit, at most
    max_ordinary: int = 3000  # labelled ordinary documents read for the fit, at most
    longest: int = 200_000  # characters of a document of the fit, at most
    folds: int = 5
    held_out: int = 0  # rows whose fold is this are never learnt from
    base_bytes: int = 24_576  # common strings in each dictionary
    toxic_bytes: int = 8_192  # strings of toxic text, at most
    #: Tried as the least share of toxic documents among those with a string, at 99 % confidence.
    shares: tuple[float, ...] = (0.8, 0.65, 0.5, 0.35, 0.2)
    word_bytes: int = 48  # longer words are cut into windows of this size


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: int
    weights: tuple[float, ...]
    word_bytes: int = 48

    @property
    def trained(self) -> bool:
        return bool(self.toxic)


def words(text: str) -> list[bytes]:
    """Lower-case words between white space and ASCII punctuation."""
    return text.lower().encode("utf-8", "replace").translate(PARTS).split()


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0,
        window_log=16, hash_log=12, chain_log=12, search_log=6, min_match=3, target_length=64,
        strategy=zstandard.STRATEGY_LAZY2)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


@lru_cache(maxsize=4)
def savings(ordinary: bytes, toxic: bytes, threshold: int, word_bytes: int) -> Memo:
    """Word -> bytes by which the toxic dictionary beats the ordinary one, 0 below the threshold."""
    plain, bad = compressor(ordinary).compress, compressor(toxic).compress

    def saved(word: bytes) -> int:
        total = 0
        for at in range(0, len(word), word_bytes):
            window = OPEN + word[at : at + word_bytes] + CLOSE
            gain = len(plain(window)) - len(bad(window))
            total += gain if gain >= threshold else 0
        return total

    return Memo(saved, most=600_000)


def features(total: int, n_words: int) -> tuple[float, float, float]:
    return 1.0, math.log1p(max(0, total)), math.log1p(1000.0 * max(0, total) / max(20, n_words))


def probability(weights: tuple[float, ...], row: tuple[float, ...]) -> float:
    z = sum(a * b for a, b in zip(weights, row))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def score_text(model: ToxicityModel, text: str | None) -> float:
    """Probability of the toxic label for one whole text."""
    if not model.trained:
        return model.weights[0]
    found = words(text or "")
    saved = savings(model.ordinary, model.toxic, model.threshold, model.word_bytes)
    return probability(model.weights, features(sum(map(saved.__getitem__, found)), len(found)))


def marks(w: list[bytes]) -> np.ndarray:
    """Minima of the text's hashed three-word runs under 16 hash functions."""
    runs = np.fromiter((zlib.crc32(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))), np.uint64)
    return np.array([mix64(runs ^ np.uint64(m)).min() for m in MARKS])


def distinct_texts(texts: list[str]) -> list[list[bytes]]:
    """The words of each text, leaving out copies, which would count one author's words many times: texts whose
    marks agree with those of one text before them, itself not left out, in more than half of the places (about
    a Jaccard similarity of one half). A passage that many texts share makes no copies of them."""
    held = np.zeros((len(texts), len(MARKS)), np.uint64)
    kept: list[list[bytes]] = []
    for text in texts:
        w = words(text)
        own = marks(w)
        if not (2 * (held[: len(kept)] == own).sum(1) > len(MARKS)).any():
            held[len(kept)] = own
            kept.append(w)
    return kept


def least_share(hits: int, n: int, z: float = 2.576) -> float:
    """Lower end of the Wilson interval of hits out of n."""
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def telling(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[tuple[float, int, bytes]]:
    """Strings of toxic texts, the surest first: least share of toxic documents, documents, string."""
    bad = Counter(w for d in toxic for w in set(d))
    plain = Counter(w for d in ordinary for w in set(d))
    even = len(toxic) / max(1, len(ordinary))  # as if there were as many documents of both kinds
    return sorted(((least_share(n, n + math.ceil(even * plain[w])), n, w) for w, n in bad.items() if n >= 3), reverse=True)


def best_share(toxic: list[list[bytes]], ordinary: list[list[bytes]], shares: tuple[float, ...]) -> float:
    """The share whose strings, taken from one half of the texts, tell the other half's labels best;
    of shares that reach 95 % of the best one's gain, the highest, which trusts the fewest strings."""
    found = telling(toxic[::2], ordinary[::2])
    rest = [(set(d), y) for kind, y in ((toxic, 1), (ordinary, 0)) for d in kind[1::2]]
    losses = []
    for share in (2.0, *shares):  # no string reaches 2
        strings_ = {w for x, _, w in found if x >= share}
        n = np.ones((2, 2))
        for d, y in rest:
            n[int(not strings_.isdisjoint(d)), y] += 1
        losses.append(-(n * np.log(n / n.sum(axis=1, keepdims=True))).sum())
    enough = losses[0] - 0.95 * (losses[0] - min(losses))
    return next(share for share, loss in zip((2.0, *shares), losses) if loss <= enough)


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]], p: ToxicityParams) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary; empty if no string sets toxic texts apart."""
    share = best_share(toxic, ordinary, p.shares)
    strings_ = [w for x, _, w in telling(toxic, ordinary) if x >= share]
    apart = set(strings_)
    every = Counter(w for d in [*toxic, *ordinary] for w in set(d))
    common = [w for w, _ in sorted(every.items(), key=lambda x: (-x[1], x[0])) if w not in apart]

    def up_to(ws: list[bytes], most: int) -> list[bytes]:
        out, size = [], 0
        for w in ws:
            size += len(w) + len(OPEN + CLOSE)
            if size > most:
                break
            out.append(w)
        return out

    base = up_to(common, p.base_bytes)
    toxic_part = up_to(strings_, p.toxic_bytes)
    filler = up_to(common[len(base) :], sum(len(w) + len(OPEN + CLOSE) for w in toxic_part))
    framed = lambda ws: b"".join(OPEN + w + CLOSE for w in reversed(ws))  # noqa: E731  (what is nearest to the end is cheapest to point at)
    if not toxic_part:
        return b"", b""
    return framed(base) + framed(filler), framed(base) + framed(toxic_part)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a small ridge, by Newton steps; the weights and the mean loss."""
    b = np.zeros(x.shape[1])
    ridge = 1e-3 * weight.sum() / len(y) * np.eye(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (weight * q * (1 - q))) @ x + ridge, x.T @ (weight * (y - q)) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    q = np.clip(1 / (1 + np.exp(-np.clip(x @ b, -30, 30))), 1e-12, 1 - 1e-12)
    return b, float(-(weight * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / weight.sum())


def train(toxic: list[str], ordinary: list[str], n_toxic: int, n_ordinary: int, p: ToxicityParams) -> ToxicityModel:
    """Dictionaries, threshold and weights from sampled texts of both kinds; the counts are those of all labels."""
    prior = ToxicityModel(b"", b"", 0, ((n_toxic + 0.5) / (n_toxic + n_ordinary + 2),))
    if not toxic or not ordinary:
        return prior
    plain, bad = dictionaries(distinct_texts(toxic), distinct_texts(ordinary), p)
    if not bad:
        return prior
    docs = [words(t) for t in [*toxic, *ordinary]]
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    weight = np.where(y == 1, n_toxic / len(toxic), n_ordinary / len(ordinary))
    gains = Memo(savings.__wrapped__(plain, bad, -(1 << 30), p.word_bytes).make, most=1_000_000)
    each = [np.fromiter(map(gains.__getitem__, d), np.int64, len(d)) for d in docs]
    best: tuple[float, int, np.ndarray] | None = None
    for threshold in range(1, 13):
        x = np.array([features(int(g[g >= threshold].sum()), len(g)) for g in each])
        b, loss = logistic(x, y, weight)
        if best is None or loss < best[0] - 1e-9:
            best = loss, threshold, b
    return ToxicityModel(plain, bad, best[1], tuple(float(v) for v in best[2]), p.word_bytes)


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Learn from a sample of the labelled documents outside the held-out fold.

    The sample is the rows of smallest hash of doc_id, at most ``max_toxic``
    and ``max_ordinary``: chosen by id first, so that only the chosen texts
    travel.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & (fold("id", params.folds) != params.held_out))
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).filter("y = top").select("id", "y")
    )
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    texts: dict[int, list[str]] = {0: [], 1: []}
    wanted = None
    for y, most in ((1, params.max_toxic), (0, params.max_ordinary)):
        part = smallest(known.filter(F.col("y") == y), "id", counts.get(y, 0), most)
        wanted = part if wanted is None else wanted.unionByName(part)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        .filter(F.col("text").isNotNull() & (F.length("text") <= params.longest))
        .join(F.broadcast(wanted), "id")  # at most max_toxic + max_ordinary rows
        .select("y", "text").limit(2 * (params.max_toxic + params.max_ordinary))
    )
    for r in rows.collect():
        texts[r["y"]].append(r["text"])
    return train(sorted(texts[1]), sorted(texts[0]), counts.get(1, 0), counts.get(0, 0), params)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = ((i, score_text(model, t)) for i, t in zip(batch.column(0).to_pylist(), strings(batch.column(1))))
            yield from batches(found, SCORE_SCHEMA, 1 << 20)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``at``, all columns as they were."""
    place = docs.columns.index("text")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.filter(pa.array([score_text(model, t) < at for t in strings(batch.column(place))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
