"""Alignment of two tokenizers by galloping intersection.

Both tokenizers cut the same bytes; what they share are the offsets at which a
token of each ends. The shorter list of ends drives: each of its ends is looked
for in the longer list from where the one before was found, in steps that
double, then by binary search between the last two. The common ends slice both
lists into groups; the differences of the ranks of neighbouring common ends are
the numbers of tokens in a group. Lists are taken side by side in lanes of
``LANE`` ends, the first of which is found by binary search.

Pairs that end together are counted over all documents: each task sums its own
before the shuffle. Of two tokens that end together one's bytes end the
other's, so the pairs are bounded by the vocabularies (324,297 for the two used
here, whatever the corpus) and the table of their counts is sent to every
task. Documents are tokenized once; their pairs wait for the counts in a table
in the shared folder.

Defined results: a text that is null or empty, or whose tokens of either side
don't spell a space and the text (U+2581 is a space to one of them), has no
tokens: zeros and an empty string. Repeated rows are aligned, and their pairs
counted, each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.automaton import heaps
from pathcredit.llm.common import batches, strings
from pathcredit.llm.packing import ids_of
from pathcredit.session import materialize

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
LANE = 32
SPACE = "▁"
ALIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
ALIGNED_SQL = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>, times array<int>"
TOKENS = [("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("a_in_group", pa.list_(pa.int32())), ("b_in_group", pa.list_(pa.int32()))]


def gallop(short: np.ndarray, long: np.ndarray, lane: int = LANE) -> np.ndarray:
    """For each of the rising numbers ``short`` the place of the first number of the rising ``long`` that is not less."""
    n = len(long)
    long = np.append(long, np.iinfo(np.int64).max)
    out = np.empty(len(short), np.int64)
    heads = np.arange(0, len(short), lane)
    cursor = np.searchsorted(long[:n], short[heads])
    out[heads] = cursor
    for step in range(1, lane):
        heads = heads[heads + step < len(short)]
        if not len(heads):
            break
        low = cursor[: len(heads)]
        target = short[heads + step]
        far = np.flatnonzero(long[low] < target)  # these are not there yet
        jump = np.ones(len(far), np.int64)
        at = far
        edge = low[far].copy()  # less than the target
        beyond = np.empty(len(far), np.int64)  # not less
        open_ = np.arange(len(far))
        while len(at):
            probe = np.minimum(edge[open_] + jump[open_], n)
            less = long[probe] < target[at]
            beyond[open_[~less]] = probe[~less]
            at, open_, probe = at[less], open_[less], probe[less]
            edge[open_] = probe
            jump[open_] *= 2
        narrow = np.flatnonzero(beyond - edge > 1)
        while len(narrow):
            middle = (edge[narrow] + beyond[narrow]) // 2
            less = long[middle] < target[far[narrow]]
            edge[narrow[less]] = middle[less]
            beyond[narrow[~less]] = middle[~less]
            narrow = narrow[beyond[narrow] - edge[narrow] > 1]
        low = low.copy()
        low[far] = beyond
        out[heads + step] = low
        cursor = low
    return out


class Side(NamedTuple):
    """The tokens of many documents one behind the other: ids, their bytes, and the number in each document."""

    ids: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def common_ends(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of either side that end where one of the other does; documents spell the same bytes on both."""
    ends = np.cumsum(a.sizes), np.cumsum(b.sizes)
    shorter = a.counts <= b.counts  # of each document: does a drive?
    in_a, in_b = np.repeat(shorter, a.counts), np.repeat(shorter, b.counts)

    def dealt(first: np.ndarray, second: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One list of the chosen ends and which token each belongs to; offsets rise from document to document."""
        at = np.concatenate([np.flatnonzero(of_a), np.flatnonzero(of_b)])
        values = np.concatenate([first[of_a], second[of_b]])
        order = np.argsort(values, kind="stable")
        return values[order], at[order]

    short, token = dealt(*ends, in_a, ~in_b)
    long, other = dealt(*ends, ~in_a, in_b)
    place = gallop(short, long)
    place = np.minimum(place, max(len(long) - 1, 0))
    common = long[place] == short if len(long) else np.zeros(0, bool)
    token, other, = token[common], other[place[common]]
    document = np.searchsorted(np.cumsum(np.where(shorter, a.counts, b.counts)), np.flatnonzero(common), "right")
    drives = shorter[document] if len(document) else np.zeros(0, bool)
    return np.where(drives, token, other), np.where(drives, other, token)


class Tokens:
    """Ids and token bytes of both tokenizers."""

    def __init__(self, left: str, right: str):
        self.left = ids_of(left)
        vocabulary = self.left.encoding._mergeable_ranks
        self.a_size = 1 + max(vocabulary.values())
        self.a_bytes: list[bytes] = [b""] * self.a_size
        for token, i in vocabulary.items():
            self.a_bytes[i] = token
        self.right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(right))
        self.b_size = self.right.get_piece_size()
        self.b_bytes = [b"" if self.right.is_control(i) or self.right.is_unknown(i)
                        else bytes([int(p[3:5], 16)]) if self.right.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(map(self.right.id_to_piece, range(self.b_size)))]
        if self.a_size * self.b_size >= 1 << 31:
            raise ValueError("pairs of these vocabularies don't fit 32 bits")
        self.a_length, self.b_length = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        #: The decimal of an id with what follows it: within its group, or at the group's end.
        a, b = list(map(str, range(self.a_size))), list(map(str, range(self.b_size)))
        self.text = np.array([x + e for ids, ends in ((a, ",|"), (b, ",;")) for e in ends for x in ids], object)

    def __call__(self, texts: list[str]) -> tuple[Side, Side]:
        """The tokens of both sides of each text; none where either doesn't spell a space and the text."""
        sides: list[tuple[list, list]] = [], []
        spelled = []
        for text, b in zip(texts, self.right.encode(texts, num_threads=1) if texts else []):
            a, b = np.frombuffer(self.left.plain(" " + text), "<u4") if text else np.zeros(0, np.uint32), np.array(b, np.int64)
            raw = (" " + text).encode()
            # as many bytes on both sides, and no space that one of them has made of something else
            right = bool(text) and self.a_length[a].sum() == len(raw) == self.b_length[b].sum() and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw \
                and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw
            spelled.append(right)
            sides[0].append(a.astype(np.int64) if right else a[:0].astype(np.int64))
            sides[1].append(b if right else b[:0])

        def side(ids: list, length: np.ndarray) -> Side:
            joined = np.concatenate([np.zeros(0, np.int64), *ids])
            return Side(joined, length[joined], np.array(list(map(len, ids)), np.int64))

        return side(sides[0], self.a_length), side(sides[1], self.b_length)

    def lines(self, a: Side, b: Side, last_a: np.ndarray, last_b: np.ndarray) -> Iterator[str]:
        """Of each document its groups written out."""
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        places = np.empty(len(a.ids) + len(b.ids), np.int64)
        after_a, after_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        after_a[last_a], after_b[last_b] = 1, 1
        places[np.arange(len(a.ids)) + np.repeat(np.cumsum(in_b) - in_b, in_a)] = a.ids + after_a * self.a_size
        places[np.arange(len(b.ids)) + np.repeat(np.cumsum(in_a), in_b)] = b.ids + 2 * self.a_size + after_b * self.b_size
        ends = np.cumsum(a.counts + b.counts).tolist()
        for start, end in zip([0, *ends], ends):
            yield "".join(self.text[places[start:end]].tolist())[:-1]


@lru_cache(maxsize=2)
def tokens_of(left: str, right: str) -> Tokens:
    return Tokens(left, right)


def align(docs: DataFrame, left: str = LEFT, right: str = RIGHT, with_tokens: bool = False) -> DataFrame:
    """One row a document: the numbers of tokens and groups, a digest of the groups, and the pairs of ids that end
    together (a's id times b's size plus b's id) with how often each does. ``with_tokens`` adds both sides' ids
    and how many of them each group has."""
    schema = pa.schema([*ALIGNED, *TOKENS]) if with_tokens else ALIGNED

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(left, right)

        def made(batch):
            for held in heaps(zip(batch.column(0).to_pylist(), strings(batch.column(1)))):
                a, b = tokens([text for _, text in held])
                last_a, last_b = common_ends(a, b)
                groups = np.searchsorted(last_a, a.starts + a.counts) - np.searchsorted(last_a, a.starts)
                cuts = np.r_[0, np.cumsum(groups)].tolist()
                pairs = a.ids[last_a] * tokens.b_size + b.ids[last_b]
                in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
                for k, ((doc_id, _), line) in enumerate(zip(held, tokens.lines(a, b, last_a, last_b))):
                    own = slice(cuts[k], cuts[k + 1])
                    pair, times = np.unique(pairs[own], return_counts=True)
                    digest = hashlib.sha256(line.encode()).hexdigest() if line else ""
                    row = doc_id, int(a.counts[k]), int(b.counts[k]), int(groups[k]), digest, pair.astype(np.int32), times.astype(np.int32)
                    if with_tokens:
                        row += tuple(x.astype(np.int32) for x in (a.ids[a.starts[k] :][: a.counts[k]], b.ids[b.starts[k] :][: b.counts[k]], in_a[own], in_b[own]))
                    yield row

        for batch in rows:
            yield from batches(made(batch), schema, 1024)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    more = ", ".join(f"{name} array<int>" for name, _ in TOKENS)
    return chosen.mapInArrow(run, ALIGNED_SQL + (", " + more if with_tokens else ""))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often each pair ends together in all documents; every task sums its own first."""
    schema = pa.schema([("pair", pa.int32()), ("n", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in rows:
            own, which = np.unique(np.concatenate([pair, batch.column(0).flatten().to_numpy()]), return_inverse=True)
            sums = np.zeros(len(own), np.int64)
            np.add.at(sums, which, np.concatenate([n, batch.column(1).flatten().to_numpy()]))
            pair, n = own, sums
        for at in range(0, len(pair), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(pair[at : at + 65_536]), pa.array(n[at : at + 65_536])], schema=schema)

    return aligned.select("pairs", "times").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored(aligned: DataFrame, counts: DataFrame, right: str = RIGHT) -> DataFrame:
    """What ``align`` found and of each document the sum of its links' counts, and how many of them have the
    highest count that their id of the right side has with any."""
    spark = aligned.sparkSession
    size = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(right)).get_piece_size()
    table = counts.toArrow().sort_by("pair")  # bounded by the vocabularies
    pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    highest = np.zeros(size, np.int64)
    np.maximum.at(highest, pair % size, n)
    sent = spark.sparkContext.broadcast((pair, n, n == highest[pair % size]))
    schema = pa.schema([*ALIGNED][:5] + [("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in rows:
            own, times = (batch.column(k) for k in (5, 6))
            at = np.searchsorted(pair, own.flatten().to_numpy())
            times = times.flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0, np.int64)
            sums = [np.r_[0, np.cumsum(x)] for x in (times * best[at], times * n[at])]
            per = [np.diff(s[np.r_[0, ends]]) for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(x, pa.int64()) for x in per)], schema=schema)

    fixed = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string"
    return aligned.select([f.name for f in ALIGNED]).mapInArrow(run, f"{fixed}, n_best long, count_sum long")


def corpus_alignment(docs: DataFrame, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    """Every document's alignment with the counts of all documents. Each group ends with one pair of tokens that
    end together: there are as many links as groups."""
    aligned = materialize(align(docs, left, right), "alignment")
    return scored(aligned, pair_counts(aligned), right).withColumn("n_links", F.col("n_groups"))
