"""Token counts by a compiled finite-state transducer.

A word's BPE tokens can be counted while its symbols are read: a state holds,
for each place where a token may have begun that is still growing, the node of
the vocabulary's trie, the last token before that place and the count there,
relative to the count here. Reading a symbol moves to the next state and emits
by how much the count changed. States are finite in number and made when first
reached; a bounded number of states and of whole words are remembered.

White space always ends a word, so a chunk of text is a map from what stands
before it to a count: the fragment up to its first white space, the count of
what lies between, the fragment after its last. Such maps compose
associatively; a long text is cut into chunks, whose maps are composed in a
balanced tree, the scan's up-sweep.

Defined results: a null or empty text has 0 bytes and 0 tokens. The
tokenizer's own special strings inside a text count as one token each, as its
library counts them. Repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import Memo, batches, strings
from pathcredit.llm.packing import byte_symbols

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
CHUNK = 1 << 18  # characters of a chunk
COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
COUNTED_SQL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Transducer:
    """Counts the tokens of one word, given as symbols of which the last carries the word-end mark."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str, most: int = 150_000):
        self.order = {pair: k for k, pair in enumerate(merges)}
        self.end, self.most = end, most
        self.symbols: dict[int, tuple[str, ...]] = {}
        self.trie: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, at in vocabulary.items():
            marked = token.endswith(end) and len(token) > len(end)
            body = token[: -len(end)] if marked else token
            parts = (*body[:-1], body[-1] + end) if marked else tuple(body)
            self.symbols[at] = parts
            node = 0
            for s in parts:
                if s not in self.trie[node]:
                    self.trie[node][s] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = self.trie[node][s]
            self.ends[node] = at
        self.token = vocabulary
        self._fit: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, parts: tuple[str, ...]) -> list[str]:
        """Tokens by the definition: again and again the leftmost pair that comes first among the merges is joined."""
        out = list(parts)
        while len(out) > 1:
            k, at = min((self.order.get((out[i], out[i + 1]), 1 << 60), i) for i in range(len(out) - 1))
            if k == 1 << 60:
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def fits(self, before: int, last: int) -> bool:
        key = before, last
        known = self._fit.get(key)
        if known is None:
            if len(self._fit) >= 1_000_000:
                self._fit.clear()
            joined = self.merge(self.symbols.get(before, ()) + self.symbols[last])
            known = self._fit[key] = [self.token.get(t) for t in joined] == ([last] if before < 0 else [before, last])
        return known

    def move(self, state: int, symbol: str) -> tuple[int, int]:
        """Next state and change of the count, for a transition not yet compiled."""
        grown, found = [], None
        for node, before, count in self.states[state]:
            child = self.trie[node].get(symbol)
            if child is None:
                continue
            if found is None and self.ends[child] >= 0 and self.fits(before, self.ends[child]):
                found = self.ends[child], count + 1
            if self.trie[child]:
                grown.append((child, before, count))
        if found is None:
            raise ValueError(f"no token ends in {symbol!r}")
        last, change = found
        following = (*((node, before, count - change) for node, before, count in grown), (0, last, 0))
        at = self.number.get(following)
        if at is None:
            at = self.number[following] = len(self.states)
            self.states.append(following)
            self.moves.append({})
        self.moves[state][symbol] = at, change
        return at, change

    def count(self, symbols: str) -> int:
        """Tokens of a word of at least one symbol."""
        if len(self.states) > self.most:
            self.forget()
        state, total, moves = 0, 0, self.moves
        for s in symbols[:-1]:
            state, change = moves[state].get(s) or self.move(state, s)
            total += change
        last = symbols[-1] + self.end
        return total + (moves[state].get(last) or self.move(state, last))[1]


class Counter:
    """Counts of texts, as a map that chunks of a text compose to: (head, count, tail), or (text,) without white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model["end_of_word_suffix"])
        self.specials = [t["content"] for t in told["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        split = next(x for x in told["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.byte = {b: c for c, b in byte_symbols().items()}
        self.memo = Memo(self.of_word, most=500_000)

    def of_word(self, word: str) -> int:
        return self.transducer.count("".join(map(self.byte.__getitem__, word.encode())))

    def plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-casing looks at single characters
        return sum(map(self.memo.__getitem__, self.words(text.lower())))

    def count(self, text: str) -> int:
        """Tokens of a text that begins and ends where words may."""
        if not any(s in text for s in self.specials):
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))

    def of_chunk(self, chunk: str) -> tuple:
        first, last = min((i for i in (chunk.find(" "), chunk.find("\n")) if i >= 0), default=-1), max(chunk.rfind(" "), chunk.rfind("\n"))
        return (chunk,) if first < 0 else (chunk[:first], self.count(chunk[first:last]), chunk[last:])

    def compose(self, a: tuple, b: tuple) -> tuple:
        if len(a) == 1 and len(b) == 1:
            return (a[0] + b[0],)
        if len(a) == 1:
            return a[0] + b[0], b[1], b[2]
        if len(b) == 1:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def of_text(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk:
            return self.count(text)
        maps = [self.of_chunk(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        whole = maps[0]
        return self.count(whole[0]) if len(whole) == 1 else self.count(whole[0]) + whole[1] + self.count(whole[2])


@lru_cache(maxsize=2)
def counter(name: str) -> Counter:
    return Counter(public_tokenizers.path(name))


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it exceeds the limit."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)

        def made(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                n = own.of_text(text)
                yield doc_id, len(text.encode()), n, n > limit

        for batch in rows:
            yield from batches(made(batch), COUNTED)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, COUNTED_SQL)
