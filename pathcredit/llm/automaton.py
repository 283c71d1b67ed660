"""Prefix tables of many short sequences at once, over a vocabulary's automaton.

Shared by the encoders of this subpackage: the automaton tells which tokens
end at a position, a test of pairs tells which of them may follow the token
before it, and sequences are taken side by side, one symbol of each a step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np


class Automaton:
    """Which tokens end where. States are prefixes of tokens; ``longest[state]`` is the longest token that ends
    there and ``shorter[token]`` the next one that ends where that token does (-1: none)."""

    def __init__(self, tokens: Iterable[tuple[Iterable[int], int]], symbols: int, size: int):
        self.symbols = symbols
        self.tree: dict[int, int] = {}
        own: dict[int, int] = {}
        states = 1
        for word, token in tokens:
            state = 0
            for c in word:
                after = self.tree.setdefault(state * symbols + c, states)
                states += after == states
                state = after
            own[state] = token
        below: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for key, after in self.tree.items():
            below[key // symbols].append((key % symbols, after))
        self.fail = [0] * states
        self.longest = np.full(states, -1, np.int32)
        self.shorter = np.full(size, -1, np.int32)
        todo = deque([0])
        while todo:
            state = todo.popleft()
            for c, after in below[state]:
                back = self.fail[after] = self.step(self.fail[state], c) if state else 0
                token = own.get(after)
                if token is None:
                    self.longest[after] = self.longest[back]
                else:
                    self.longest[after] = token
                    self.shorter[token] = self.longest[back]
                todo.append(after)

    def step(self, state: int, c: int) -> int:
        """The state after ``state`` and the symbol ``c``."""
        while True:
            after = self.tree.get(state * self.symbols + c)
            if after is not None:
                return after
            if not state:
                return 0
            state = self.fail[state]

    def steps(self, keys: np.ndarray) -> np.ndarray:
        return np.array([self.step(*divmod(k, self.symbols)) for k in keys.tolist()], np.int32)


class Recent:
    """Values of whole-number keys, remembered until another key needs the place: bounded memory."""

    def __init__(self, make: Callable[[np.ndarray], np.ndarray], bits: int = 20):
        self.make, self.shift = make, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys)
        out = self.values[at]
        missing = np.flatnonzero(self.keys[at] != keys)
        if len(missing):
            wanted, which = np.unique(keys[missing], return_inverse=True)
            made = self.make(wanted)
            out[missing] = made[which]
            at, first = np.unique(self.place(wanted), return_index=True)
            self.keys[at], self.values[at] = wanted[first], made[first]
        return out


class Tables:
    """Prefix tables side by side. ``fits(before, token)`` is the test of pairs; ``none`` stands for nothing
    before, and for a symbol that no token holds."""

    def __init__(self, automaton: Automaton, length: list[int], fits: Callable[[int, int], bool], none: int,
                 lanes: int = 16_384, widest: int = 64):
        self.automaton, self.fits, self.none, self.lanes, self.widest = automaton, fits, none, lanes, widest
        self.length = np.array([*length, 1], np.int32)  # the last for ``none``
        self.size = none + 1
        self.step = Recent(automaton.steps)
        self.fit = Recent(lambda keys: np.array([fits(*divmod(k, self.size)) for k in keys.tolist()], np.int32), 21)

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every sequence (one behind the other) and their number; ``none`` where no token is.
        Sequences of over ``widest`` symbols are taken one by one."""
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        counts = np.zeros(len(lengths), np.int64)
        alone = int(np.searchsorted(-lengths[order], -self.widest, "left"))
        long = {i: self.one(symbols[starts[i] : starts[i] + lengths[i]].tolist()) for i in order[:alone].tolist()}
        for i, tokens in long.items():
            counts[i] = len(tokens)
        found = []
        for a in range(alone, len(order), self.lanes):
            own = order[a : a + self.lanes]
            tokens, counts[own] = self._side_by_side(symbols, starts[own], lengths[own])
            found.append((own, tokens))
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.int32)
        for own, (lane, back, token) in found:
            out[ends[own][lane] - 1 - back] = token
        for i, tokens in long.items():
            out[ends[i] - len(tokens) : ends[i]] = tokens
        return out, counts

    def last(self, symbols: list[int]) -> list[int]:
        """The prefix table of one sequence: the last token of each prefix, from the empty one on."""
        table, state, known = [self.none], 0, {}
        step, fits, longest, shorter, length = self.automaton.step, self.fits, self.automaton.longest, self.automaton.shorter, self.length
        for end, c in enumerate(symbols, 1):
            state = step(state, c)
            token = known.get(state)
            if token is None:
                token = known[state] = int(longest[state])
            while token >= 0 and not fits(table[end - length[token]], token):
                token = int(shorter[token])
            table.append(token if token >= 0 else self.none)
        return table

    def one(self, symbols: list[int]) -> list[int]:
        """Tokens of one sequence."""
        table, out, end = self.last(symbols), [], len(symbols)
        while end:
            out.append(table[end])
            end -= int(self.length[table[end]])
        return out[::-1]

    def _side_by_side(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        most = int(lengths[0]) if len(lengths) else 0  # lengths fall
        last = np.full((most + 1, len(lengths)), self.none, np.int32)
        state = np.zeros(len(lengths), np.int64)
        shorter, length, size = self.automaton.shorter, self.length, self.size
        for at in range(most):
            n = int(np.searchsorted(-lengths, -at, "left"))  # the sequences longer than ``at``
            state = self.step(state[:n] * self.automaton.symbols + symbols[starts[:n] + at]).astype(np.int64)
            lane = np.arange(n)
            token = self.automaton.longest[state]
            while True:
                some = token >= 0
                if not some.all():
                    lane, token = lane[some], token[some]
                if not len(lane):
                    break
                before = last[at + 1 - length[token], lane].astype(np.int64)
                fit = self.fit(before * size + token) > 0
                last[at + 1, lane[fit]] = token[fit]
                lane, token = lane[~fit], shorter[token[~fit]]
        lane, end = np.arange(len(lengths)), lengths.astype(np.int64)
        counts, found = np.zeros(len(lengths), np.int64), []
        while True:
            some = end > 0
            if not some.all():
                lane, end = lane[some], end[some]
            if not len(lane):
                break
            token = last[end, lane]
            found.append((lane, counts[lane], token))
            counts[lane] += 1
            end = end - length[token]
        parts = zip(*found) if found else [[np.zeros(0, np.int64)]] * 3
        return tuple(np.concatenate(list(p)) for p in parts), counts


class Known:
    """Ids of texts cut into parts: the parts not met before are encoded together, at most ``most`` remembered."""

    def __init__(self, encode: Callable[[list], list[tuple[int, ...]]], most: int = 300_000):
        self.encode, self.most, self.held = encode, most, {}

    def __call__(self, cut: list[list]) -> Iterator[list[int]]:
        new = list(set(chain.from_iterable(cut)).difference(self.held))
        if len(self.held) + len(new) > self.most:
            self.held = {}
            new = list(set(chain.from_iterable(cut)))
        self.held.update(zip(new, self.encode(new)))
        for parts in cut:
            yield list(chain.from_iterable(map(self.held.__getitem__, parts)))


def heaps(rows: Iterable[tuple], most: int = 1_000_000) -> Iterator[list[tuple]]:
    """Rows (id, text) in lists of about ``most`` characters, a longer text by itself."""
    held, n = [], 0
    for row in rows:
        if held and n + len(row[1]) > most:
            yield held
            held, n = [], 0
        held.append(row)
        n += len(row[1])
    if held:
        yield held
