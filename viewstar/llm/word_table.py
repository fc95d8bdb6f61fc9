"""What a tokenizer makes of each word, remembered in arrays.

Words are known by two independent 64-bit hashes of their bytes, looked up for a
whole piece of text at once in an open-addressed table; only words not in it are
handed to the tokenizer.  A word costs some 50 bytes.  When ``limit`` words are
held, those used longest ago go, half of all, so a worker that lives through many
tasks keeps the frequent ones.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from viewstar.llm.kernel import U64, hash_spans


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions starts[i], ..., starts[i] + lens[i] - 1 of all i in turn."""
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(int(lens.sum()), dtype=np.int64)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a) // 2), a.dtype)])


def two_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hash_spans(buf, starts, ends), hash_spans(buf, starts, ends, 1)


class WordTable:
    def __init__(self, tokenize: Callable[[list[str]], list[list[int]]], limit: int = 600_000):
        self.tokenize, self.limit = tokenize, limit
        self.bits = int(limit - 1).bit_length() + 1
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.n = self.used = self.now = 0
        first = 1 << 12
        self.h1, self.h2 = np.zeros(first, U64), np.zeros(first, U64)
        self.start, self.size, self.last = np.zeros(first, np.int32), np.zeros(first, np.int32), np.zeros(first, np.int32)
        self.flat = np.zeros(first, np.uint16)

    def _probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The numbers of the words, -1 for those not held."""
        out = np.full(len(h1), -1, np.int64)
        at = (h1 >> U64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(h1))
        while open_.size:
            held = self.slots[at]
            some = held >= 0
            open_, at, held = open_[some], at[some], held[some]
            hit = (self.h1[held] == h1[open_]) & (self.h2[held] == h2[open_])
            out[open_[hit]] = held[hit]
            open_, at = open_[~hit], (at[~hit] + 1) & (len(self.slots) - 1)
        return out

    def _place(self, numbers: np.ndarray) -> None:
        """Enter words into the slots; of several that want one slot the first gets it."""
        at = (self.h1[numbers] >> U64(64 - self.bits)).astype(np.int64)
        while numbers.size:
            free = self.slots[at] < 0
            self.slots[at[free][::-1]] = numbers[free][::-1]
            left = self.slots[at] != numbers
            numbers, at = numbers[left], (at[left] + 1) & (len(self.slots) - 1)

    def _age(self) -> None:
        """Keep the half used last."""
        keep = np.sort(np.argpartition(-self.last[:self.n], self.limit // 2)[:self.limit // 2])
        size = self.size[keep]
        ids = self.flat[spread(self.start[keep].astype(np.int64), size.astype(np.int64))]
        self.n, self.used = len(keep), len(ids)
        for a in (self.h1, self.h2, self.size, self.last):
            a[:self.n] = a[keep]
        self.start[:self.n] = np.cumsum(size) - size
        self.flat[:self.used] = ids
        self.slots[:] = -1
        self._place(np.arange(self.n))

    def _learn(self, h1: np.ndarray, h2: np.ndarray, words: list[str]) -> None:
        found = self.tokenize(words)
        k, n = len(words), self.n
        size = np.fromiter(map(len, found), np.int64, k)
        more = int(size.sum())
        self.h1, self.h2, self.start, self.size, self.last = (_room(a, n + k) for a in (self.h1, self.h2, self.start, self.size, self.last))
        self.flat = _room(self.flat, self.used + more)
        self.h1[n:n + k], self.h2[n:n + k], self.size[n:n + k] = h1, h2, size
        self.start[n:n + k] = self.used + np.cumsum(size) - size
        self.flat[self.used:self.used + more] = np.fromiter(chain.from_iterable(found), np.uint16, more)
        self.n, self.used = n + k, self.used + more
        self._place(np.arange(n, n + k))

    @staticmethod
    def _missing(out: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words not held, and one place of each different one."""
        new = np.flatnonzero(out < 0)
        new = new[np.lexsort((h2[new], h1[new]))]
        first = np.ones(len(new), bool)
        first[1:] = (h1[new[1:]] != h1[new[:-1]]) | (h2[new[1:]] != h2[new[:-1]])
        return new, new[first]

    def lookup(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """The numbers of the words at these spans of bytes, good until the next call."""
        self.now += 1
        h1, h2 = hashes or two_hashes(buf, starts, ends)
        out = self._probe(h1, h2)
        new, first = self._missing(out, h1, h2)
        if new.size:
            if self.n + len(first) > self.limit and self.n > self.limit // 2:
                self._age()
                out = self._probe(h1, h2)
                new, first = self._missing(out, h1, h2)
            while (self.n + len(first)) * 4 > len(self.slots) * 3:  # a piece of more different words than the limit
                self.bits += 1
                self.slots = np.full(1 << self.bits, -1, np.int32)
                self._place(np.arange(self.n))
            raw = buf.data
            self._learn(h1[first], h2[first], [str(raw[a:b], "utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            out[new] = self._probe(h1[new], h2[new])
        self.last[out] = self.now
        return out

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of the words in turn, and how many each has."""
        size = self.size[numbers].astype(np.int64)
        return self.flat[spread(self.start[numbers].astype(np.int64), size)], size
