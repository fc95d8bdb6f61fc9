"""Operator 6: a hierarchical Pitman-Yor language model.

The context of a token is the word before it in its text; a text's first token
follows the end of a text.  Each context is a restaurant of words; all share one
parent restaurant, whose tables draw from a base that gives the training vocabulary
equal shares of 1 - g and unknown words the rest, g being set so that the parent's
new tables meet the share of words seen once.

Seating: a word's customers in a context leave and come back one by one, each to a
table of their word or to a new one, which sends a customer to the parent, where
the word is seated in the same way (beyond ``ONE_BY_ONE`` customers they come in runs
of 1/16 of those seated, and the new tables of a run are Poisson).  Words are dealt
by hash to groups that sweep in parallel; a group knows the other groups' tables of
each of its contexts from the round before and its own as they are.  The first round ends in
the totals; the second repeats the sweeps with them, drops ``BURN_IN`` and averages
the predictive probabilities of ``SAMPLES`` sweeps.

What moves: a scan split (or a fixed part of one) sends its distinct (word, context)
pairs with their counts, packed by groups of words; after the first round a group sends the
customers and tables of its contexts to be summed by context, and gets those of all and of the others; the
second answers a block with a probability a pair and a count a word; both meet the
split's texts again. Words are 56-bit hashes.  A pair in every text is one row a split.

A word with over a quarter of a group's mean share of the pairs is dealt in pieces, by hash of the
context, each at most a quarter of a group.  Its customers and tables are summed over the pieces after
the first round, and each piece knows those of the others as it knows other groups' contexts.  Which words these
are is counted in texts of ``SAMPLE_BYTES``, or 1 / 4,096 of all if that is more, drawn by a hash: it
decides where work is done, and all counts and sums are over all texts.

Defined cases: null text is empty and scored as its end alone; without training
texts every token has probability 1; rows of a null id are in no fold, so they train and
are not held out; repeated rows count each time; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.common import crc_mod, materialize, table
from viewstar.llm.kernel import BLANK_WORDS, hash_spans, hash_words, mix64, pieces, release, text_bytes, words

BURN_IN, SAMPLES = 3, 3
ONE_BY_ONE = 256
GROUP_BYTES = 16 << 20
#: Text in which frequent words are counted, and the most words dealt in pieces (largest first; 4 MB sent to tasks).
SAMPLE_BYTES, SAMPLE_PART, MOST_HOT = 16 << 20, 4096, 1 << 18
THETA = 1.0
_CTX = np.uint64(0xFF)
_END = hash_words(["\n"])[0] & ~_CTX


# ---- tokens ----------------------------------------------------------------

def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and where the texts begin."""
    buf, off = text_bytes(col)
    starts, ends, at = words(buf, off, BLANK_WORDS)
    return np.insert(hash_spans(buf, starts, ends), at[1:], _END) & ~_CTX, at + np.arange(len(at))


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the number of each value among them."""
    d = pa.array(values).dictionary_encode()
    known = d.dictionary.to_numpy()
    order = np.argsort(known)
    rank = np.empty(len(known), np.int32)
    rank[order] = np.arange(len(known), dtype=np.int32)
    return known[order], rank[d.indices.to_numpy()]


# ---- packing ---------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Integers as planes of bytes, so that high zero bytes compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1)


def _steps(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=np.uint64(0))


#: Words in order, then the numbers among them of each pair's word and context, and the pair's count.
Pairs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _pairs(h: np.ndarray, count: np.ndarray) -> Pairs:
    """The pairs of texts' tokens with their counts."""
    known, word = _coded(h)
    # the word before each token; before a text's first token that is an end
    ctx = np.concatenate([np.searchsorted(known, [_END]).astype(np.int32), word[:-1]]) if len(h) else word
    return known, word, ctx, count


def _codes(parts: list[Pairs]) -> tuple[np.ndarray, np.ndarray]:
    """All words in order, and each pair as one number."""
    every = np.unique(np.concatenate([p[0] for p in parts]))
    code = np.empty(sum(len(p[1]) for p in parts), np.int64)
    a = 0
    for known, word, ctx, _ in parts:
        to = np.searchsorted(every, known)
        code[a:a + len(word)] = to[word] * len(every) + to[ctx]
        a += len(word)
    return every, code


def _distinct(parts: list[Pairs]) -> Pairs:
    """The distinct pairs in order of word and context; half the memory of ``_sum_by_pair``."""
    every, code = _codes(parts)
    count = np.concatenate([p[3] for p in parts]).astype(np.int32)
    order = np.argsort(code)
    code, count = code[order], count[order]
    del order
    first = _first_of(code)
    count = np.add.reduceat(count, first) if len(first) else count
    code, size = code[first], max(len(every), 1)
    return every, (code // size).astype(np.int32), (code % size).astype(np.int32), count


def _sum_by_pair(parts: list[Pairs]) -> tuple[Pairs, np.ndarray]:
    """The distinct pairs in order of word and context, and the place of each pair given."""
    every, code = _codes(parts)
    code, back = np.unique(code, return_inverse=True)
    count = np.bincount(back, weights=np.concatenate([p[3] for p in parts]), minlength=len(code)).astype(np.int64)
    size = max(len(every), 1)
    return (every, (code // size).astype(np.int32), (code % size).astype(np.int32), count), back


def _first_of(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def _pack_pairs(word: np.ndarray, ctx: np.ndarray, count: np.ndarray) -> list[bytes]:
    """Each word once with the number of its contexts, then contexts and counts of all."""
    first = _first_of(word)
    return [pack(_steps(word[first])), pack(np.diff(np.concatenate([first, [len(word)]]))), pack(_steps(ctx)), pack(count)]


def _sum(keys: bytes) -> np.ndarray:
    return np.cumsum(unpack(keys), dtype=np.uint64)


_ASKED = "grp long, block long, words binary, sizes binary, contexts binary, counts binary"


class Deal:
    """Which group has a pair: its word's, or for a word in ``hot`` (ascending) that of one of the word's pieces."""

    def __init__(self, bits: int, hot: np.ndarray | None = None, parts: np.ndarray | None = None):
        self.bits = bits
        self.hot = np.empty(0, np.uint64) if hot is None else hot
        self.parts = np.empty(0, np.uint64) if parts is None else parts

    def found(self, known: np.ndarray) -> np.ndarray:
        """The number of each word in ``hot``, or -1."""
        at = np.full(len(known), -1)
        if len(self.hot):
            near = np.minimum(np.searchsorted(self.hot, known), len(self.hot) - 1)
            at[self.hot[near] == known] = near[self.hot[near] == known]
        return at

    def piece(self, at: np.ndarray, part: np.ndarray) -> np.ndarray:
        return _dealt(mix64(self.hot[at] ^ mix64(part.astype(np.uint64) + np.uint64(1))), self.bits)

    def groups(self, every: np.ndarray, word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """The group of each pair of numbers among the words of ``every``."""
        group, at = _dealt(every, self.bits)[word], self.found(every)[word]
        split = np.flatnonzero(at >= 0)
        if len(split):
            group[split] = self.piece(at[split], mix64(every[ctx[split]]) % self.parts[at[split]])
        return group

    def share(self, at: int, group: int) -> float:
        """The share of the pieces of a word of ``hot`` that a group has."""
        parts = np.arange(int(self.parts[at]))
        return float((self.piece(np.full(len(parts), at), parts) == group).mean())


def _asker(deal: Deal):
    """Per block and group: the block's distinct pairs and training counts."""
    def rows(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        every, word, ctx, count = _distinct(parts)
        parts.clear()
        group = deal.groups(every, word, ctx)
        if len(deal.hot):
            order = np.argsort(group, kind="stable")
            group, word, ctx, count = group[order], word[order], ctx[order], count[order]
            del order
        cuts = np.searchsorted(group, np.arange((1 << deal.bits) + 1))
        for g in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[g], cuts[g + 1]
            packed = _pack_pairs(every[word[a:b]], every[ctx[a:b]], count[a:b])
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([block], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]],
                                             ["grp", "block", "words", "sizes", "contexts", "counts"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        now = None
        for batch in batches:
            for piece in pieces(batch, "text"):
                splits = piece.column("split").to_numpy()
                for a, b in _runs(splits):
                    part = piece.slice(a, b - a)
                    if now != splits[a]:
                        for block, parts in held.items():
                            yield from rows(block, parts)
                        held, now = {}, splits[a]
                    blocks = part.column("block").to_numpy()
                    for block in np.unique(blocks).tolist():
                        mine = part.filter(pa.array(blocks == block))
                        h, at = tokens(mine.column("text"))
                        train = np.repeat(mine.column("train").to_numpy(zero_copy_only=False), np.diff(at))
                        parts = held.setdefault(block, [])
                        parts.append(_pairs(h, train))
                        if len(parts) > 8:
                            held[block] = [_distinct(parts)]
            release()
        while held:
            yield from rows(*held.popitem())
            release()
    return ask


def _dealt(h: np.ndarray, bits: int) -> np.ndarray:
    """The group of each hash, ascending with it."""
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cut = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


# ---- seating ---------------------------------------------------------------

def seat(c: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes whose c customers come in turn, with weight ``new`` for a new table."""
    t = np.minimum(c, 1).astype(np.int64)
    who = np.flatnonzero(c > 1)
    for j in range(1, ONE_BY_ONE):
        if len(who) == 0:
            return t
        a = new[who]
        t[who] += rng.random(len(who)) * (a + j - d * t[who]) < a
        who = who[c[who] > j + 1]
    at = np.full(len(who), ONE_BY_ONE, np.int64)
    while len(who):
        a, here = new[who], t[who]
        to = np.minimum(c[who], at + at // 16)
        mean = a * np.log((a + to - d * here) / (a + at - d * here))
        t[who] += np.minimum(rng.poisson(mean), to - at)
        more = to < c[who]
        who, at = who[more], to[more]
    return t


class Group:
    """The words of one group: their seating in all contexts and in the parent.

    ``ctx`` numbers each key's context below ``contexts``; without it the key's low byte does."""

    def __init__(self, keys: np.ndarray, count: np.ndarray, seed: int, d: tuple[float, float], ctx: np.ndarray | None = None, contexts: int = 256):
        self.c, self.contexts = count, contexts
        self.ctx = (keys & _CTX).astype(np.int64) if ctx is None else ctx
        hashed = keys & ~_CTX
        self.word = np.cumsum(np.concatenate([[0], (hashed[1:] != hashed[:-1]).astype(np.int64)])) if len(keys) else np.empty(0, np.int64)
        self.words = int(self.word[-1]) + 1 if len(keys) else 0
        self.of_word = np.bincount(self.word, weights=count, minlength=self.words).astype(np.int64)
        self.rng, self.d = np.random.default_rng(seed), d
        self.t = np.minimum(self.c, 1)
        self.s = np.minimum(self.of_word, 1)
        # of words dealt in pieces: customers of the other pieces, and the part of the word's parent tables that counts here
        self.more, self.part = np.zeros(self.words), np.ones(self.words)

    def own(self) -> np.ndarray:
        return np.bincount(self.word, weights=self.t, minlength=self.words)

    def customers(self) -> np.ndarray:
        return self.own() + self.more

    def totals(self) -> dict[str, np.ndarray | float]:
        by_context = lambda v: np.bincount(self.ctx, weights=v, minlength=self.contexts)
        return {"c": by_context(self.c), "t": by_context(self.t), "s": float((self.s * self.part).sum())}

    def _shared(self, others: dict) -> tuple[np.ndarray, float, float]:
        """Tables by context, the parent's weight of a new table, and the parent's customers;
        ``all`` of others are those of every context, met in this group or not."""
        own = self.totals()
        every = others["all"] if "all" in others else others["t"].sum()
        return others["t"] + own["t"], THETA + self.d[0] * (others["s"] + own["s"]), every + own["t"].sum()

    def parent(self, others: dict, base: tuple[float, float]) -> tuple[np.ndarray, float, np.ndarray]:
        """P(word) in the parent, the parent's weight of a new table, and tables by context."""
        t, new, customers = self._shared(others)
        seen = self.of_word > 0
        p = (np.where(seen, self.customers() - self.d[0] * self.s, 0) + new * np.where(seen, base[0], base[1])) / (THETA + customers)
        return p, new, t

    def sweep(self, others: dict, base: tuple[float, float]) -> None:
        cust = self.customers()
        t, new, customers = self._shared(others)
        rest = cust[self.word] - self.t
        tables = np.minimum(self.s[self.word], rest)
        p = (rest - self.d[0] * tables + new * base[0]) / (THETA + customers)
        self.t = seat(self.c, (THETA + self.d[1] * t[self.ctx]) * p, self.d[1], self.rng)
        self.s = seat(self.customers().astype(np.int64), np.full(self.words, new * base[0]), self.d[0], self.rng)

    def predictive(self, others: dict, base: tuple[float, float], c_all: np.ndarray) -> np.ndarray:
        p, _, t = self.parent(others, base)
        x = self.ctx
        return (self.c - self.d[1] * self.t + (THETA + self.d[1] * t[x]) * p[self.word]) / (THETA + c_all[x])


def _merged(t: pa.Table, d: tuple[float, float], deal: Deal) -> tuple[Group, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The group of the asked rows, its contexts, its words, the places of each row's pairs, and of words in pieces
    their places among the words and in ``deal.hot``."""
    parts = []
    for w, n, x, c in zip(*[t.column(k).to_pylist() for k in ("words", "sizes", "contexts", "counts")]):
        own, ctx = _sum(w), _sum(x)
        known, both = _coded(np.concatenate([own, ctx]))
        parts.append((known, np.repeat(both[:len(own)], unpack(n).astype(np.int64)), both[len(own):], unpack(c).astype(np.int64)))
    sizes = [len(p[1]) for p in parts]
    (every, word, ctx, count), back = _sum_by_pair(parts)
    known, ctx = _coded(ctx)
    grp = int(t.column("grp")[0].as_py())
    g = Group(every[word], count, grp * 2 + 1, d, ctx, len(known))
    names = every[word[_first_of(word)]]
    at = deal.found(names)
    split = np.flatnonzero(at >= 0)
    g.part[split] = [deal.share(i, grp) for i in at[split].tolist()]
    return g, every[known], names, np.split(back, np.cumsum(sizes)[:-1]), split, at[split]


_TOLD = "grp long, bucket long, contexts binary, c binary, t binary, facts array<double>, hot array<struct<word: long, c: long, t: long>>"
_HOT = pa.list_(pa.struct([("word", pa.int64()), ("c", pa.int64()), ("t", pa.int64())]))


def _first_round(deal: Deal):
    """Customers and tables of a group's contexts after its own sweeps, the other groups and pieces taken to be like it:
    a row for each bucket of contexts, the first with the group's facts and those of its words in pieces."""
    bits, groups = deal.bits, 1 << deal.bits

    def fit(t: pa.Table) -> pa.Table:
        g, known, _, _, split, hot = _merged(t, (0.75, 0.75), deal)
        vocabulary = max(1, int((g.of_word > 0).sum()))
        whole = np.ones(g.words, bool)
        whole[split] = False
        for _ in range(BURN_IN):
            g.more = g.own() * (1 / g.part - 1)
            own = g.totals()
            others = {"t": own["t"] * (groups - 1), "s": own["s"] * (groups - 1)}
            g.sweep(others, (0.5 / (vocabulary * groups), 0.5))
        own = g.totals()
        cust = g.own()
        many, few = g.of_word[whole], cust[whole]
        facts = [float(g.of_word.sum()), float((many > 0).sum()), float((many == 1).sum()), float((g.c == 1).sum()), float((g.c == 2).sum()),
                 float((few == 1).sum()), float((few == 2).sum()), own["s"], float(own["t"].sum())]
        told = [{"word": w, "c": c, "t": k} for w, c, k in zip(hot.tolist(), g.of_word[split].tolist(), cust[split].astype(np.int64).tolist())]
        cuts = np.searchsorted(_dealt(known, bits), np.arange(groups + 1))
        buckets = np.flatnonzero(np.diff(cuts))
        cut = lambda v: pa.array([pack(v[cuts[k]:cuts[k + 1]]) for k in buckets], pa.binary())
        return pa.table({"grp": pa.array(np.full(len(buckets), t.column("grp")[0].as_py()), pa.int64()), "bucket": pa.array(buckets, pa.int64()),
                         "contexts": pa.array([pack(_steps(known[cuts[k]:cuts[k + 1]])) for k in buckets], pa.binary()), "c": cut(own["c"]), "t": cut(own["t"]),
                         "facts": pa.array([facts] + [None] * (len(buckets) - 1), pa.list_(pa.float64())), "hot": pa.array([told] + [None] * (len(buckets) - 1), _HOT)})
    return lambda t: _released(fit(t))


def _released(t: pa.Table) -> pa.Table:
    """The result of a task whose other memory goes back to the system."""
    release()
    return t


def _summed(t: pa.Table) -> pa.Table:
    """Per group and bucket: all customers and the other groups' tables of each context, in the order told."""
    told = [_sum(x) for x in t.column("contexts").to_pylist()]
    c, tables = (np.concatenate([unpack(x) for x in t.column(k).to_pylist()]).astype(np.float64) for k in ("c", "t"))
    _, at = np.unique(np.concatenate(told), return_inverse=True)
    every, others = np.bincount(at, weights=c)[at], np.bincount(at, weights=tables)[at] - tables
    cuts = np.cumsum([0, *map(len, told)])
    cut = lambda v: pa.array([pack(v[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
    return pa.table({"grp": t.column("grp"), "bucket": t.column("bucket"), "c": cut(every), "t": cut(others), "facts": t.column("facts"),
                     "hot": t.column("hot")})


class Totals:
    """Sums over all groups: a few counts, and customers and tables of the words in pieces."""

    def __init__(self, facts: np.ndarray, c: np.ndarray | None = None, t: np.ndarray | None = None):
        self.tokens, self.vocabulary, once, c1, c2, u1, u2, self.s, self.t = facts.tolist()
        self.hot_c, self.hot_t = (np.zeros(0, np.int64) if x is None else x for x in (c, t))
        self.vocabulary += int((self.hot_c > 0).sum())
        once, u1, u2 = once + int((self.hot_c == 1).sum()), u1 + int((self.hot_t == 1).sum()), u2 + int((self.hot_t == 2).sum())
        self.d = tuple(min(0.95, max(0.05, a / (a + 2 * b) if a + b else 0.5)) for a, b in ((u1, u2), (c1, c2)))
        # the share of tokens seen once, of the parent's weight of new tables
        new, customers = THETA + self.d[0] * self.s, THETA + self.t
        g = min(0.95, max(1e-6, (once / max(self.tokens, 1)) * customers / new))
        self.base = ((1 - g) / self.vocabulary, g) if self.vocabulary else (0.0, 1.0)


def _second_round(total: Totals, deal: Deal):
    """Per block: mean probability of each pair it asked for and training count of each word."""
    def answer(t: pa.Table, told: pa.Table) -> pa.Table:
        g, known, words_, at, split, hot = _merged(t, total.d, deal)
        told = told.sort_by("bucket")
        c, tables = (np.concatenate([unpack(x) for x in told.column(k).to_pylist()]).astype(np.float64) for k in ("c", "t"))
        if len(c) != len(known):
            raise ValueError(f"a group told {len(c)} contexts and holds {len(known)}: its scan splits changed between two passes")
        # the group's own tables at the end of the first round go, as in ``tables``
        own_s, own_t = next(f for f in told.column("facts").to_pylist() if f)[-2:]
        others = {"t": tables, "s": total.s - own_s, "all": total.t - own_t}
        before = next(x for x in told.column("hot").to_pylist() if x is not None)
        if [x["word"] for x in before] != hot.tolist():
            raise ValueError("a group's words in pieces changed between two passes")
        g.more[split] = total.hot_t[hot] - np.array([x["t"] for x in before], np.int64)
        g.of_word[split] = total.hot_c[hot]
        mean = np.zeros(len(g.c))
        for turn in range(BURN_IN + SAMPLES):
            g.sweep(others, total.base)
            if turn >= BURN_IN:
                mean += g.predictive(others, total.base, c)
        logs = np.log10(np.minimum(mean / SAMPLES, 1.0)).astype("<f4")
        asked = [np.searchsorted(words_, _sum(w)) for w in t.column("words").to_pylist()]
        return pa.table({"block": t.column("block"), "grp": t.column("grp"),
                         "logs": pa.array([logs[i].tobytes() for i in at], pa.binary()), "counts": pa.array([pack(g.of_word[i]) for i in asked], pa.binary())})
    return lambda t, told: _released(answer(t, told))


# ---- scoring ---------------------------------------------------------------

def _scorer(total: Totals, deal: Deal):
    n, scale = int(total.tokens), total.tokens + total.vocabulary + 1

    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        order = np.argsort(replies.column("grp").to_numpy())
        logs, counts = replies.column("logs").to_pylist(), replies.column("counts").to_pylist()
        lp = np.concatenate([np.empty(0, "<f4"), *[np.frombuffer(logs[i], "<f4") for i in order]]).astype(np.float64)
        c = np.concatenate([np.empty(0, np.uint64), *[unpack(counts[i]) for i in order]]).astype(np.int64)
        ids, held, sizes, known, base, own = [], [], [], [], [], []
        parts, every = [], []
        for batch in docs.to_batches():
            for piece in pieces(batch, "text"):
                h, at = tokens(piece.column("text"))
                parts.append((piece.select(["doc_id", "held_out"]), at))
                every.append(_pairs(h, np.zeros(len(h), bool)))
        (names, word, ctx, _), place = _sum_by_pair(every) if every else ((np.empty(0, np.uint64), *(np.empty(0, np.int32),) * 3), None)
        # the replies follow groups, then words and contexts
        group = deal.groups(names, word, ctx)
        told = np.argsort(group, kind="stable")
        first = _first_of(group[told] * max(len(names), 1) + word[told])
        if len(word) != len(lp) or len(first) != len(c):
            raise ValueError(f"a block asked for {len(lp)} pairs and holds {len(word)}: its scan split changed between two passes")
        back = np.empty(len(told), np.int64)
        back[told] = np.arange(len(told))
        lp, c = lp[back], np.repeat(c, np.diff(np.concatenate([first, [len(word)]])))[back]
        plain = np.log10((c + 1) / scale)
        begin = np.cumsum([0, *[len(p[1]) for p in every]])
        for k, (piece, at) in enumerate(parts):
            slot = place[begin[k]:begin[k + 1]]
            ids.append(piece.column("doc_id"))
            held.append(piece.column("held_out"))
            sizes.append(np.diff(at))
            for out, v in ((known, (c > 0).astype(np.int64)), (base, plain), (own, lp)):
                out.append(np.add.reduceat(v[slot], at[:-1]) if len(slot) else np.empty(0, v.dtype))
        cat = lambda xs, kind: pa.array(np.concatenate(xs).astype(kind)) if xs else pa.array([], pa.from_numpy_dtype(kind))
        return pa.table({"doc_id": pa.chunked_array(ids, pa.int64()), "held_out": pa.chunked_array(held, pa.bool_()), "n_tokens": cat(sizes, np.int64), "n_known": cat(known, np.int64),
                         "train_tokens": pa.array(np.full(sum(map(len, sizes)), n, np.int64)), "base_score": cat(base, np.float64), "score": cat(own, np.float64)})
    return lambda docs, replies: _released(score(docs, replies))


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each piece of the texts."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            h = tokens(piece.column("text"))[0]
            every, word, ctx, _ = _distinct([_pairs(h, np.zeros(len(h), bool))])
            yield pa.RecordBatch.from_arrays([pa.array(every[x].view(np.int64)) for x in (word, ctx)], ["word", "ctx"])
        release()


def _deal(rows: DataFrame, size: int, bits: int) -> Deal:
    """The groups, words of large shares of the pairs in pieces."""
    if not bits:
        return Deal(bits)
    part = max(SAMPLE_BYTES / size, 1 / SAMPLE_PART)
    some = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 20)) < part * (1 << 20))
    pairs = some.select("text").mapInArrow(_pair_rows, "word long, ctx long").distinct().groupBy("word").agg(F.count("*").alias("n"))
    pairs = materialize(pairs, "pairs")
    mean = (pairs.agg(F.sum("n")).first()[0] or 0) / (1 << bits)
    # at most four words a group reach this, and MOST_HOT in all
    hot = pairs.where(F.col("n") * 4 > F.lit(mean)).orderBy(F.desc("n"), "word").limit(MOST_HOT).collect()
    known = sorted((r.word & 0xFFFFFFFFFFFFFFFF, math.ceil(4 * r.n / mean)) for r in hot)
    return Deal(bits, np.array([w for w, _ in known], np.uint64), np.array([k for _, k in known], np.uint64))


def language_model_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row;
    ``held_out`` is a boolean column of ``docs``."""
    spark = docs.sparkSession
    if not docs.inputFiles():  # blocks are named by scan splits
        docs = materialize(docs, "documents")
    parts = max(1, math.ceil(_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) / GROUP_BYTES))
    split = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), split.alias("split"))
    rows = rows.withColumn("train", ~F.col("held_out")).withColumn("block", F.xxhash64("split", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / GROUP_BYTES))))
    deal = _deal(rows, size, bits)
    asked = rows.select("text", "train", "split", "block").mapInArrow(_asker(deal), _ASKED)
    first = asked.groupBy("grp").applyInArrow(_first_round(deal), _TOLD)
    told = materialize(first.groupBy("bucket").applyInArrow(lambda t: _released(_summed(t)), _TOLD.replace("contexts binary, ", "")), "totals")
    # summed by Spark: a few counts
    both = told.select(F.posexplode("facts")).groupBy("pos").agg(F.sum("col").alias("v")).collect()
    flat = np.zeros(9)
    for p, v in both:
        flat[p] = v
    hot = told.select(F.explode("hot").alias("h")).groupBy("h.word").agg(F.sum("h.c").alias("c"), F.sum("h.t").alias("t")).collect() if len(deal.hot) else []
    hot_c, hot_t = np.zeros((2, len(deal.hot)), np.int64)
    for r in hot:
        hot_c[r.word], hot_t[r.word] = r.c, r.t
    total = Totals(flat, hot_c, hot_t)
    replies = asked.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(_second_round(total, deal), "block long, grp long, logs binary, counts binary")
    return rows.select("doc_id", "text", "held_out", "block").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _scorer(total, deal), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _bytes(setting: str) -> int:
    """A size setting of Spark in bytes."""
    setting = setting.strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(setting[-1:], 0)
    return int(setting[:-1] if unit else setting) << unit


def op6(spark, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
