"""Operator 10: toxicity of texts behind obfuscated spelling.

Noisy channel: a word that holds a look-alike, mixes letters with other characters, repeats a
letter, or is spelled out in single letters or look-alikes is read as a lattice, with the look-alikes
at its ends and, where these are symbols, also without. At each character it may stand for itself, for a letter it resembles, for a repeat of
the letter before, or for nothing.  A Viterbi search over the lattice takes the
likeliest reading under a letter trigram model, which is counted over all texts.

Scoring: rules on the restored text (a word, or the 4 to 6 bytes that a word begins
with) are learned from labelled texts, at most ``FIT_ROWS`` of them drawn by a hash
of the id.  Candidates are those in at least ``FEW`` of the toxic texts with a precision of
``PRECISION``.  Rules that chance can't explain are all learned: those in as many independent toxic texts (near
copies, told by ``BANDS`` bands of MinHash values of their 5-word shingles, count once) as make one false rule
among all keys of the toxic texts a matter of 1 %.  Of the others in at least ``SUPPORT`` of the toxic texts the one that
explains most toxic texts not yet explained is taken, until none explains
as many as ``GAIN`` of them, so that words which merely stand in copies of a toxic text are not learned.  The score of a text is
1 - product of (1 - precision) over the rules it meets; without any, the share of
toxic texts among those that no rule explains.

Defined cases: null, empty or letterless text meets no rule; without labels every
score is 0.5 and predicted 0; several labels of one id count as toxic if one is;
null labels and null ids teach nothing (a null id is in no fold); repeated rows
keep their rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.common import crc_mod, materialize, table
from viewstar.llm.kernel import BLANK_WORDS, hash_spans, mix64, pieces, text_bytes, text_shingles, words

FIT_ROWS = 40_000
FEW = 3
SUPPORT = 0.01
BANDS, IN_BAND = 8, 4
PRECISION = 0.95
GAIN = 0.004
PREFIXES = (4, 5, 6)
#: Bytes of text that a task reads at once.
PIECE = 2 << 20

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Classes of the letter model: 0 the edge of a word, 1-26 a-z, 27 any byte beyond ASCII.
_CLASS = np.zeros(256, np.int64)
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = 27
N_CLASS = 28
# Letters that a character may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
ALIKE_BYTES = np.zeros(256, bool)
ALIKE_BYTES[[ord(ch) for ch in LOOKS_LIKE if ord(ch) < 0x80]] = True
WIDE_ALIKE = [ch.encode() for ch in LOOKS_LIKE if ord(ch) >= 0x80]
# Log-probabilities of the channel: a character read as itself, as a look-alike, as nothing, as a repeat.
SAME, ALIKE, NOTHING, REPEAT, APART = 0.0, math.log(0.3), math.log(0.02), math.log(0.2), math.log(0.05)


# ---- letter model ----------------------------------------------------------

def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter trigrams, edges included, of a task's texts."""
    sums = np.zeros(N_CLASS ** 3, np.int64)
    for batch in batches:
        for piece in pieces(batch, "text"):
            buf, _ = text_bytes(piece.column("text"))
            word = LETTERS[buf]
            c = _CLASS[buf]
            if len(c) < 3:
                continue
            # a trigram ends at a letter or at the edge after one; what lies before a word's first letter is edge
            end = word[2:] | word[1:-1]
            a = np.where(word[1:-1], c[:-2], 0)
            sums += np.bincount(((a * N_CLASS + c[1:-1]) * N_CLASS + c[2:])[end], minlength=N_CLASS ** 3)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["gram", "n"])


def letter_model(texts: DataFrame) -> np.ndarray:
    """log P(c | a, b) over all texts, as an array of 28 x 28 x 28."""
    rows = texts.select("text").mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect()  # at most 28 ** 3
    n = np.zeros(N_CLASS ** 3)
    for g, k in rows:
        n[g] = k
    n = n.reshape(N_CLASS, N_CLASS, N_CLASS)
    two = n.sum(axis=0) + 0.1
    two /= two.sum(axis=1, keepdims=True)
    return np.log((n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5))


def decode(token: str, model: np.ndarray | list) -> str:
    """The likeliest reading of an obfuscated token (lower case; blanks may be boundaries or nothing)."""
    lp = model.tolist() if isinstance(model, np.ndarray) else model

    def kind(ch: str) -> int:
        return ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0

    # state: the last two classes and the last letter -> score and reading (its last letter and the reading before)
    states: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
    for ch in token:
        after: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}
        itself = ch.isalpha()
        letters = [(x, kind(x), cost) for x, cost in ([(ch, SAME)] if itself else []) + [(x, ALIKE) for x in LOOKS_LIKE.get(ch, "")]]
        nothing, apart = (math.log(0.5), math.log(0.5)) if ch == " " else (NOTHING, APART)
        for (a, b, last), (score, text) in states.items():
            for x, k, cost in letters:
                value = score + cost + lp[a][b][k]
                state = (b, k, x)
                if state not in after or after[state][0] < value:
                    after[state] = value, (x, text)
                if x == last:
                    state, value = (a, b, last), score + REPEAT
                    if state not in after or after[state][0] < value:
                        after[state] = value, text
            if not itself:
                state, value = (a, b, last), score + nothing
                if state not in after or after[state][0] < value:
                    after[state] = value, text
                if b:
                    state, value = (0, 0, ""), score + lp[a][b][0] + apart
                    if state not in after or after[state][0] < value:
                        after[state] = value, (" ", text)
        states = after

    def read(text: tuple | None) -> str:
        out = []
        while text:
            out.append(text[0])
            text = text[1]
        return "".join(reversed(out))
    ends = [(score + (lp[a][b][0] if b else 0.0), text) for (a, b, _), (score, text) in states.items()]
    top = max(x[0] for x in ends)
    return max(read(text) for score, text in ends if score == top)


# ---- words of a text -------------------------------------------------------

def _suspects(buf: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans (text, start, end) that need the lattice."""
    if len(starts) == 0:
        return []
    n = int(off[-1])
    byte = buf[:n]
    letter, alike = LETTERS[byte], ALIKE_BYTES[byte]
    digit = (byte >= 0x30) & (byte <= 0x39)
    core = letter | alike

    def ends_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end of the marked bytes in each token, and how many there are (0: the token itself)."""
        spots = np.flatnonzero(mask)
        i, j = np.searchsorted(spots, starts), np.searchsorted(spots, ends)
        some = j > i
        first, last = starts.copy(), ends.copy()
        first[some], last[some] = spots[i[some]], spots[j[some] - 1] + 1
        return first, last, j - i

    def tokens_of(spots: np.ndarray) -> np.ndarray:
        k = np.searchsorted(starts, spots, "right") - 1
        out = np.zeros(len(starts), bool)
        out[k[k >= 0]] = True
        return out
    first, last, size = ends_of(core)
    chars = ends_of(core & ((byte & 0xC0) != 0x80))[2]
    odd = tokens_of(np.flatnonzero(alike)) | (last - first > size)
    for sign in WIDE_ALIKE:
        hit = np.ones(max(n - len(sign) + 1, 0), bool)
        for k, x in enumerate(sign):
            hit &= byte[k:n - len(sign) + 1 + k] == x
        odd |= tokens_of(np.flatnonzero(hit))
    for width in (1, 2, 3, 4):  # a character that is that of before
        if n < 2 * width:
            continue
        lead = byte[width:n - width + 1]
        low, high = ((0x61, 0x7B), (0xC2, 0xE0), (0xE0, 0xF0), (0xF0, 0xF8))[width - 1]
        same = (lead >= low) & (lead < high)
        for k in range(width):
            same &= byte[width + k:n - width + 1 + k] == byte[k:n - 2 * width + 1 + k]
        odd |= tokens_of(np.flatnonzero(same) + width)
    odd &= chars >= 2
    # with the symbols at the ends and without, they may be punctuation; so may the digits after the last letter
    inner, outer, _ = ends_of(letter | digit)
    plain, final, _ = ends_of(letter)
    plain = np.where(plain - starts == 1, starts, plain)
    spans = np.concatenate([(a * (n + 1) + b)[odd & (b > a)] for a, b in ((first, last), (first, outer), (inner, last), (inner, outer), (plain, final))])
    spans = np.unique(spans)
    a, b = spans // (n + 1), spans % (n + 1)
    text = np.searchsorted(at, np.arange(len(starts)), "right") - 1
    out = list(zip(text[np.searchsorted(starts, a, "right") - 1].tolist(), a.tolist(), b.tolist()))
    single = chars == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        for t in range(int(text[a]), int(text[b - 1]) + 1):  # a run ends with its text
            lo, hi = max(a, int(at[t])), min(b, int(at[t + 1]))
            if hi - lo >= 3:
                out.append((t, int(first[lo]), int(last[hi - 1])))
    return out


def _keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of keys: of the whole word, then of each prefix (0 where the word is shorter)."""
    out = [hash_spans(buf, starts, ends) | np.uint64(1)]
    for k in PREFIXES:
        whole = np.flatnonzero(ends - starts >= k)
        key = np.zeros(len(starts), np.uint64)
        key[whole] = mix64(hash_spans(buf, starts[whole], starts[whole] + k) ^ np.uint64(k)) | np.uint64(1)
        out.append(key)
    return np.stack(out)


class Reader:
    """Keys of the restored words of a piece of texts; remembers readings."""

    def __init__(self, model: np.ndarray):
        self.model, self.memo = model.tolist(), {}

    def restored(self, token: str) -> str:
        if token not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[token] = decode(token, self.model)
        return self.memo[token]

    def keys(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Keys (a row a kind) and the text of each column of them."""
        buf, off = text_bytes(col)
        starts, ends, at = words(buf, off, BLANK_WORDS)
        texts, found = [], []
        for t, a, b in _suspects(buf, off, starts, ends, at):
            for w in self.restored(buf[a:b].tobytes().decode("utf-8", "ignore")).split(" "):
                if w:
                    texts.append(t)
                    found.append(w)
        s, e, at = words(buf, off, LETTERS)
        keys = _keys(buf, s, e)
        text = np.searchsorted(at, np.arange(len(s)), "right") - 1
        if found:
            more, moff = text_bytes(pa.array(found, pa.string()))
            keys = np.concatenate([keys, _keys(more, moff[:-1], moff[1:])], axis=1)
            text = np.concatenate([text, np.array(texts)])
        return keys, text


# ---- rules -----------------------------------------------------------------

def _in_texts(reader: Reader, piece: pa.RecordBatch, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a text of the piece and a wanted key (by its place) in it."""
    keys, text = reader.keys(piece.column("text"))
    texts, places = [], []
    for row in keys:  # one kind of key at a time
        slot = np.minimum(np.searchsorted(wanted, row), len(wanted) - 1)
        hit = wanted[slot] == row
        texts.append(text[hit])
        places.append(slot[hit])
    pair = np.unique(np.concatenate(texts) * len(wanted) + np.concatenate(places))
    return pair // len(wanted), pair % len(wanted)


def _toxic_counter(model: np.ndarray):
    """Per task: in how many (toxic) texts each key is."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        known, sums = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                keys, text = reader.keys(piece.column("text"))
                found = [np.unique(keys[:, a:b]) for a, b in _runs(text)]
                known, back = np.unique(np.concatenate([known, *found]), return_inverse=True)
                sums = np.bincount(back, weights=np.concatenate([sums, *[np.ones(len(f), np.int64) for f in found]]), minlength=len(known)).astype(np.int64)
        for a in range(0, len(known), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(known[a:a + 50_000].view(np.int64)), pa.array(sums[a:a + 50_000])], ["key", "n"])
    return count


def _runs(text: np.ndarray) -> list[tuple[int, int]]:
    """Columns of one text each; restored words come after the others, as texts of their own run."""
    cut = [0, *(np.flatnonzero(text[1:] != text[:-1]) + 1).tolist(), len(text)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


def _class_counter(model: np.ndarray, wanted: np.ndarray):
    """Per task: in how many toxic and other texts each wanted key is."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        sums = np.zeros((2, len(wanted)), np.int64)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                text, place = _in_texts(reader, piece, wanted)
                toxic = piece.column("toxic").to_numpy()[text]
                for k in (0, 1):
                    sums[k] += np.bincount(place[toxic == k], minlength=len(wanted))
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(sums[1]), pa.array(sums[0])], ["key", "n1", "n0"])
    return count


def _holders(model: np.ndarray, wanted: np.ndarray):
    """The ids of the texts that hold each wanted key."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                text, place = _in_texts(reader, piece, wanted)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(pa.array(text)), pa.array(wanted[place].view(np.int64))], ["doc_id", "key"])
    return find


def _bander(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's bands of MinHash values."""
    salts = mix64(np.arange(1, BANDS * IN_BAND + 1, dtype=np.uint64)).reshape(BANDS, IN_BAND)
    for batch in batches:
        for piece in pieces(batch, "text", PIECE):
            bands = np.zeros((piece.num_rows, BANDS), np.uint64)
            for i, sh in enumerate(text_shingles(piece.column("text"))):
                for k in range(BANDS if len(sh) else 0):
                    for salt in salts[k]:
                        bands[i, k] = mix64(bands[i, k:k + 1] * np.uint64(31) + mix64(sh ^ salt).min())[0]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(bands[:, k].copy().view(np.int64)) for k in range(BANDS)]],
                                             ["doc_id", *[f"b{k}" for k in range(BANDS)]])


def _originals(rows: list) -> dict[int, int]:
    """For each text (id, bands) one that stands for all its near copies, told from one to the next."""
    of: dict[int, int] = {}

    def top(x: int) -> int:
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x
    first: dict[tuple[int, int], int] = {}
    for doc, *bands in rows:
        of.setdefault(doc, doc)
        for band in enumerate(bands):
            a, b = top(doc), top(first.setdefault(band, doc))
            of[max(a, b)] = min(a, b)
    return {x: top(x) for x in of}


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, fit_rows: int = FIT_ROWS) -> tuple[list[tuple[int, float]], float]:
    """Rules (key, precision) and the score of a text that meets none, from docs (doc_id, text) and labels (doc_id, toxic)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = known.count()
    if total == 0:
        return [], 0.5
    part = int(min(1.0, fit_rows / total) * (1 << 20))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < part)  # about fit_rows rows of 20 bytes
    sample = materialize(docs.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic"), "fit")
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if n1 == 0:
        return [], 0.5 / (n0 + 1)
    least = max(FEW, math.ceil(SUPPORT * n1))
    toxic = sample.where("toxic = 1")
    tested = materialize(toxic.select("text").mapInArrow(_toxic_counter(model), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("key <> 0"), "keys")
    # at most the words of the fitted toxic texts over FEW, each in a few kinds
    wanted = np.sort(np.array([r[0] for r in tested.where(F.col("n") >= FEW).select("key").collect()], np.int64).view(np.uint64))
    if len(wanted) == 0:
        return [], min(0.5, (n1 + 0.5) / (n1 + n0 + 1))
    base = n1 / (n1 + n0)
    hard, unlike = math.log(100 * tested.count()), -math.log(min(base, 0.99))

    def sure(texts: int, others: int) -> bool:
        """So many independent toxic texts among ``others`` that are not are no chance for any key."""
        return texts >= FEW and texts * unlike - math.lgamma(texts + others + 1) + math.lgamma(texts + 1) + math.lgamma(others + 1) >= hard
    counts = sample.select("text", "toxic").mapInArrow(_class_counter(model, wanted), "key long, n1 long, n0 long").groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    sharp = {r[0]: (r[1], r[2]) for r in counts.where(F.col("n1") >= (F.col("n1") + F.col("n0")) * PRECISION).collect()}
    sharp = {k: n for k, n in sharp.items() if n[0] >= least or sure(*n)}
    held: dict[int, set[int]] = {k: set() for k in sharp}
    if sharp:
        # candidate rules in the toxic texts of the sample
        for r in toxic.select("doc_id", "text").mapInArrow(_holders(model, np.sort(np.array(list(sharp), np.int64).view(np.uint64))), "doc_id long, key long").collect():
            held[r[1]].add(r[0])
    stands_for = _originals(toxic.select("doc_id", "text").mapInArrow(_bander, "doc_id long, " + ", ".join(f"b{k} long" for k in range(BANDS))).collect()) if sharp else {}
    rules, explained, free = [], set(), n0

    def take(key: int) -> None:
        nonlocal free
        rules.append((key, (sharp[key][0] + base) / (sum(sharp[key]) + 1)))
        explained.update(held.pop(key))
        free -= sharp[key][1]
    # rules that chance can't explain
    for key in sorted(held):
        if sure(len({stands_for[x] for x in held[key]}), sharp[key][1]):
            take(key)
    held = {k: v for k, v in held.items() if len(v) >= least}
    while held:
        # by texts not yet explained, of equal gains the one with the fewest others, then the smaller key
        key = max(held, key=lambda k: (len(held[k] - explained), -sharp[k][1], -k))
        if len(held[key] - explained) < max(2, math.ceil(GAIN * n1)):
            break
        take(key)
    left = max(n1 - len(explained), 0)
    return rules, min(0.5, (left + 0.5) / (left + max(free, 0) + 1))


def _scorer(model: np.ndarray, rules: list[tuple[int, float]], none: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        order = sorted((np.uint64(k % (1 << 64)), p) for k, p in rules)
        keys_of, lacks = np.array([k for k, _ in order], np.uint64), np.log1p(-np.minimum(np.array([p for _, p in order]), 0.999))
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                out = np.full(piece.num_rows, none)
                if len(keys_of):
                    doc, rule = _in_texts(reader, piece, keys_of)
                    apart = np.bincount(doc, weights=lacks[rule], minlength=piece.num_rows)
                    out = np.where(apart < 0, np.maximum(1 - np.exp(apart), none), none)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(out)], ["doc_id", "score"])
    return score


def scores(docs: DataFrame, teachers: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id and score of every row of docs; teachers: doc_id, toxic of the texts to learn from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = letter_model(rows)
    rules, none = learn(rows, teachers, model, fit_rows)
    return rows.mapInArrow(_scorer(model, rules, none), "doc_id long, score double")


def op10(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scores(docs, labels.where(crc_mod("doc_id", 3) != 1).select("doc_id", "toxic"))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
