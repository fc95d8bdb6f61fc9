"""Operator 1: token ids in grammar-compressed shards (Re-Pair).

Texts are encoded in ascending doc_id order, an end id closing each, and cut into
shards of about ``SHARD`` ids.  In each shard frequent pairs of neighbouring
symbols are replaced by new symbols, round after round: a round counts all pairs,
takes those seen at least ``MIN_COUNT`` times, most frequent first where they
overlap, and ends the work when it would save less than ``MIN_GAIN_PERCENT`` % of
the symbols.  A shard stores its ids' alphabet, the rules, how many ids each rule
expands to, and the symbols, so any range of ids is decoded by summing lengths
and expanding only the symbols that it meets (``read_range``).

File format: a Parquet table, a row for a shard: part (ascending ranges of
doc_id), shard (its number there), before (ids before it in its part), n_tokens,
doc_ids and doc_tokens (of the texts that start in it), data: seven 32-bit
little-endian counts (alphabet, rules, levels, symbols, three zeros), then
alphabet u32, rules' left and right u16, rules' lengths u32, rules per level u32,
symbols u16.

Memory: a task holds one batch, one shard and its word table (``WORDS_HELD``
words); a longer text fills several shards.  Repeated or null ids keep their rows (nulls
first, equal ids by text); a null text is an empty one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewstar.llm.common import scratch_path, table
from viewstar.llm.kernel import BLANK_WORDS, pieces, release, text_bytes, words
from viewstar.llm.word_table import WordTable, spread

END_ID = 1
SHARD = 1_000_000
MIN_COUNT = 8
MIN_GAIN_PERCENT = 1
MAX_SYMBOLS = 1 << 16
#: Words a worker holds the ids of, some 50 bytes each.
WORDS_HELD = 600_000
#: Bytes of text that a task encodes at once.
PIECE = 1 << 20
_SLOTS = 1 << 20


# ---- grammar ---------------------------------------------------------------

def _frequent_pairs(seq: np.ndarray, room: int) -> np.ndarray:
    """Keys (left << 16 | right) of the frequent pairs, most frequent first."""
    key = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [len(key)]]))
    often = np.flatnonzero(count >= MIN_COUNT)
    often = often[np.argsort(-count[often], kind="stable")][:room]
    return key[first[often]]


def _replace_round(seq: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: the shorter sequence and the pairs (keys) that the new symbols stand for."""
    none = np.empty(0, np.uint32)
    if len(seq) < 2 or n_symbols >= MAX_SYMBOLS:
        return seq, none
    pairs = _frequent_pairs(seq, MAX_SYMBOLS - n_symbols)
    if len(pairs) == 0:
        return seq, none
    # a hashed table of the pairs; of those that meet in a slot the most frequent stays this round
    slot_of = lambda k: ((k * np.uint32(2654435761)) >> np.uint32(12)).astype(np.int64)
    table_key, table_rank = np.zeros(_SLOTS, np.uint32), np.full(_SLOTS, 1 << 30, np.int32)
    slots = slot_of(pairs)[::-1]
    table_key[slots], table_rank[slots] = pairs[::-1], np.arange(len(pairs) - 1, -1, -1, dtype=np.int32)
    key = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
    at = slot_of(key)
    rank = np.where(table_key[at] == key, table_rank[at], np.int32(1 << 30))
    wins = rank < (1 << 30)
    wins[1:] &= rank[1:] < rank[:-1]
    wins[:-1] &= rank[:-1] <= rank[1:]
    used = np.bincount(rank[wins], minlength=len(pairs))
    used = used >= 2
    where = np.flatnonzero(wins)
    where = where[used[rank[where]]]
    if len(where) * 100 < MIN_GAIN_PERCENT * len(seq):
        return seq, none
    symbol = (np.cumsum(used) - 1 + n_symbols).astype(np.uint32)
    out = seq.copy()
    out[where] = symbol[rank[where]]
    keep = np.ones(len(seq), bool)
    keep[where + 1] = False
    return out[keep], pairs[used]


def pack(ids: np.ndarray) -> bytes:
    """The grammar of a shard's ids."""
    alphabet = np.flatnonzero(np.bincount(ids)).astype(np.uint32) if len(ids) else np.empty(0, np.uint32)
    assert len(alphabet) <= MAX_SYMBOLS, "more different ids than symbols in a shard"
    number = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint16)
    number[alphabet] = np.arange(len(alphabet))
    seq = number[ids]
    left, right, levels = [], [], []
    n = len(alphabet)
    while True:
        seq, pairs = _replace_round(seq, n)
        if len(pairs) == 0:
            break
        seq = seq.astype(np.uint16)
        left.append((pairs >> np.uint32(16)).astype(np.uint16))
        right.append((pairs & np.uint32(0xFFFF)).astype(np.uint16))
        levels.append(len(pairs))
        n += len(pairs)
    a = np.concatenate(left) if left else np.empty(0, np.uint16)
    b = np.concatenate(right) if right else np.empty(0, np.uint16)
    size = np.ones(n, np.uint32)
    done = len(alphabet)
    for k in levels:
        r = slice(done - len(alphabet), done - len(alphabet) + k)
        size[done:done + k] = size[a[r]] + size[b[r]]
        done += k
    head = np.array([len(alphabet), len(a), len(levels), len(seq), 0, 0, 0], "<u4")
    return b"".join(x.tobytes() for x in (head, alphabet.astype("<u4"), a.astype("<u2"), b.astype("<u2"),
                                          size[len(alphabet):].astype("<u4"), np.array(levels, "<u4"), seq.astype("<u2")))


class Shard:
    """A packed shard, read lazily from its bytes."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<u4", 7)
        at = 28

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out
        self.alphabet = take("<u4", int(head[0]))
        self.left, self.right, self.rule_size = take("<u2", int(head[1])), take("<u2", int(head[1])), take("<u4", int(head[1]))
        self.levels, self.seq = take("<u4", int(head[2])), take("<u2", int(head[3]))
        self.size = np.concatenate([np.ones(len(self.alphabet), np.int64), self.rule_size.astype(np.int64)])
        self.start = np.cumsum(self.size) - self.size
        flat = np.empty(int(self.size.sum()), np.uint32)
        flat[:len(self.alphabet)] = self.alphabet
        done, base = 0, len(self.alphabet)
        for k in self.levels.tolist():  # a level's rules only name symbols of earlier levels
            a, b = self.left[done:done + k], self.right[done:done + k]
            both = np.stack([a, b], axis=1).reshape(-1)
            lo = int(self.start[base + done])
            flat[lo:lo + int(self.size[base + done:base + done + k].sum())] = flat[spread(self.start[both], self.size[both])]
            done += k
        self.flat = flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.start[symbols], self.size[symbols])]

    def ids(self) -> np.ndarray:
        return self.expand(self.seq)

    def read_range(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1 of the shard, expanding only the symbols that hold them."""
        ends = np.cumsum(self.size[self.seq])
        lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(ends, b, "left") + 1
        if b <= a or lo >= len(self.seq):
            return np.empty(0, np.uint32)
        skip = a - (int(ends[lo - 1]) if lo else 0)
        return self.expand(self.seq[lo:hi])[skip:skip + b - a]


# ---- encoding --------------------------------------------------------------

#: Small Latin letters, then symbols: the tokenizer changes neither and cuts between them, so its model can be asked at once.
_PLAIN = re.compile(r"([a-zà-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """Whole texts to ids, with the tokenizer asked once for each word that the
    worker doesn't hold: this tokenizer drops white space and no id crosses it."""

    def __init__(self, spec: str, held: int = WORDS_HELD):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        # how the tokenizer spells the letters beyond ASCII to its model
        self.spelled = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(0xE0, 0x100) if c != 0xF7}
        self.table = WordTable(self._tokenize, held)

    def _tokenize(self, found: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(found)
        other = []
        for i, w in enumerate(found):
            plain = _PLAIN.fullmatch(w)
            if plain:
                out[i] = [t.id for part in plain.groups() if part for t in self.model.tokenize(part.translate(self.spelled))]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([found[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end ids, and how many belong to each text."""
        buf, off = text_bytes(texts)
        starts, ends, at = words(buf, off, BLANK_WORDS)
        special = np.flatnonzero((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))
        if special.size:
            # letters a-z only differ in case here, except inside the special tokens' names
            raw, _ = text_bytes(texts, lower=False)
            for w in np.unique(np.searchsorted(starts, special, "right") - 1).tolist():
                buf[starts[w]:ends[w]] = raw[starts[w]:ends[w]]
        ids, sizes = self.table.ids(self.table.lookup(buf, starts, ends))
        closing = np.concatenate([[0], np.cumsum(sizes)])[at[1:]]
        return np.insert(ids.astype(np.uint32), closing, END_ID), np.diff(closing, prepend=0) + 1


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec) -> Encoder:
    """One per worker process, which outlives its tasks."""
    key = hash(spec.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec.value)
    return _ENCODERS[key]


SCHEMA = "part int, shard int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, data binary"


def _shard_writer(spec):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        docs: list[tuple[int | None, int]] = []
        held = 0

        def row(data: np.ndarray) -> pa.RecordBatch:
            nonlocal shard, before, docs
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "before": pa.array([before], pa.int64()),
                "n_tokens": pa.array([len(data)], pa.int64()), "doc_ids": pa.array([[d for d, _ in docs]], pa.list_(pa.int64())),
                "doc_tokens": pa.array([[n for _, n in docs]], pa.list_(pa.int64())), "data": pa.array([pack(data)], pa.binary())})
            shard, before, docs = shard + 1, before + len(data), []
            return out

        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                more, sizes = _encoder(spec).encode(piece.column("text"))
                for name, n, end in zip(piece.column("id").to_pylist(), sizes.tolist(), np.cumsum(sizes).tolist()):
                    docs.append((name, n))
                    held += n
                    ids.append(more[end - n:end])
                    if held >= SHARD:
                        data = np.concatenate(ids)
                        while len(data) >= SHARD:  # a long text goes on in the next shards
                            yield row(data[:SHARD])
                            data = data[SHARD:]
                        ids, held = [data.copy()], len(data)
            release()
        if held or docs:
            yield row(np.concatenate(ids))
        ids.clear()
        release()
    return write


def write_shards(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode and write all texts; ``tokenizer_json`` is the content of a tokenizer
    file of the given kind (some MB), which tasks get from the driver."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = texts.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(_shard_writer(spec), SCHEMA).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: place, number and checksum of its ids, from the shards of a part in order."""
    name, missing, crc, start, n, open_doc = None, 0, 0, 0, 0, False
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            ids, at = Shard(r["data"]).ids().astype("<u4"), 0
            pos = r["base"] + r["before"]
            if open_doc:
                at = min(missing, len(ids))
                crc, missing = zlib.crc32(ids[:at].tobytes(), crc), missing - at
                if missing == 0:
                    out.append((name, start, n, crc))
                    open_doc = False
            for doc, size in zip(r["doc_ids"], r["doc_tokens"]):
                name, start, n = doc, pos + at, size
                have = min(size, len(ids) - at)
                crc, missing = zlib.crc32(ids[at:at + have].tobytes()), size - have
                at += have
                if missing == 0:
                    out.append((name, start, n, crc))
                else:
                    open_doc = True
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every text, decoded from the files."""
    shards = spark.read.parquet(path)
    # a row for each part, of which there are as many as shuffle partitions
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    whole = shards.join(F.broadcast(bases), "part").repartition("part").sortWithinPartitions("part", "shard")
    whole = whole.select("before", "doc_ids", "doc_tokens", "data", "base")
    return whole.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def encoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the shards of ``docs`` into the shared folder and read their digests back."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    path = scratch_path(docs.sparkSession, "shards")
    write_shards(docs, path, spec)
    return read_digests(docs.sparkSession, path)
