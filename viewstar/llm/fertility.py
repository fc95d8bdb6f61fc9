"""Operator 12: quality rules from the fertility of public tokenizers.

Each word (between ASCII blanks, as it stands) is tokenised alone by a public
vocabulary.  A text's measures, by vocabulary: code points of words for each token,
the share of tokens that stand for single bytes of what the vocabulary lacks, and
the entropy of its tokens in bits.  Gibberish, shouting and symbol noise break
words into many tokens, encodings the vocabulary doesn't know fall back to bytes,
and stuffed or looped text has few different tokens.

A text is judged within its group, its language and dominant script.  Over all
texts that pass the base rules each measure is counted in fine bins; a group's
quartiles come from these counts, and its band reaches from them by so many times
their distance (``FENCES``).  Chars per token are bounded on both sides, byte share
above, entropy below.  A group of under ``MIN_GROUP`` such texts has no band and
rejects nothing.

Base rules: under 50 words, or over half of the words in 3-word windows that
occur twice or more in the text.

Defined cases: a null text is an empty one (no words: base_failed); a null
language counts as ''; a text without letters has the script 'none'; without
tokens a text's measures are null; repeated ids keep their rows; an empty table
gives no rows; columns other than id, text and language are ignored.  Words,
lines and windows of one text are equal if 64-bit hashes of them are, words for
the tokenizer if 128 bits are.  Memory: a piece of texts and the word tables.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewstar.llm.common import materialize, table
from viewstar.llm.kernel import _PLACE, BLANK_WORDS, U64, hash_spans, mix64, pieces, release, text_bytes, words
from viewstar.llm.word_table import WordTable, two_hashes

PIECE = 2 << 20
WORDS_HELD = 400_000
MIN_WORDS = 50
MIN_GROUP = 100
#: Bin width of a measure, least distance of quartiles that counts, and how many such distances a band reaches down and up.
FENCES = {"chars_per_token": (0.01, 0.05, 5, 5), "byte_share": (0.001, 0.01, None, 5), "entropy": (0.01, 0.1, 3, None)}
#: Bands of more groups than this are joined by a shuffle (a band is under 300 bytes).
BROADCAST_GROUPS = 10_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "other")
#: The script of a letter by the first byte of its UTF-8 form.
_SCRIPT = np.zeros(256, np.uint8)
for _lo, _hi, _k in ((0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD4, 3), (0xD6, 0xD7, 4), (0xD8, 0xDD, 5),
                     (0xE0, 0xE0, 6), (0xE1, 0xE1, 10), (0xE3, 0xE3, 7), (0xE4, 0xE9, 8), (0xEA, 0xED, 9)):
    _SCRIPT[_lo:_hi + 1] = _k


class Pieces:
    """A sentencepiece vocabulary; byte tokens are those it falls back to."""

    def __init__(self, content: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())], bool)

    def __call__(self, found: list[str]) -> list[list[int]]:
        return self.model.encode(found, num_threads=1)


class Merges:
    """A byte-level BPE vocabulary, a line for each token's bytes and rank; byte
    tokens are single bytes beyond ASCII."""

    def __init__(self, content: bytes):
        import public_tokenizers
        import tiktoken
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        self.model = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
        self.is_byte[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80]] = True

    def __call__(self, found: list[str]) -> list[list[int]]:
        return list(map(self.model.encode_ordinary, found))


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _again(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal keys: whether there are several, and whether an earlier place holds it."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, several = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return several, later


def base_measures(buf: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, h: np.ndarray) -> dict[str, np.ndarray]:
    n = int(off[-1])
    out = {"n_words": np.diff(at)}
    lead = np.concatenate([[0], np.cumsum((buf[:n] & 0xC0) != 0x80, dtype=np.int64)])
    out["word_chars"] = _per_text(lead[ends] - lead[starts], at)
    out["n_symbols"] = _per_text(_SYMBOL[buf[:n]], off)
    # lines with a word, by hash within the text
    breaks = np.flatnonzero(buf[:n] == 0x0A)
    line_start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([breaks, off[1:]]), kind="stable")
    first = np.searchsorted(starts, line_start)
    real = first < len(starts)
    real[real] = starts[first[real]] < line_end[real]
    line_start, line_end = line_start[real], line_end[real]
    text = np.searchsorted(off, line_start, "right").astype(U64)
    _, later = _again(mix64(hash_spans(buf, line_start, line_end) + text * _PLACE[3]))
    out["n_dup_lines"] = np.bincount(text[later].astype(np.int64) - 1, minlength=len(off) - 1)
    # three words in a row
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    several = np.zeros(len(h) + 2, bool)
    if len(h) >= 3:
        wide = mix64(h[:-2] * _PLACE[0] + h[1:-1] * _PLACE[1] + h[2:] * _PLACE[2]) + text[:-2].astype(U64) * _PLACE[3]
        inside = np.flatnonzero(text[:-2] == text[2:])
        several[2:][inside] = _again(mix64(wide[inside]))[0]
    out["n_repeat_words"] = _per_text(several[2:] | several[1:-1] | several[:-2], at)
    return out


def scripts(buf: np.ndarray, off: np.ndarray) -> list[str]:
    """The script of most letters of each text (the first in ``SCRIPTS`` of several)."""
    n = int(off[-1])
    kind = _SCRIPT[buf[:n]]
    letters = np.flatnonzero(kind)
    text = np.searchsorted(off, letters, "right") - 1
    counts = np.bincount(text * len(SCRIPTS) + kind[letters], minlength=(len(off) - 1) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    return [SCRIPTS[k] if c else "none" for k, c in zip(counts.argmax(axis=1).tolist(), counts.max(axis=1).tolist())]


def token_measures(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray, is_byte: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, byte tokens and entropy of each text; sizes are the words' tokens, at their places."""
    total = np.concatenate([[0], np.cumsum(sizes)])[at]
    n = np.diff(total)
    key = np.sort(np.repeat(np.arange(len(n), dtype=np.int64), n) << 16 | ids)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    weight = np.bincount(key[first] >> 16, weights=count * np.log2(count), minlength=len(n))
    some = np.maximum(n, 1)
    return n, _per_text(is_byte[ids], total), np.log2(some) - weight / some


SCHEMA = "doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, tokens array<struct<n:long,bytes:long,entropy:double>>"
_TABLES: dict[int, list] = {}


def _tables(files) -> list:
    """The vocabularies with their word tables, kept by the worker process between tasks."""
    key = hash(tuple(files.value))
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = [(v, WordTable(v, WORDS_HELD)) for v in (Merges(c) if ranks else Pieces(c) for ranks, c in files.value)]
    return _TABLES[key]


def _measure(files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("n", pa.int64()), ("bytes", pa.int64()), ("entropy", pa.float64())])
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                buf, off = text_bytes(piece.column("text"), lower=False)
                starts, ends, at = words(buf, off, BLANK_WORDS)
                hashes = two_hashes(buf, starts, ends)
                base = base_measures(buf, off, starts, ends, at, hashes[0])
                found = []
                for vocabulary, held in _tables(files):
                    ids, sizes = held.ids(held.lookup(buf, starts, ends, hashes))
                    found.append([pa.array(x) for x in token_measures(ids, sizes, at, vocabulary.is_byte)])
                rows, k = piece.num_rows, len(found)
                each = [pa.concat_arrays([f[j] for f in found]).take(pa.array(np.arange(k * rows).reshape(k, rows).T.reshape(-1))) for j in range(3)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * k, pa.int32()), pa.StructArray.from_arrays(each, fields=list(kind)))
                group = [f"{a}/{s}" for a, s in zip(piece.column("lang").to_pylist(), scripts(buf, off))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(group, pa.string()), *[pa.array(v, pa.int64()) for v in base.values()], lists],
                                                 ["doc_id", "grp", *base, "tokens"])
        release()
    return run


def measures(docs: DataFrame, vocabularies: list[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """A row for each text: its group, the base counts, and for each vocabulary file
    (sentencepiece models, or ranks of byte-level merges named *.tiktoken; some MB, which tasks get
    from the driver) its tokens, byte tokens and token entropy."""
    content = []
    for path in vocabularies:
        with open(path, "rb") as f:
            content.append((path.endswith(".tiktoken"), f.read()))
    files = docs.sparkSession.sparkContext.broadcast(content)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    return texts.mapInArrow(_measure(files), SCHEMA)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _value(v: int, name: str):
    t = F.col("tokens")[v]
    if name == "chars_per_token":
        return F.when(t["n"] > 0, F.col("word_chars") / t["n"])
    return F.when(t["n"] > 0, t["bytes"] / t["n"] if name == "byte_share" else t["entropy"])


def bands(measured: DataFrame, n_vocabularies: int) -> DataFrame:
    """(grp, low, high): maps from measure to bound, for the groups large enough."""
    parts = [F.struct(F.lit(f"{name}:{v}").alias("name"), F.floor(_value(v, name) / width).alias("bin")) for v in range(n_vocabularies) for name, (width, *_) in FENCES.items()]
    counted = (measured.where(~base_failed()).select("grp", F.inline(F.array(*parts))).where(F.col("bin").isNotNull())
               .groupBy("grp", "name", "bin").agg(F.count(F.lit(1)).alias("n")))
    # a window of at most as many rows as a measure has bins
    whole = W.partitionBy("grp", "name")
    upto = F.sum("n").over(whole.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    ranked = counted.select("grp", "name", "bin", upto.alias("upto"), F.sum("n").over(whole).alias("total")).where(F.col("total") >= MIN_GROUP)
    quartile = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bin")))
    q = ranked.groupBy("grp", "name").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (width, least, down, up) in FENCES.items():
        is_it = F.col("name").startswith(name)
        reach = F.greatest((F.col("q3") - F.col("q1")) * width, F.lit(least))
        low = F.when(is_it, F.col("q1") * width - reach * F.lit(down).cast("double")).otherwise(low)
        high = F.when(is_it, (F.col("q3") + 1) * width + reach * F.lit(up).cast("double")).otherwise(high)
    q = q.select("grp", "name", low.alias("low"), high.alias("high"))
    return q.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("name", "low"))).alias("low"), F.map_from_entries(F.collect_list(F.struct("name", "high"))).alias("high"))


def judged(docs: DataFrame, vocabularies: list[str], **columns) -> DataFrame:
    """The base counts, base_failed, kept, what speaks against a text (comma-joined
    measures beyond their band, with the vocabulary's number) and its measures."""
    measured = materialize(measures(docs, vocabularies, **columns), "fertility")
    limits = materialize(bands(measured, len(vocabularies)), "bands")
    small = F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS and limits.where(F.octet_length("grp") > 200).isEmpty() else limits
    names = [f"{name}:{v}" for v in range(len(vocabularies)) for name in FENCES]
    value = {f"{name}:{v}": _value(v, name) for v in range(len(vocabularies)) for name in FENCES}
    beyond = [F.when((value[n] < F.try_element_at("low", F.lit(n))) | (value[n] > F.try_element_at("high", F.lit(n))), n) for n in names]
    out = measured.join(small, "grp", "left").withColumn("base_failed", base_failed()).withColumn("against", F.concat_ws(",", *beyond))
    kept = ~F.col("base_failed") & (F.col("against") == "")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
                      F.col("grp").alias("language_script"), "against", *[value[n].alias(n.replace(":", "_")) for n in names])


def op12(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return judged(table(spark, sf_dir, "documents"), [public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")])
