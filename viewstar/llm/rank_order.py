"""Operator 2: language identification by rank-order profiles.

A language's profile is the order of its ``TOP`` most frequent n-grams (1 to 4
bytes of lower-cased UTF-8 inside words padded by one blank), counted over all
training texts.  A document is compared by the out-of-place distance: the sum of
how far each of its own ``TOP`` most frequent n-grams stands from its place in the
profile, ``TOP`` for one that the profile lacks.  The nearest language wins;
score is 1 less the distance's share of the largest possible.

Defined cases: null texts and texts without a letter give `und` with score 0, as
does everything when no labelled text exists; equal counts rank by the n-gram's
bytes, equal distances by the language's name; rows with null ids or repeated ids
keep their rows (a null id is in no fold: neither held out nor learned from);
other columns are ignored; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from viewstar.llm.common import crc_mod, table
from viewstar.llm.kernel import pieces, release

TOP = 300
LONGEST = 4
#: Bytes of text that a task reads at once.
PIECE = 2 << 20
#: The pipeline's stage rejects documents that score less (beside those without a letter).
LEAST_SCORE = 0.05
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _normal(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of words with one blank between, around and nothing else; offsets of the texts."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    buf = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    word = _IN_WORD[buf]
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[0] = True
    at = np.cumsum([0, *[len(r) + 1 for r in raw]])  # the blank before each text
    keep[at] = True
    out = np.where(word, buf, np.uint8(0x20))[keep]
    return out, np.cumsum(keep)[at] - 1


def _grams(buf: np.ndarray) -> list[np.ndarray]:
    """For each length the key of the n-gram that starts at each place; 0 where a blank is inside."""
    blank = buf == 0x20
    key = buf.astype(np.uint32)
    out = [np.where(blank, np.uint32(0), key)]
    ok = np.ones(len(buf), bool)
    for n in range(2, LONGEST + 1):
        m = len(buf) - n + 1
        if m <= 0:
            break
        key = (key[:m] << np.uint32(8)) | buf[n - 1:]
        ok = ok[:m] if n == 2 else ok[:m] & ~blank[n - 2:n - 2 + m]
        good = ok if n > 2 else ~(blank[:m] & blank[1:])
        out.append(np.where(good, key, np.uint32(0)))
    return out


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    keys = keys[np.searchsorted(keys, 1):]
    if len(keys) == 0:
        return keys, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.concatenate([first, [len(keys)]]))


def top_grams(keys: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent of the keys, in rank order."""
    found, count = _counts(keys)
    if len(found) > 4 * top:  # only those that can be among the first
        least = np.partition(count, len(count) - top)[len(count) - top]
        may = count >= least
        found, count = found[may], count[may]
    return found[np.argsort(-count, kind="stable")[:top]]


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a task's texts by language."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            for piece in pieces(batch.filter(pc.equal(langs, lang)), "text", PIECE):
                grams = _grams(_normal(piece.column("text").to_pylist())[0])
                parts = [_counts(g) for g in grams] + ([held[lang]] if lang in held else [])
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                sums = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)
                held[lang] = keys, sums
    for lang, (keys, sums) in held.items():
        for a in range(0, len(keys), 50_000):
            k = keys[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(sums[a:a + 50_000])], ["lang", "gram", "n"])
    held.clear()
    release()


def learn(labelled: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """lang -> its n-grams in rank order, from all rows (text, lang); ``top`` values a language reach the driver."""
    counts = labelled.where("lang is not null and text is not null").select("text", "lang").mapInArrow(_trainer, "lang string, gram long, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in ranked.select("lang", "rank", "gram").collect():
        found.setdefault(r[0], []).append((r[1], r[2]))
    return {k: np.array([g for _, g in sorted(v)], np.uint32) for k, v in sorted(found.items())}


def nearest(own: np.ndarray, grams: np.ndarray, places: np.ndarray, top: int = TOP) -> tuple[int, float]:
    """The profile (row of ``places``, per gram its rank or -1) nearest to a document's ranked n-grams, and the score."""
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    there = places[:, at]
    lacks = (there < 0) | (grams[at] != own)[None, :]
    apart = np.where(lacks, top, np.abs(there - np.arange(len(own))[None, :])).sum(axis=1)
    best = int(np.argmin(apart))
    return best, 1 - float(apart[best]) / (top * len(own))


def _predictor(profiles: dict[str, np.ndarray]):
    names = list(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.uint32)]))
        places = np.full((len(names), len(grams)), -1, np.int64)
        for i, own in enumerate(profiles.values()):
            places[i, np.searchsorted(grams, own)] = np.arange(len(own))
        for batch in batches:
            if "text" not in batch.schema.names:  # whole rows: their text is in them
                batch = batch.append_column("text", pc.struct_field(batch.column("row"), "text"))
            for piece in pieces(batch, "text", PIECE):
                texts = piece.column("text").to_pylist()
                buf, at = _normal(texts)
                keys = _grams(buf)
                lang, score = [], []
                for i, t in enumerate(texts):
                    a, b = int(at[i]), int(at[i + 1])  # from the blank before the text to the one after it
                    plain = names and b - a > 1 and any(map(str.isalpha, t))
                    own = top_grams(np.concatenate([k[a:max(b + 2 - n, a)] for n, k in enumerate(keys, 1)])) if plain else ()
                    if len(own):
                        best, s = nearest(own, grams, places)
                        lang.append(names[best])
                        score.append(s)
                    else:
                        lang.append("und")
                        score.append(0.0)
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in piece.schema.names if c != "text"], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 [*[c for c in piece.schema.names if c != "text"], "lang_pred", "score"])
            release()
    return predict


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predictor(profiles), "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) in a language that the profiles know."""
    profiles = learn(docs.where(crc_mod("doc_id", 5) != 0))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    out = rows.mapInArrow(_predictor(profiles), schema)
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(crc_mod("doc_id", 5) != 0))
    out = identify(docs, profiles)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
