"""Operator 11: fill-in-the-middle, both cuts found by ranks in a wavelet matrix.

A text is cut into units, a run of blanks with the word behind it or the blanks
that end the text; three parts of whole units are written in another order:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

Each code point of a piece of texts has one of eight classes: blank, letter,
digit or other, and whether it closes a unit.  A wavelet matrix over the classes
gives the rank of a class (how often it occurs before a position) by three rank
queries on bit vectors.  The units closed before a position are the sum of the
ranks of the four closing classes, so the number of units of a text is a
difference of two such counts, and the place where k units end is found by
bisection on them, for all texts of the piece at once.

``restored`` undoes it: markers don't occur in a text that is cut (such texts
stay plain), so the first marker after a part ends it.

Defined cases: a null text is an empty one and stays plain, a null id is hashed
as an empty one; repeated ids get equal cuts for equal texts; a part may be
empty; blanks are the ASCII ones, everything else is part of a word; an empty
table gives no rows; columns other than the id and the text are ignored.  Memory
is that of a piece of texts (``PIECE`` bytes, or one longer text).
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.llm.common import table
from viewstar.llm.kernel import pieces, release, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CLASS_BITS = 3
#: Classes are even for a code point within a unit, odd for one that closes it.
CLOSING = (1, 3, 5, 7)

_KIND = np.full(256, 6, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
_KIND[[*range(0x30, 0x3A)]] = 4


class WaveletMatrix:
    """Ranks in a sequence of small numbers, a bit vector for each of their bits."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for b in range(bits - 1, -1, -1):
            bit = (seq >> np.uint8(b)) & np.uint8(1)
            packed = np.zeros((len(seq) >> 6) * 8 + 8, np.uint8)
            ones = np.packbits(bit, bitorder="little")
            packed[:len(ones)] = ones
            words = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, before, len(seq) - int(before[-1])))
            # zeros first, each in its order
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    @staticmethod
    def _ones(level: tuple, at: np.ndarray) -> np.ndarray:
        words, before, _ = level
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each position."""
        lo, hi = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for b, level in zip(range(self.bits - 1, -1, -1), self.levels):
            if symbol >> b & 1:
                lo, hi = level[2] + self._ones(level, lo), level[2] + self._ones(level, hi)
            else:
                lo, hi = lo - self._ones(level, lo), hi - self._ones(level, hi)
        return hi - lo


class Units:
    """The units of a piece of texts."""

    def __init__(self, col: pa.Array):
        self.buf, self.off = text_bytes(col, lower=False)
        n = int(self.off[-1])
        lead = np.flatnonzero((self.buf[:n] & 0xC0) != 0x80)
        #: where each text's code points begin, and the byte of each code point
        self.at, self.lead = np.searchsorted(lead, self.off), np.append(lead, n)
        kind = _KIND[self.buf[lead]]
        blank = kind == 0
        last = np.zeros(len(kind), bool)
        last[self.at[1:][self.at[1:] > self.at[:-1]] - 1] = True
        closes = last.copy()
        closes[:-1] |= ~blank[:-1] & blank[1:]
        self.matrix = WaveletMatrix(kind + closes, CLASS_BITS)
        self.before = self.closed(self.at)
        self.n = np.diff(self.before)

    def closed(self, at: np.ndarray) -> np.ndarray:
        """Units of the whole piece that end before each position."""
        return sum(self.matrix.rank(c, at) for c in CLOSING)

    def ends(self, k: np.ndarray) -> np.ndarray:
        """Where the k-th unit of each text ends (its start for 0), in code points of the piece."""
        lo, hi = self.at[:-1].copy(), self.at[1:].copy()
        goal = self.before[:-1] + k
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            enough = self.closed(mid) >= goal
            hi = np.where(enough, mid, hi)
            lo = np.where(enough, lo, np.minimum(mid + 1, hi))
        return lo

    def byte(self, at: np.ndarray) -> np.ndarray:
        """The byte of a cut; one at a text's own edge is its edge."""
        return np.where(at == self.at[:-1], self.off[:-1], np.where(at == self.at[1:], self.off[1:], self.lead[at]))


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _transform(seed: int, percent: int, spm_percent: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids = piece.column("doc_id").to_pylist()
                units = Units(piece.column("text"))
                draws = np.array([struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16]) for i in ids], np.int64)
                ks = np.sort(draws[:, :2] % (units.n + 1)[:, None], axis=1)
                a, b = units.ends(ks[:, 0]), units.ends(ks[:, 1])
                data, cuts = units.buf.tobytes(), zip(units.off[:-1].tolist(), units.byte(a).tolist(), units.byte(b).tolist(), units.off[1:].tolist())
                forms, out = [], []
                for (h3, h4), (i, j, k, end) in zip(draws[:, 2:].tolist(), cuts):
                    text = data[i:end]
                    if not text or h3 % 100 >= percent or any(x in text for x in marks):
                        forms.append("plain")
                        out.append(text)
                    elif h4 % 100 < spm_percent:
                        forms.append("spm")
                        out.append(b"".join((s, data[k:end], p, data[i:j], m, data[j:k])))
                    else:
                        forms.append("psm")
                        out.append(b"".join((p, data[i:j], s, data[k:end], m, data[j:k])))
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(units.n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(a - units.at[:-1], pa.int64(), mask=plain), pa.array(b - a, pa.int64(), mask=plain),
                     pa.array(out, pa.binary()).view(pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
        release()
    return run


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every text;
    ``percent`` % of the ids are cut, ``spm_percent`` % of those as spm."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_transform(seed, percent, spm_percent), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    psm = form == "psm"
    mark = F.when(psm, SUFFIX).otherwise(PREFIX)
    n = len(PREFIX) + 1
    body = F.substr(output, F.lit(n))
    first = F.substr(body, F.lit(1), F.instr(body, mark) - 1)
    rest = F.substr(body, F.instr(body, mark) + n - 1)
    second = F.substr(rest, F.lit(1), F.instr(rest, F.lit(MIDDLE)) - 1)
    middle = F.substr(rest, F.instr(rest, F.lit(MIDDLE)) + n - 1)
    return F.when(form == "plain", output).when(psm, F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))


def op11(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
c AS (SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
             WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS prefix,
        coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle, coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                     ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256 FROM p
"""
