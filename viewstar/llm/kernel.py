"""Array kernels for the tasks: words and shingles of a batch of texts.

They run inside ``mapInArrow`` on one Arrow batch at a time.  A batch is cut
into pieces of whole texts of about ``PIECE`` bytes, so a task's memory follows
its longest text and not its number of rows.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 4 << 20
#: Longer spans of bytes are hashed by a digest each.
LONG_SPAN = 4096
U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that end at white space, `[^\x20\x09-\x0D]+`.
BLANK_WORDS = ~_SPACE
#: Bytes of words of letters, digits and everything beyond ASCII (lower-cased text).
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)
#: Odd factors of the word positions in a shingle.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def text_bytes(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty), lower-cased in A-Z unless
    told otherwise and padded by 8 zero bytes, with the offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None else np.empty(0, np.uint8)
    buf = np.zeros(len(data) + 8, np.uint8)
    buf[:len(data)] = _LOWER[data] if lower else data
    return buf, off - off[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``size`` bytes of text each."""
    if batch.num_rows == 0:
        return
    lens = np.nan_to_num(np.asarray(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), float))
    group = (np.cumsum(lens) // size).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def words(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin in them."""
    n = int(off[-1])
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(off), np.int64)
    w = is_word[buf[:n]]
    first = np.empty(n + 1, bool)
    first[0], first[-1] = w[0], True
    first[1:n] = w[1:] & ~w[:-1]
    full = off[:-1][off[1:] > off[:-1]]
    first[full] = w[full]
    last = np.empty(n, bool)
    last[-1] = w[-1]
    last[:-1] = w[:-1] & ~w[1:]
    last[full[full > 0] - 1] = w[full[full > 0] - 1]
    starts, ends = np.flatnonzero(first[:n]), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes a step, those over
    ``LONG_SPAN`` by a digest; hashes of different seeds (0, 1, 2) are independent."""
    if len(starts) == 0:
        return np.empty(0, U64)
    eight = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
    n = ends - starts
    h = mix64((n.astype(U64) * _PLACE[seed]) ^ (eight[starts] & _KEEP[np.minimum(n, 8)]))
    k = 8
    more = np.flatnonzero((n > k) & (n <= LONG_SPAN))
    while more.size:
        h[more] = mix64(h[more] * _PLACE[seed + 1] + (eight[starts[more] + k] & _KEEP[np.minimum(n[more] - k, 8)]))
        k += 8
        more = more[n[more] > k]
    for i in np.flatnonzero(n > LONG_SPAN).tolist():
        digest = hashlib.blake2b(buf[starts[i]:ends[i]].data, digest_size=8, salt=bytes([seed])).digest()
        h[i] = np.frombuffer(digest, U64)[0]
    return h


def hash_words(ws: list[str]) -> np.ndarray:
    """The same hash for a list of words."""
    buf, off = text_bytes(pa.array(ws, pa.string()))
    return hash_spans(buf, off[:-1], off[1:])


def shingles(h: np.ndarray, at: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size`` consecutive words; with
    fewer words one hash of them all; without words none."""
    n = len(h)
    wide = np.zeros(max(n - size + 1, 0), U64)
    for j in range(size):
        wide += h[j:n - size + 1 + j] * _PLACE[j] if n >= size else U64(0)
    wide = mix64(wide)
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(wide[a:b - size + 1]))
        elif b > a:
            whole = (h[a:b] * _PLACE[:b - a]).sum(dtype=U64) + U64(b - a)
            out.append(mix64(np.array([whole], U64)))
        else:
            out.append(np.empty(0, U64))
    return out


def text_shingles(col: pa.Array) -> list[np.ndarray]:
    buf, off = text_bytes(col)
    starts, ends, at = words(buf, off, BLANK_WORDS)
    return shingles(hash_spans(buf, starts, ends), at)


def long_lists(rows: list[np.ndarray]) -> pa.Array:
    """A column of lists of 64-bit integers."""
    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows).view(np.int64) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc
    _trim = None


def release() -> None:
    """Give back to the system what a finished task has freed: a worker process
    outlives its tasks, and beside it run those of other operators."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
