"""Operator 9: WARC archives with a two-level capture index.

Writing: a page is one gzip member, `response` with an HTTP head and the payload,
or `revisit` (head only) where a response with an equal payload of at least
``LEAST`` bytes exists: the one with the smallest page_id.  Each task writes its
archives by itself into the shared folder, under names of its own attempt; only
the captures of the attempt that Spark accepts enter the index.

Index: captures sorted by reversed-host URL key in blocks of ``BLOCK`` lines, each
compressed; a sparse directory beside every index file holds a block's first and
last key and its place; the key ranges of the files (one line a file) come first.
A lookup searches the ranges, then a directory, both by bisection, reads only
the blocks that can hold the key and then only the records of their lines.

Defined cases: null html is an empty payload, null url the key ''; a page without
an id is a response unless its payload has one with an id; rows of one page_id
and payload are all responses if the id is the smallest; repeated urls keep every
capture; control characters in urls are percent-encoded; other columns are
ignored; an empty table gives no captures.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.llm.common import materialize, scratch_path, table

LEAST = 100
BLOCK = 3000
ARCHIVE_BYTES = 1 << 30
#: Bytes of archives that a reading task is meant to take.
READ_BYTES = 32 << 20
#: Digests of repeated payloads (some 100 bytes each) are broadcast up to this number; beyond, each is SALTS keys of a join.
BROADCAST_DIGESTS = 300_000
SALTS = 32
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- keys and records ------------------------------------------------------

def url_key(url: str | None) -> str:
    """Reversed host, then path and query: `http://a.b.org/x?y` is `org,b,a)/x?y`."""
    url = (url or "").strip()
    if not url:
        return ""
    url = quote(url, safe="".join(map(chr, range(33, 127))))
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return url
    rest = parts.path + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){rest or '/'}"


def _member(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    name = "" if page_id is None else page_id
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{name}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}"] if url else []),
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
        *([f"WARC-Refers-To: <urn:x-page:{first}>", f"WARC-Profile: {_PROFILE}"] if first is not None else []),
        f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """The named headers, HTTP headers and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"head": named, "http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


def _id(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", urn)
    return int(found[1]) if found else None


@lru_cache(maxsize=8)
def _open(uri: str):
    """A file in any store that pyarrow reaches, for reads by range."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    f = _open(uri)
    f.seek(offset)
    return f.read(length)


# ---- writing ---------------------------------------------------------------

def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    return store, path


def _archiver(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, (store, path) = None, "", 0, _folder(folder)
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                data = _member(r["page_id"], r["url"], (r["html"] or "").encode("utf-8", "replace"), r["first"])
                out.write(data)
                rows.append((url_key(r["url"]), r["page_id"], name, at, len(data)))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()
    return write


def _indexer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _folder(folder)
        name, at, held, first, last, total = uuid.uuid4().hex, 0, [], None, None, 0
        blocks = store.open_output_stream(f"{path}/{name}.cdx.gz", compression=None)
        directory = store.open_output_stream(f"{path}/{name}.dir", compression=None)

        def flush() -> None:
            nonlocal at
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress("\n".join(held).encode()) + packer.flush()
            blocks.write(data)
            low, high = held[0].split("\t", 1)[0], held[-1].split("\t", 1)[0]
            directory.write(f"{low}\t{high}\t{at}\t{len(data)}\n".encode())
            at += len(data)
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                first = r["key"] if first is None else first
                last = r["key"]
                total += r["length"]
                held.append(f"{r['key']}\t{'' if r['page_id'] is None else r['page_id']}\t{r['file']}\t{r['offset']}\t{r['length']}")
                if len(held) >= BLOCK:
                    flush()
        if held:
            flush()
        blocks.close()
        directory.close()
        if first is not None:
            yield pa.RecordBatch.from_pydict({"file": [name], "low": [first], "high": [last], "bytes": [total]})
    return write


class Archive:
    """Archives and their index under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def write(cls, pages: DataFrame, folder: str) -> "Archive":
        """Write the pages (page_id, url, html) and index them."""
        p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
        long_one = F.octet_length(F.coalesce("html", F.lit(""))) >= LEAST
        same = p.where(long_one).groupBy(F.sha2("html", 256).alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        same = materialize(same, "digests")
        # short payloads refer to nothing: a key of their own keeps them spread
        named = p.withColumn("digest", F.when(long_one, F.sha2("html", 256)).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.xxhash64("url", "html").cast("string")))))
        if same.count() <= BROADCAST_DIGESTS:
            typed = named.join(F.broadcast(same), "digest", "left")
        else:  # a payload of very many pages is spread over SALTS keys
            salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
            salted = named.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
            typed = salted.join(same.withColumn("salt", salts), ["digest", "salt"], "left")
        typed = typed.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
        captures = materialize(typed.mapInArrow(_archiver(f"{folder}/archives"), "key string, page_id long, file string, offset long, length long"), "captures")
        ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
        ordered.mapInArrow(_indexer(f"{folder}/index"), "file string, low string, high string, bytes long").write.parquet(f"{folder}/ranges")
        return cls(pages.sparkSession, folder)

    def lookup(self, urls: DataFrame) -> DataFrame:
        """url (one column) -> page_id, payload_bytes, payload_digest, record_type, refers_to of
        every capture of those urls' keys, read from the archives."""
        # a row for each index file, of which there are as many as shuffle partitions
        rows = self.spark.read.parquet(f"{self.folder}/ranges").collect()
        ranges = sorted((r["low"], r["high"], r["file"]) for r in rows)
        # a row of 100 bytes here stands for a block's records: the tasks follow the archives' bytes
        tasks = max(self.spark.sparkContext.defaultParallelism, sum(r["bytes"] for r in rows) // READ_BYTES)
        keys = urls.select(F.col(urls.columns[0]).cast("string").alias("url")).distinct().mapInArrow(_keyed, "key string").distinct().sort("key")
        refs = keys.mapInArrow(_block_finder(f"{self.folder}/index", ranges), "key string, file string, offset long, length long")
        refs = refs.repartition(tasks, "file", "offset").sortWithinPartitions("file", "offset", "key")
        return refs.mapInArrow(_record_reader(self.folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


# ---- reading ---------------------------------------------------------------

def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])


def blocks_of(key: bytes, lows: list[bytes], highs: list[bytes]) -> range:
    """Which of the ascending spans low..high (ends may be shared) can hold a key."""
    return range(bisect_left(highs, key), bisect_right(lows, key))


@lru_cache(maxsize=4)
def _directory(uri: str) -> tuple[list[bytes], list[bytes], list[tuple[int, int]]]:
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path, compression=None) as f:
        rows = [x.split(b"\t") for x in f.read().split(b"\n") if x]
    return [r[0] for r in rows], [r[1] for r in rows], [(int(r[2]), int(r[3])) for r in rows]


def _block_finder(index: str, ranges: list[tuple[str, str, str]]):
    ranges = sorted((a.encode(), b.encode(), f) for a, b, f in ranges)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs = [r[0] for r in ranges], [r[1] for r in ranges]
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                raw = key.encode()
                for i in blocks_of(raw, lows, highs):
                    first, last, place = _directory(f"{index}/{ranges[i][2]}.dir")
                    rows += [(key, ranges[i][2], *place[k]) for k in blocks_of(raw, first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "file", "offset", "length"])
    return find


def _record_reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lines, keys = None, [], []
        for batch in batches:
            for part in (batch.slice(a, 256) for a in range(0, batch.num_rows, 256)):
                rows = []
                for r in part.to_pylist():
                    if at != (r["file"], r["offset"]):
                        at = r["file"], r["offset"]
                        lines = [x.split(b"\t") for x in zlib.decompress(read_range(f"{folder}/index/{r['file']}.cdx.gz", r["offset"], r["length"]), 31).split(b"\n")]
                        keys = [x[0] for x in lines]
                    key = r["key"].encode()
                    for x in lines[bisect_left(keys, key):bisect_right(keys, key)]:
                        got = parse_record(read_range(f"{folder}/archives/{x[2].decode()}", int(x[3]), int(x[4])))
                        head, kind = got["head"], got["head"]["WARC-Type"]
                        whole = kind == "response"
                        rows.append((_id(head["WARC-Record-ID"]), len(got["payload"]) if whole else int(got["http"]["Content-Length"]),
                                     hashlib.sha256(got["payload"]).hexdigest() if whole else head["WARC-Payload-Digest"].removeprefix("sha256:"),
                                     kind, _id(head.get("WARC-Refers-To", ""))))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return read


def op9(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = Archive.write(pages, scratch_path(spark, "warc"))
    return archive.lookup(pages.select("url"))


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
