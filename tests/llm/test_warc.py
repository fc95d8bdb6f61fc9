import hashlib
import random
import zlib

from pyarrow import fs

from viewstar.llm import warc as A

SCHEMA = "page_id long, url string, html string, key string, first long"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def plain(rows):
    size = lambda h: len((h or "").encode())
    first = {}
    for i, _, h in rows:
        if size(h) >= A.LEAST and i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        f = first.get(h) if size(h) >= A.LEAST else None
        again = f is not None and f != i
        out.append((i, size(h), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_all_pages_read_back(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    bodies = ["", "short", "é" * 49, "é" * 50, "x" * 99, "y" * 100, "<p>" + "z" * 5000, None]
    rows = [(i, f"http://h{rng.randrange(30)}.example.com/p{rng.randrange(20)}?q=1#f", rng.choice(bodies)) for i in range(400)]
    rows += [(500, None, "y" * 100), (501, "", "n" * 300), (None, "http://a.b/", "n" * 300), (502, "http://[bad", "u" * 200), (503, "http://a.b/\r\nX: y\tz ö", "u" * 200), (504, "no scheme", "\x00\r\n\r\n" * 60),
             (505, "http://h1.example.com/p1?q=1", "only one"), (505, "http://h1.example.com/p1?q=1", "only one")]
    monkeypatch.setattr(A, "BLOCK", 16)
    pages = pages_of(spark, rows)
    archive = A.Archive.write(pages, f"file://{tmp_path}/w")
    got = archive.lookup(pages.select("url")).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain(rows)
    some = archive.lookup(spark.createDataFrame([("http://h1.example.com/p1?q=1",), ("http://nowhere.org/",)], "u string")).collect()
    assert len(some) == sum(A.url_key(u) == A.url_key("http://h1.example.com/p1?q=1") for _, u, _ in rows)
    # each archive is a run of gzip members that each hold one record
    store, path = fs.FileSystem.from_uri(f"file://{tmp_path}/w/archives")
    members = 0
    for f in store.get_file_info(fs.FileSelector(path)):
        data = store.open_input_stream(f.path, compression=None).read()
        while data:
            unpack = zlib.decompressobj(31)
            assert unpack.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
            data, members = unpack.unused_data, members + 1
    assert members == len(rows)


def test_one_url_and_one_payload_everywhere(spark, tmp_path):
    rows = [(i, "http://same.org/", "same " * 50) for i in range(7000)]
    pages = pages_of(spark, rows)
    got = A.Archive.write(pages, f"file://{tmp_path}/w").lookup(pages.select("url")).collect()
    assert sorted(r.page_id for r in got) == list(range(7000))
    assert [r.page_id for r in got if r.record_type == "response"] == [0] and {r.refers_to for r in got} == {None, 0}


def test_payload_of_very_many_pages_is_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_DIGESTS", 0)
    rows = [(i, f"http://h{i % 5}.org/{i}", "x" * 200 if i % 3 else f"page {i} " * 30) for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in A.Archive.write(pages, f"file://{tmp_path}/w").lookup(pages.select("url")).collect()}
    assert len(got) == 90 and all(got[i].record_type == ("response" if i % 3 == 0 or i == 1 else "revisit") for i in range(90))
    assert all(got[i].refers_to == (None if i % 3 == 0 or i == 1 else 1) for i in range(90))


def test_no_pages(spark, tmp_path):
    pages = pages_of(spark, [])
    assert A.Archive.write(pages, f"file://{tmp_path}/w").lookup(pages.select("url")).collect() == []


def test_keys_and_bisection():
    assert A.url_key("https://User@Blog.Example.com:80/a?b=1#c") == "com,example,blog)/a?b=1"
    assert A.url_key("http://a.org") == "org,a)/" and A.url_key(None) == A.url_key("  ") == ""
    lows, highs = [b"a", b"c", b"c", b"f"], [b"c", b"c", b"d", b"k"]
    assert [list(A.blocks_of(k, lows, highs)) for k in (b"a", b"c", b"d", b"e", b"z")] == [[0], [0, 1, 2], [2], [], []]
