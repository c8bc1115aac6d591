import gzip
import hashlib

from tierflow.llm.warc_salvage import read_archive, salvage, write_archive
from tierflow.session import scratch_path


def record(i, body):
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:{i}>\r\n"
            f"WARC-Block-Digest: sha1:{hashlib.sha1(body).hexdigest()}\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def ids(data):
    return [f[b"warc-record-id"].decode() for _, _, f, _ in salvage(data) if f is not None]


def gaps(data):
    return [(a, b) for a, b, f, _ in salvage(data) if f is None]


A, B, C = record(1, b"first"), record(2, b"second body"), record(3, b"third\r\n\r\nWARC/1.1\r\nnot a record\r\n\r\n")


def test_sound_file_has_no_gap():
    assert ids(A + B + C) == ["<urn:x:1>", "<urn:x:2>", "<urn:x:3>"] and gaps(A + B + C) == []
    assert list(salvage(b"")) == []


def test_damaged_body_header_and_length():
    for bad in (B.replace(b"second", b"sEcond"), B.replace(b"Content-Length: 11", b"Content-Length: 9"),
                B.replace(b"Content-Length: 11", b"Content-Length: x"), B.replace(b"WARC/1.1", b"WXRC/1.1"),
                B[:-9], b"\x00\xff garbage " * 5):
        data = A + bad + C
        assert ids(data) == ["<urn:x:1>", "<urn:x:3>"]
        assert gaps(data) == [(len(A), len(A) + len(bad))]


def test_ends_and_beginnings():
    assert ids(b"junk" + A) == ["<urn:x:1>"] and gaps(b"junk" + A) == [(0, 4)]
    cut = A + B[:-20]
    assert ids(cut) == ["<urn:x:1>"] and gaps(cut) == [(len(A), len(cut))]
    assert gaps(b"no record at all") == [(0, 16)]


def test_compressed_members():
    a, b, c = (gzip.compress(x, mtime=0) for x in (A, B, C))
    assert ids(a + b + c) == ["<urn:x:1>", "<urn:x:2>", "<urn:x:3>"] and gaps(a + b + c) == []
    middle = len(b) // 2
    bad = b[:middle] + bytes([b[middle] ^ 0xFF]) + b[middle + 1:]
    assert ids(a + bad + c) == ["<urn:x:1>", "<urn:x:3>"] and gaps(a + bad + c) == [(len(a), len(a) + len(b))]
    assert ids(a + c[:-5]) == ["<urn:x:1>"] and gaps(a + c[:-5]) == [(len(a), len(a) + len(c) - 5)]


def test_round_trip_of_edge_rows(spark):
    big, exact = "x" * 1000, "é" * 500  # 1000 bytes each
    rows = [(1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (3, None, None), (4, "u\r\nWARC/1.1", ""),
            (5, "http://c/", exact), (6, "http://d/", exact), (7, "http://e/", "y" * 999), (8, "http://f/", "y" * 999),
            (None, "http://g/", big), (9, "http://h/", "WARC/1.1\r\n\r\n" * 2), (10, "http://i/", "z" * 3_000_000)]
    pages = spark.createDataFrame([r + (0, "d") for r in rows],
                                  "page_id long, url string, html string, length int, digest string")
    path = scratch_path(spark, "t-warc")
    write_archive(pages, path, records_per_file=4)
    got = read_archive(spark, path)
    assert got.where("gap").isEmpty() and got.count() == len(rows)
    seen = sorted((r["record_id"], r["type"], r["refers_to"] or "", r["declared_length"]) for r in got.collect())
    u = "<urn:page:{}>".format
    want = [(u(1), "revisit", u(2), 1000), (u(2), "response", "", 1000), (u(2), "response", "", 1000),
            (u(3), "response", "", 0), (u(4), "response", "", 0), (u(5), "revisit", u(6), 1000),
            (u(6), "response", "", 1000), (u(7), "response", "", 999), (u(8), "response", "", 999),
            (u(""), "revisit", u(2), 1000), (u(9), "response", "", 24), (u(10), "response", "", 3_000_000)]
    assert seen == sorted(want)
    payload = {r["record_id"]: bytes(r["payload"]) for r in got.where("type = 'response'").collect()}
    assert payload[u(6)] == exact.encode() and payload[u(9)] == b"WARC/1.1\r\n\r\n" * 2


def test_empty_table(spark):
    path = scratch_path(spark, "t-warc-empty")
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archive(spark, path).collect() == []


def test_files_are_bounded_by_bytes(spark):
    sizes = [0, 10, 400, 500, 501, 900, 2000, 2001, 9000, 30_000] * 12
    rows = [(i, "http://a/", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "t-warc-bytes")
    write_archive(pages, path, records_per_file=64, file_bytes=32_000)
    got = read_archive(spark, path)
    assert got.where("gap").isEmpty()
    assert sorted(bytes(r["payload"]).decode() for r in got.collect()) == sorted(h for _, _, h in rows)
    for f in got.groupBy("file").agg({"declared_length": "sum", "*": "count"}).collect():
        assert f["count(1)"] == 1 or f["sum(declared_length)"] <= 32_000 and f["count(1)"] <= 64
