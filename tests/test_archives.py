"""Archive files: framing, the two readers, and what a failed write leaves."""

import gzip
import os
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deckmill.sources import archives

ROW = "record_id string, url string, archived_at string, mime string, payload binary, chunked boolean"


def rows_of(spark, n):
    data = [(f"r{i}", f"http://h{i % 3}/{i}\nx", "2024-01-01T00:00:00Z", "text/html", bytes(f"body {i} " * (i * 50 % 2000), "ascii") if i % 5 else None, i % 2 == 0)
            for i in range(n)]
    # payloads that look like records and members
    data.append(("evil", "http://e/", "2024", "a/b; c=d", b"\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n" + gzip.compress(b"WARC/1.0\r\n\r\n"), False))
    return spark.createDataFrame(data, ROW)


def digests(df):
    return sorted((r["record_id"], r["url"], r["payload"] and zlib.crc32(r["payload"]), r["error"], r["mime"], r["status"]) for r in df.collect())


def test_scan_and_index_give_back_what_was_written(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = rows_of(spark, 200)
    archives.write(rows.repartition(3), path)
    archives.write(rows_of(spark, 1).limit(0), path)
    want = sorted((r["record_id"], r["url"].replace("\n", "%0A"), r["payload"] and zlib.crc32(r["payload"]), "", r["mime"].split(";")[0], 200)
                  for r in rows.collect())
    scanned = archives.scan(spark, path)
    entries = archives.index(spark, path)
    assert digests(scanned) == want and digests(archives.read_index(entries, path, 4)) == want
    places = {(r["filename"], r["offset"], r["length"]) for r in scanned.collect()}
    assert places == {(r["filename"], r["offset"], r["length"]) for r in entries.collect()} and len(places) == 201
    assert not [n for n in os.listdir(path) if n.startswith("_")]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = rows_of(spark, 50).repartition(2)
    archives.write(rows, path)
    before = sorted(os.listdir(path))
    broken = rows.withColumn("url", F.when(F.col("record_id") == "r7", F.raise_error(F.lit("lost"))).otherwise(F.col("url")))
    with pytest.raises(Exception, match="lost"):
        archives.write(broken, path)
    assert sorted(os.listdir(path)) == before and archives.scan(spark, path).count() == 51


def test_broken_places_are_named(spark, tmp_path):
    path = tmp_path / "a"
    path.mkdir()
    good = archives.record_bytes({"record_id": "g", "url": "u", "payload": b"x" * 5000})
    (path / "cut.warc.gz").write_bytes(good + good[:-40])
    (path / "plain.warc").write_bytes(gzip.decompress(good) * 2)
    (path / "none.warc.gz").write_bytes(b"")
    (path / "joined.warc.gz").write_bytes(gzip.compress(gzip.decompress(good) * 3))
    (path / "other.txt").write_bytes(b"left out")
    rows = archives.scan(spark, str(path)).collect()
    found = sorted((r["filename"], r["offset"], r["error"]) for r in rows)
    whole = [("cut.warc.gz", 0, ""), *[("joined.warc.gz", 0, "")] * 3, *[("plain.warc", 0, "")] * 2]
    assert found == sorted([*whole, ("cut.warc.gz", len(good), "short")])
    assert [r["payload"] == b"x" * 5000 for r in rows if not r["error"]] == [True] * 6
    entries = spark.createDataFrame([("cut.warc.gz", 0, len(good)), ("cut.warc.gz", 0, len(good) - 30), ("cut.warc.gz", 7, 50), ("gone.warc.gz", 0, 9),
                                     (None, 0, 9), ("cut.warc.gz", 10 ** 9, 9), ("cut.warc.gz", 0, 0)], "filename string, offset bigint, length bigint")
    errors = sorted((r["filename"] or "", r["offset"], r["length"], r["error"]) for r in archives.read_index(entries, str(path), 2).collect())
    assert errors == sorted([("cut.warc.gz", 0, len(good), ""), ("cut.warc.gz", 0, len(good) - 30, "short"), ("cut.warc.gz", 7, 50, "header"),
                             ("gone.warc.gz", 0, 9, "missing"), ("", 0, 9, "header"), ("cut.warc.gz", 10 ** 9, 9, "short"), ("cut.warc.gz", 0, 0, "header")])
    empty = tmp_path / "empty"
    empty.mkdir()
    assert archives.scan(spark, str(empty)).count() == 0


@given(st.lists(st.binary(max_size=300), max_size=5), st.integers(1, 50))
@settings(max_examples=100, deadline=None)
def test_members_do_not_depend_on_the_pieces(bodies, size):
    raw = b"".join(gzip.compress(b) for b in bodies)
    found = list(archives.members(raw[i:i + size] for i in range(0, len(raw), size)))
    assert [(f[2], f[3]) for f in found] == [(b, "") for b in bodies]
    assert [gzip.decompress(raw[o:o + n]) for o, n, _, _ in found] == bodies and sum(f[1] for f in found) == len(raw)


@given(st.binary(max_size=200), st.lists(st.integers(1, 40), max_size=8))
@settings(max_examples=100, deadline=None)
def test_chunks(body, sizes):
    parts, at = [], 0
    for size in [*sizes, 10 ** 6]:
        if body[at:at + size]:
            parts.append(body[at:at + size])
        at += size
    framed = b"".join(b"%X;ext=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    assert archives.unchunked(framed) == (body, "")
    cut, error = archives.unchunked(framed[:len(framed) // 2])
    assert body.startswith(cut) and (error == "chunk" or cut == body)


def test_bodies():
    def response(headers, body):
        return archives.http_body(b"HTTP/1.1 203 X\r\n" + headers + b"\r\n\r\n" + body)
    assert response(b"Content-Type: Text/HTML; charset=x\r\nContent-Length: 3", b"abcd") == (203, "text/html", b"abc", "")
    assert response(b"Content-Length: 9", b"abcd") == (203, None, b"abcd", "short")
    assert response(b"Content-Encoding: gzip", gzip.compress(b"hi")) == (203, None, b"hi", "")
    assert response(b"Content-Encoding: deflate", zlib.compress(b"hi")) == (203, None, b"hi", "")
    assert response(b"Content-Encoding: gzip", b"hi") == (203, None, b"hi", "encoding")
    assert archives.http_body(b"no response") == (None, None, b"", "header")
