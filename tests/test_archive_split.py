"""One archive read by many tasks: the same records as one task reads, whatever the ranges."""

from __future__ import annotations

import gzip
import random
import zlib
from collections import Counter

import pytest

from firmweave.sources import archive
from tests.test_sources import http, record


def plain_member(data: bytes, level: int = 6) -> bytes:
    return gzip.compress(data, level)


def rows(df):
    return Counter((r.rec_type, r.target_uri, r.payload) for r in df.collect())


def page(i: int, body: bytes) -> bytes:
    return record("response", f"http://s{i}.com.au/", http(body))


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(1)
    inner = plain_member(page(900, b"inner")) * 3
    bodies = [bytes(rng.randrange(32, 127) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    # False magic bytes, whole archives within payloads, and lines that look like headers.
    bodies += [b"\x1f\x8b\x08" * 40, inner, b"x" + inner + b"y", b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", plain_member(b"WARC/")]
    rng.shuffle(bodies)
    return [page(i, b) for i, b in enumerate(bodies)]


@pytest.mark.parametrize("level", [0, 9])
@pytest.mark.parametrize("split", [97, 1000, 7919])
def test_ranges_give_the_records_of_one_task(spark, tmp_path, pages, level, split):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(plain_member(p, level) for p in pages))
    whole = archive.read_archives(spark, str(tmp_path))
    parts = archive.read_archives(spark, str(tmp_path), split_bytes=split)
    assert whole.rdd.getNumPartitions() == 1 and parts.rdd.getNumPartitions() > 3
    assert rows(whole).total() == len(pages) and rows(parts) == rows(whole)
    for df in (whole, parts):
        assert [r.target_uri for r in df.orderBy("pos").collect()] == [f"http://s{i}.com.au/" for i in range(len(pages))]
    other = archive.read_archives(spark, str(tmp_path), split_bytes=split + 13)
    assert {r.target_uri: r.pos for r in other.collect()} == {r.target_uri: r.pos for r in parts.collect()}


def test_records_over_several_members_and_several_records_in_one(spark, tmp_path, pages):
    data = plain_member(pages[0] + pages[1] + pages[2])
    half = len(pages[3]) // 2
    data += plain_member(pages[3][:half]) + plain_member(pages[3][half:]) + b"".join(plain_member(p) for p in pages[4:30])
    (tmp_path / "a.warc.gz").write_bytes(data)
    whole = rows(archive.read_archives(spark, str(tmp_path)))
    assert whole.total() == 30
    for split in (50, 333, 5000):
        assert rows(archive.read_archives(spark, str(tmp_path), split_bytes=split)) == whole


def test_files_of_another_make_are_read_by_one_task(spark, tmp_path, pages):
    (tmp_path / "once.warc.gz").write_bytes(plain_member(b"".join(pages)))
    (tmp_path / "plain.warc.gz").write_bytes(b"".join(pages))
    (tmp_path / "twice.warc.gz").write_bytes(plain_member(b"".join(plain_member(p) for p in pages)))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    whole = rows(archive.read_archives(spark, str(tmp_path)))
    assert whole.total() == 3 * len(pages)
    assert rows(archive.read_archives(spark, str(tmp_path), split_bytes=400)) == whole


def test_cut_off_file(spark, tmp_path, pages):
    data = b"".join(plain_member(p) for p in pages)
    (tmp_path / "a.warc.gz").write_bytes(data[:-7])
    whole = archive.read_archives(spark, str(tmp_path))
    parts = archive.read_archives(spark, str(tmp_path), split_bytes=2000)
    good = lambda df: rows(df.where("rec_type <> 'error'"))
    assert good(parts) == good(whole) and good(whole).total() >= len(pages) - 1
    assert archive.read_errors(parts).count() == archive.read_errors(whole).count() == 1


def test_members_tell_where_bytes_are_from(tmp_path):
    import io

    a, b = plain_member(b"WARC/1\nab"), plain_member(b"c\nd")
    stream = archive.Members(io.BytesIO(a + b), 0)
    assert stream.member() == 0 and stream.readline() == b"WARC/1\n"
    assert stream.readline() == b"abc\n" and stream.member() == len(a)
    assert stream.read(5) == b"d" and stream.member() == 1 << 62 and stream.readline() == b""
    assert zlib.decompressobj(31).decompress(a) == b"WARC/1\nab"
