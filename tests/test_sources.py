"""File sources on files written into a fresh folder."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from firmweave.operators import extract, load
from firmweave.sources import archive, manifest, page_lines, register_xml, tables


def record(kind: str, uri: str | None, body: bytes) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n" + (f"WARC-Target-URI: {uri}\r\n" if uri else "")
    return head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def http(body: bytes, *fields: str) -> bytes:
    return "\r\n".join(["HTTP/1.1 200 OK", *fields]).encode() + b"\r\n\r\n" + body


RECORDS = [
    record("warcinfo", None, b"software: x"),
    record("request", "http://a.com.au/", b"GET / HTTP/1.1"),
    record("response", "http://a.com.au/", http(b"<title>A</title> text\r\nWARC/1.0\r\n")),
    record("response", "http://b.com.au/", http(b"4\r\n<h1>\r\n6\r\nB</h1>\xff\r\n0\r\n\r\n", "Transfer-Encoding: chunked")),
    record("response", "http://c.com.au/", http(gzip.compress(b"<h1>C</h1>"), "Content-Encoding: gzip")),
    record("response", "http://d.example.org/", http(b"<h1>D</h1>")),
    record("conversion", "http://e.gov.au/", "Plain café".encode()),
]


@pytest.fixture
def archives(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "one.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(gzip.compress(RECORDS[2])))
    (tmp_path / "three.warc").write_bytes(b"".join(RECORDS))
    (tmp_path / "notes.txt").write_text("x")
    return tmp_path


def test_archive_records(spark, archives):
    rows = archive.read_archives(spark, str(archives), uri_contains=".au").collect()
    one = {r.target_uri: r for r in rows if r.file.endswith("one.warc.gz")}
    assert {u: r.payload for u, r in one.items()} == {
        "http://a.com.au/": "<title>A</title> text\r\nWARC/1.0\r\n",
        "http://b.com.au/": "<h1>B</h1>",
        "http://c.com.au/": "<h1>C</h1>",
        "http://e.gov.au/": "Plain café",
    }
    assert one["http://e.gov.au/"].rec_type == "conversion" and one["http://e.gov.au/"].pos == 6
    assert [r.target_uri for r in rows if r.file.endswith("two.warc.gz")] == ["http://a.com.au/"]


def test_plain_archive_and_no_address_filter(spark, archives):
    rows = archive.read_archives(spark, str(archives / "three.warc"), uri_contains=None).collect()
    assert [r.target_uri for r in rows][3] == "http://d.example.org/" and len(rows) == 5


def test_whole_bodies_and_errors_told(spark, tmp_path):
    members = gzip.compress(b"<h1>one") + gzip.compress(b" two</h1>") + b"junk"
    good = record("response", "http://m.com.au/", http(members, "Content-Encoding: gzip"))
    bad = record("response", "http://bad.com.au/", http(b"x")).replace(b"Content-Length: ", b"Content-Length: many ")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(bad) + gzip.compress(good))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(RECORDS[2]) + gzip.compress(good * 50)[:-30])
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(good[:-40]))
    found = archive.read_archives(spark, str(tmp_path))
    pages = [(r.file[-9:], r.target_uri, r.payload) for r in found.where("rec_type <> 'error'").collect()]
    assert ("a.warc.gz", "http://m.com.au/", "<h1>one two</h1>") in pages
    assert ("b.warc.gz", "http://a.com.au/", "<title>A</title> text\r\nWARC/1.0\r\n") in pages
    errors = {r.file[-9:]: r.reason for r in archive.read_errors(found).collect()}
    assert errors["a.warc.gz"].startswith("length 'many") and "bytes" in errors["c.warc.gz"] and "b.warc.gz" in errors


def test_missing_tables_are_told(spark, tmp_path):
    from firmweave.operators.quality import missing_tables

    root = str(tmp_path)
    tables.read_table(spark, root, "crawl")  # an empty view is no table
    assert missing_tables(spark, root, ["crawl", "matches"]) == ["crawl", "matches"]
    tables.write_table(spark.createDataFrame([], tables.TABLES["crawl"]), root, "crawl")
    assert missing_tables(spark, root, ["crawl", "matches"]) == ["matches"]


def test_folder_without_archives(spark, tmp_path):
    with pytest.raises(Exception, match="no .gz files"):
        archive.read_archives(spark, str(tmp_path)).collect()


def test_pages_from_archives(spark, archives):
    rows = extract.extract_pages(archive.read_archives(spark, str(archives))).collect()
    names = {(r.domain, r.company_name) for r in rows if r.file.endswith("one.warc.gz")}
    assert names == {("a.com.au", "A"), ("b.com.au", "B"), ("c.com.au", "C"), ("e.gov.au", None)}
    assert extract.extract_pages(archive.read_archives(spark, str(archives)), max_records=2).count() == 2


XML = """<?xml version="1.0"?><ABRFile>
<ABR><ABN status="Active" ABNStatusFromDate="20010203">00123456789</ABN><EntityType><EntityTypeInd>PRV</EntityTypeInd></EntityType>
<MainEntity><NonIndividualName><NonIndividualNameText> Acme Pty Ltd</NonIndividualNameText></NonIndividualName>
<BusinessAddress><AddressDetails><AddressLine1> 1 Main St </AddressLine1><AddressLine2/><State>VIC</State><Postcode>0800</Postcode></AddressDetails></BusinessAddress>
<LegalAddress><AddressDetails><AddressLine1>legal</AddressLine1></AddressDetails></LegalAddress></MainEntity></ABR>
<ABR><ABN ABNStatus="Cancelled" FromDate="2001-02-03">22222222222</ABN>
<MainEntity><LegalAddress><AddressDetails><AddressLine1>L1</AddressLine1><AddressLine2>L2</AddressLine2></AddressDetails></LegalAddress></MainEntity></ABR>
<ABR><EntityType><EntityTypeInd>IND</EntityTypeInd></EntityType></ABR>
<ABR><ABN status="" ABNStatus="Active">33333333333</ABN></ABR>
</ABRFile>"""


def test_register_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "skip.txt").write_text("x")
    rows = load.registry_rows(register_xml.read_register(spark, str(tmp_path)), keep=("file", "load_order"))
    got = {r.abn: r for r in rows.collect()}
    assert set(got) == {"00123456789", "22222222222", "33333333333"}
    first, second, third = got["00123456789"], got["22222222222"], got["33333333333"]
    assert (first.entity_name, first.entity_status, str(first.start_date)) == (" Acme Pty Ltd", "Active", "2001-02-03")
    assert (first.full_address, first.address_line_2, first.postcode) == ("1 Main St", "", "0800")
    assert (second.entity_status, second.full_address, str(second.start_date)) == ("Cancelled", "L1 L2", "2001-02-03")
    assert (third.entity_status, third.has_address, third.full_address) == ("Active", False, None)
    counted = {r.file is None: (r.records, r.addresses) for r in load.register_counters(rows, "file").collect()}
    assert counted == {True: (3, 2), False: (3, 2)}


def test_one_register_file_is_read_by_many_tasks(spark, tmp_path):
    """Split at elements, with the same rows as the XML reader gives, in the order of the file."""
    rows = [
        f'<ABR recordLastUpdatedDate="20200101" replaced="N"><ABN status="Active" ABNStatusFromDate="20010203">{10**10 + i}</ABN>'
        f"<MainEntity><NonIndividualName><NonIndividualNameText> É &amp; {i} </NonIndividualNameText></NonIndividualName></MainEntity></ABR>"
        for i in range(3000)
    ]
    (tmp_path / "big.xml").write_text('<?xml version="1.0" encoding="UTF-8"?>\n<ABRFile>\n' + "\n".join(rows) + "\n</ABRFile>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = load.registry_rows(register_xml.read_register(spark, str(tmp_path)), keep=("load_order",))
        assert got.rdd.getNumPartitions() > 3
        names = [r.entity_name for r in got.orderBy("load_order").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert names == [f" É & {i} " for i in range(3000)]
    reader = spark.read.format("xml").option("rowTag", "ABR").option("ignoreSurroundingSpaces", "false")
    plain = load.registry_rows(reader.schema(register_xml.schemas.REGISTER_XML).load(str(tmp_path)))
    assert sorted(got.drop("load_order").collect(), key=lambda r: r.abn) == sorted(plain.collect(), key=lambda r: r.abn)


def test_page_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é.com.au", "http://é.com.au", None)], "domain string, url string, company_name string")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("industry", "scraped_abn", "title", "meta_description", "h1", "schema_org_name", "source")])
    out = str(tmp_path / "out")
    page_lines.write_page_lines(df, out)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '"company_name":null' in text and "é.com.au" in text
    assert list(json.loads(text)) == [
        "domain", "url", "company_name", "industry", "scraped_abn", "title", "meta_description", "h1",
        "schema_org_name", "source",
    ]
    assert page_lines.read_page_lines(spark, out).first().url == "http://é.com.au"


def test_bad_lines_are_counted(spark, tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text('{"url": "u1", "title": "T", "extra": 1}\n\n{broken\n{"title": "no url"}\n{"url": ""}\n{"url": "u2"}\n')
    lines = page_lines.read_page_lines(spark, str(path))
    assert tuple(page_lines.line_counters(lines).first()) == (2, 1)
    rows = load.crawl_rows(page_lines.good_lines(lines), keep=("load_order",)).orderBy("load_order").collect()
    assert [(r.website_url, r.html_content_snippet) for r in rows] == [("u1", "Title: T"), ("u2", None)]


def test_manifest_and_landing(spark, tmp_path):
    listing = tmp_path / "shards.txt"
    listing.write_text("crawl/a/1.gz\n\n  crawl/b/1.gz \ncrawl/c/1.gz\nflat.gz\n")
    landed = tmp_path / "landed"
    for name, size in (("crawl/a/1.gz", 1_000_001), ("crawl/b/1.gz", 10), ("flat.gz", 2_000_000)):
        target = landed / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"x" * size)
    shards = manifest.read_shard_paths(spark, str(listing))
    assert [r.shard_path for r in shards.orderBy("position").collect()] == ["crawl/a/1.gz", "crawl/b/1.gz", "crawl/c/1.gz", "flat.gz"]
    assert manifest.read_shard_paths(spark, str(listing), first=2).count() == 2
    state = manifest.reconcile(shards, manifest.landed_files(spark, str(landed)))
    assert {r.shard_path: r.status for r in state.collect()} == {
        "crawl/a/1.gz": "landed", "crawl/b/1.gz": "too_small", "crawl/c/1.gz": "missing", "flat.gz": "landed",
    }
    assert {r.status: r.shards for r in manifest.landing_summary(state).collect()} == {"landed": 2, "missing": 1, "too_small": 1}


def test_tables_can_replace_themselves(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_table(spark, root, "matches").count() == 0
    row = spark.createDataFrame([(1, 2, "a", "llm", None, None, None)], tables.TABLES["matches"])
    tables.write_table(row, root, "matches")
    twice = tables.read_table(spark, root, "matches")
    assert tables.write_table(twice.unionByName(twice), root, "matches").count() == 2


def test_new_lines_are_upserted(spark, tmp_path):
    from firmweave.streaming.incremental_load import load_new_lines

    (tmp_path / "in").mkdir()
    where = [str(tmp_path / name) for name in ("in", "tables", "progress")]
    (tmp_path / "in" / "a.jsonl").write_text('{"url": "u1", "company_name": "A"}\n{bad\n{"url": "u2"}\n')
    load_new_lines(spark, *where).awaitTermination()
    (tmp_path / "in" / "b.jsonl").write_text('{"url": "u1", "company_name": "B"}\n{"url": "u0"}\n{"url": "u1", "company_name": "C"}\n')
    load_new_lines(spark, *where).awaitTermination()
    rows = {r.website_url: (r.id, r.scraped_company_name) for r in tables.read_table(spark, where[1], "crawl").collect()}
    assert rows == {"u1": (1, "C"), "u2": (2, None), "u0": (3, None)}
