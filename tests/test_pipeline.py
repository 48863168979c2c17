"""The whole job on generated files, and the driver contract."""

from __future__ import annotations

import gzip
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from firmweave.plans.run import run_pipeline
from tests.test_sources import http, record

SF = "/root/testdata/sf0.001"


def site(i: int, title: str, body: str = "") -> bytes:
    return record("response", f"http://www.s{i}.com.au/", http(f"<title>{title}</title><p>{body}</p>".encode()))


def entity(abn: int, name: str, status: str = "Active") -> str:
    return (
        f'<ABR><ABN status="{status}" ABNStatusFromDate="20010203">{abn}</ABN><EntityType><EntityTypeInd>PRV</EntityTypeInd>'
        f"</EntityType><MainEntity><NonIndividualName><NonIndividualNameText>{name}</NonIndividualNameText></NonIndividualName>"
        "<BusinessAddress><AddressDetails><State>vic</State><Postcode>3000</Postcode></AddressDetails></BusinessAddress>"
        "</MainEntity></ABR>"
    )


def write_inputs(folder, sites, entities):
    (folder / "in").mkdir()
    (folder / "xml").mkdir()
    (folder / "in" / "a.warc.gz").write_bytes(b"".join(gzip.compress(s) for s in sites))
    (folder / "xml" / "a.xml").write_text(f"<ABRFile>{''.join(entities)}</ABRFile>")


def test_run_pipeline(spark, tmp_path):
    write_inputs(
        tmp_path,
        [
            site(1, "Any", "ABN 11 111 111 111"),
            site(2, "Harbour Bakery"),
            site(3, "Green Fields Dental Clinic"),
            site(4, "Quite Different"),
            site(5, "Closed Firm", "ABN 55 555 555 555"),
            record("response", "http://other.example.org/", http(b"<title>Other</title>")),
        ],
        [
            entity(11111111111, "Acme Pty Ltd"),
            entity(22222222222, "HARBOUR BAKERY PTY LTD"),
            entity(33333333333, "Green Fields Dental Surgery"),
            entity(44444444444, "Nobody Knows"),
            entity(55555555555, "Closed Firm", "Cancelled"),
        ],
    )
    root = str(tmp_path / "tables")
    report = run_pipeline(
        spark, root, archives=str(tmp_path / "in"), register_path=str(tmp_path / "xml"), limits={"llm": 100}
    )
    rows = report.companies.orderBy("company_id").collect()
    got = {(r.abn, r.website_url, r.data_source) for r in rows}
    assert got == {
        ("11111111111", "http://www.s1.com.au/", "BOTH"),
        ("22222222222", "http://www.s2.com.au/", "BOTH"),
        ("33333333333", "http://www.s3.com.au/", "BOTH"),
        ("44444444444", None, "ABR"),
        (None, "http://www.s4.com.au/", "CC"),
    }
    assert [r.company_id for r in rows] == [1, 2, 3, 4, 5]
    statistics = {name: df.collect() for name, df in report.statistics.items()}
    assert {r.match_method: r.matches for r in statistics["matches_by_method"]} == {
        "direct_abn": 2, "fuzzy_name": 1, "llm": 1,
    }
    assert sum(r.companies for r in statistics["companies_by_source"]) == len(rows)
    assert [r.website_url for r in statistics["lost_matches"]] == ["http://www.s5.com.au/"]
    assert {r.failures for r in report.checks.collect()} == {0}
    assert report.missing_tables == [] and report.quarantined.count() == 0

    # A second run with changed pages updates in place and finds no new matches.
    before = {r.website_url: r.id for r in spark.table("crawl").collect()}
    again = run_pipeline(spark, root, archives=str(tmp_path / "in"), register_path=str(tmp_path / "xml"))
    assert {r.website_url: r.id for r in spark.table("crawl").collect()} == before
    assert sum(r.matched for r in again.attempts.collect()) == 0
    assert again.companies.count() == len(rows)


def test_pages_put_to_a_scorer(spark, tmp_path):
    from firmweave.plans.run import extract_to_lines
    from firmweave.sources.page_lines import read_page_lines

    write_inputs(tmp_path, [site(1, "Named"), record("conversion", "http://s2.com.au/", b"plain text only")], [])
    extract_to_lines(
        spark, str(tmp_path / "in"), str(tmp_path / "lines"), scorer=lambda p: '{"company_name": "Told", "industry": null}'
    )
    rows = {r.domain: (r.company_name, r.source) for r in read_page_lines(spark, str(tmp_path / "lines")).collect()}
    assert rows == {"s1.com.au": ("Named", "Schema"), "s2.com.au": ("Told", "LLM")}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_entry_without_the_optional_parts(tmp_path):
    """The contract imports and has all of the library's own queries in a copy without the optional subpackage."""
    root = Path(contract.__file__).parent
    for name in ("firmweave", "checks"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_rows(spark, con, name):
    assert compare(spark, con, SF, name) not in ("rows=0",)
