"""Goldens for the scalar functions, one or more for each documented quirk."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from firmweave.functions import dates, names, pages, scoring, web
from firmweave.functions.text import strip, unescape
from firmweave.operators import extract, load


def test_canonical_domain_keeps_port_and_user(one):
    urls = [
        "https://www.Acme.com.au/path?x=1", "http://user@www.acme.au:8080/", "acme.com.au/x", None,
        "HTTPS://ACME.NET.AU.", "//acme.org.au/x", "http://www.www.acme.au", "mailto:a@b.au", "http://",
    ]
    assert one(web.canonical_domain, urls) == [
        "acme.com.au", "user@www.acme.au:8080", "", "", "acme.net.au", "acme.org.au", "www.acme.au", "", "",
    ]


def test_country_domain(one):
    domains = ["acme.com.au", "acme.com.au.example.org", "acme.au:80", "acme.com.au:80", "au", "", None, "a.au"]
    assert one(web.is_australian_domain, domains) == [True, True, False, True, False, False, False, True]


def test_business_number_priority_and_spaces(one):
    texts = [
        "ABN: 12 345 678 901",
        "abn:12345678901 more",
        "A.B.N. 11 111 111 111 then ABN 22 222 222 222",
        "Australian Business Number: 33 333 333 333",
        "xABN 123456789012345",
        "ABN 1234",
        "ABN12345678901",
        None,
    ]
    assert one(web.extract_abn, texts) == [
        "12345678901", "12345678901", "22222222222", "33333333333", "12345678901", None, None, None,
    ]


def test_normalize_abn(one):
    assert one(web.normalize_abn, ["12 345 678 901", "1234567890", "123456789012", None, ""]) == [
        "12345678901", None, None, None, None,
    ]


# Legal endings in the order in which they are tried.
ENDINGS = (
    "PTY LTD|PTY. LTD.|PTY LIMITED|LIMITED|LTD|LTD.|INCORPORATED|INC|INC.|PROPRIETARY|PROPRIETARY LIMITED|"
    "CORPORATION|CORP|CORP.|COMPANY|CO|CO.|& CO|&CO"
).split("|")


def plain_normalize(name):
    """The rule of the README in one pass over patterns: endings off the end, then the words that are left."""
    rest = (name or "").upper()
    for ending in ENDINGS:
        rest = re.sub(rf"{re.escape(ending)}\s*\Z|\s+\Z", "", rest.rstrip(), count=1)
    return " ".join(re.findall(r"[^\W_]+", rest))


def test_normalize_name(one):
    known = {
        "COSTCO": "COST", "Zinc": "Z", "Acme Pty. Ltd.": "ACME", "Foo Pty Ltd Limited": "FOO PTY",
        "  x-y,z  inc ": "X Y Z", "Ltd": "", None: "", "École Limited": "ÉCOLE", "A & Co": "A", "Smith &Co": "SMITH",
    }
    assert one(names.normalize_name, list(known)) == list(known.values())
    rnd = random.Random(7)
    parts = ["Acme", "&", "co", "CO.", "Pty", "Ltd", "pty ltd", "Inc.", "limited", ".", "-", " ", " ", "\t", "Ünï", "株式", "12", "\x1f"]
    many = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    assert one(names.normalize_name, many) == [plain_normalize(n) for n in many]


def test_parse_date(one):
    d = dt.date(2001, 2, 3)
    known = {
        "2001-02-03": d, "2001-2-3": d, "2001-02-03T10:11:12": d, "2001-02-03 10:11:12.5": d, "20010203": d,
        "2001-02-03junk": d, "2001-02-03T10:11:12Z": d, " 2001-02-03 ": d, "20010203T1011": d,
        "2024-W01-1": dt.date(2024, 1, 1), "2020W537": dt.date(2021, 1, 3), "2021-W53-1": None,
        "2001-02-30": None, "03/02/2001": None, "": None, None: None, "0000-01-01": None,
    }
    assert one(dates.parse_date, list(known)) == list(known.values())


def test_strip_and_unescape(one):
    assert one(strip, ["  a b\t\n", "", None]) == ["a b", "", None]
    assert one(unescape, ["a &amp; b", "&eacute;&#233;&#xE9;", "&unknown; &", "x&nbsp;y", "&amp;lt;", "&#0;"]) == [
        "a & b", "ééé", "&unknown; &", "x y", "&lt;", "�",
    ]


PAGE = """<!DOCTYPE html><html><head><title> A &amp; B&nbsp;</title>
<META content='d &#8364; > x' name=description><meta name="keywords" content="k">
<script>var h = "<h1>no</h1>";</script><style>p{}</style></head><body><!-- <h1>c</h1> -->
<h1 class="x>y"> He<b> llo</b> w&eacute; </h1><nav>menu</nav>
<p>A.B.N. 12&nbsp;345 678&#160;901 a < b</p></body></html>"""


def page_facts(spark, html):
    df = spark.createDataFrame([("http://www.acme.com.au/", html)], "url string, html string")
    return extract.with_page_fields(df).first()


def test_page_fields(spark):
    row = page_facts(spark, PAGE)
    assert row.title == "A & B"
    assert row.meta_description == "d € > x"
    assert row.h1 == "Hellowé"
    assert "12 345 678 901 a < b" in row.page_text
    assert "var h" not in row.page_text and "p{}" not in row.page_text
    assert row.json_ld_name == "" and row.json_ld_industry == ""


def test_entities_as_browsers_read_them(one):
    texts = ["&check;", "&copy 2020", "&#150;", "&notit; &ampx", "&NotEqualTilde;", "&nope; &x", "&lt&gt", "&#x80;&#159;&#129;"]
    import html

    assert one(unescape, texts[:-1]) == [html.unescape(t) for t in texts[:-1]]
    assert one(unescape, texts[-1:]) == ["€Ÿ\x81"]


def test_custom_elements_are_content(spark):
    row = page_facts(spark, "<style-guide>a</style-guide><h1>Shown</h1><h1-x>n</h1-x><p>ABN 12 345 678 901</p>")
    assert row.h1 == "Shown" and "12 345 678 901" in row.page_text
    df = spark.createDataFrame([("<header-drawer>a</header-drawer><p>b</p><nav>c<p>d</p>",)], "html string")
    assert extract.with_prompt_text(df).first().prompt_text == "a b c d"


def test_json_ld_in_comments_is_not_read(spark):
    old, new = ('<script type="application/ld+json">{"@type":"Organization","name":"%s"}</script>' % n for n in ("Old", "New"))
    assert page_facts(spark, f"<!-- {old} --><h1>H</h1>").json_ld_name == ""
    assert page_facts(spark, f"{new}<!-- {old} -->").json_ld_name == "New"
    assert page_facts(spark, f"<script>x = '<!--';</script>{new}<script>y = '-->';</script>").json_ld_name == "New"


def test_title_needs_one_plain_string(spark):
    assert page_facts(spark, "<title>a<b>c</b></title>").title == ""
    assert page_facts(spark, "<p>none</p>").title == ""


def test_json_ld(spark):
    ended = '{"@graph":[{"@type":"Organization","name":"A"},{"@type":[]},{"@type":"Organization","name":"B"}]}'
    publisher = '{"@type":"Article","publisher":{"@type":"Corporation","name":"P"}}'
    cases = [
        (['{"@type":"Organization","name":"A","industry":"I"}'], ("A", "I")),
        # Later nodes win; a missing name keeps the one before it.
        (
            ['{"@type":"WebSite","name":"A","@graph":[{"@type":["Corporation","X"],"name":"B"},{"@type":"WebSite"}]}'],
            ("B", ""),
        ),
        (['{"@graph":{"@type":"LocalBusiness","name":"G"}}'], ("G", "")),
        # A JSON null is read as no value.
        (['{"@type":"Organization","name":"A","industry":null}'], ("A", None)),
        # Broken blocks and top-level lists are passed over.
        (["{bad", '[{"@type":"Organization","name":"L"}]'], ("", "")),
        # An empty type list ends its own block only.
        ([ended], ("A", "")),
        ([ended, '{"@type":"Organization","name":"C"}'], ("C", "")),
        # The publisher names the company only if nothing else did.
        ([publisher], ("P", "")),
        (['{"@type":"Organization","name":"A"}', publisher], ("A", "")),
        (['{"publisher":{"@type":"Person","name":"P"}}'], ("", "")),
    ]
    pages_in = [
        (i, "".join(f'<script type="application/ld+json">{block}</script>' for block in blocks))
        for i, (blocks, _) in enumerate(cases)
    ]
    rows = extract.with_page_fields(spark.createDataFrame(pages_in, "i int, html string")).orderBy("i").collect()
    assert [(r.json_ld_name, r.json_ld_industry) for r in rows] == [want for _, want in cases]


def test_company_name_chain(spark):
    df = spark.createDataFrame(
        [("J", "H", "T"), ("", "H", "T"), (None, "", " T "), (None, "", "")], "j string, h string, t string"
    )
    got = [r[0] for r in df.select(pages.company_name(F.col("j"), F.col("h"), F.col("t"))).collect()]
    assert got == ["J", "H", "T", ""]


def test_prompt_text_cut_and_boilerplate(spark):
    html = "<header>x</header><nav>y</nav><p> one </p><p>two<br>three</p><footer>z</footer>"
    df = spark.createDataFrame([(html,), ("<p>" + "a" * 20000 + "</p>",)], "html string")
    texts = [r.prompt_text for r in extract.with_prompt_text(df).collect()]
    assert texts[0] == "one two three"
    assert texts[1] == "a" * 20000
    cut = [r.prompt_text for r in extract.with_prompt_text(df, max_chars=15000).collect()]
    assert cut == [texts[0], "a" * 15000 + "..."]


def test_extraction_prompt_only_for_nameless_rows(spark):
    df = spark.createDataFrame(
        [("u1", None, "<p>t</p>"), ("u2", "Acme", "<p>t</p>")], "url string, company_name string, html string"
    )
    rows = {r.url: r.prompt for r in extract.with_extraction_prompt(df).collect()}
    assert rows["u2"] is None
    assert rows["u1"].endswith("URL: u1\n\nTEXT:\nt\n\nJSON:")


def test_extraction_answer(spark):
    df = spark.createDataFrame(
        [
            (1, None, None, "Schema", '```json\n{"company_name": "A", "industry": "I"}\n```'),
            (2, None, "old", "Schema", '{"company_name": null, "industry": "I"}'),
            (3, None, "old", "Schema", "no json"),
            (4, "kept", "old", "Schema", '{"company_name": "B", "industry": "I"}'),
        ],
        "id int, company_name string, industry string, source string, answer string",
    )
    rows = [tuple(r)[:4] for r in extract.apply_extraction_answer(df).orderBy("id").collect()]
    assert rows == [(1, "A", "I", "LLM"), (2, None, "I", "Schema"), (3, None, "old", "Schema"), (4, "kept", "old", "Schema")]


def test_snippet_and_addresses(spark):
    df = spark.createDataFrame([("T", "", "D"), ("", None, "")], "t string, h string, d string")
    got = [r[0] for r in df.select(load.context_snippet(F.col("t"), F.col("h"), F.col("d"))).collect()]
    assert got == ["Title: T | Description: D", None]
    df = spark.createDataFrame([(" 1 Main St ", " "), (None, None), ("a", "b")], "a string, b string")
    got = [r[0] for r in df.select(load.loaded_address(F.col("a"), F.col("b"))).collect()]
    assert got == ["1 Main St", None, "a b"]


def test_confidence_rounds_like_binary_doubles(spark):
    ratios = sorted({2 * m / t for t in range(2, 120) for m in range(1, t // 2 + 1) if 2 * m / t >= 0.85})
    ratios += [0.125, 0.375, 0.625, 0.005, 0.015, 0.3]
    df = spark.createDataFrame([(r,) for r in ratios], "s double")
    rows = df.select(
        "s",
        scoring.two_decimals(F.col("s")).alias("shown"),
        scoring.fuzzy_confidence(F.col("s")).alias("confidence"),
    ).collect()
    for row in rows:
        assert row.shown == f"{row.s:.2f}"
        assert float(row.confidence) == round(min(0.75 + (row.s - 0.85) * 0.5, 0.95), 2)
    assert {r.confidence for r in rows if r.s == 1.0} == {Decimal("0.82")}
