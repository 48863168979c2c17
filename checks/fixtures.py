"""Inputs derived from the given tables; the same SQL runs in Spark and DuckDB.

The given tables hold no register, no country domain, no business number and no
JSON-LD, so these texts derive them. All rows of the source tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmweave.session import by_shuffle

REGISTRY_FX = """
SELECT CAST(10000000000 + c.c_custkey AS STRING) AS abn,
       CASE WHEN c.c_custkey % 41 = 0 THEN NULL
            ELSE '  ' || p.p_name || ' ' || p.p_brand || ' ' || p.p_type ||
                 CASE c.c_custkey % 4 WHEN 0 THEN ' Pty Ltd' WHEN 1 THEN ' PTY LIMITED'
                                      WHEN 2 THEN ' Ltd.' ELSE '' END || ' ' END AS entity_name,
       c.c_mktsegment AS entity_type,
       CASE WHEN c.c_custkey % 5 = 0 THEN 'Cancelled' ELSE 'Active' END AS entity_status,
       CASE WHEN c.c_custkey % 2 = 0 THEN CAST(c.c_custkey % 900 + 1 AS STRING) || ' Main St' END AS address_line_1,
       CASE c.c_custkey % 7 WHEN 0 THEN '  ' WHEN 1 THEN 'Level 2' END AS address_line_2,
       CAST(800 + c.c_custkey % 9000 AS STRING) AS postcode,
       CASE c.c_nationkey % 8 WHEN 0 THEN 'nsw ' WHEN 1 THEN 'VIC' WHEN 2 THEN 'qld' WHEN 3 THEN 'WA'
            WHEN 4 THEN 'SA' WHEN 5 THEN 'ACT' WHEN 6 THEN '' END AS state,
       CAST('20' || lpad(CAST(c.c_custkey % 24 AS STRING), 2, '0') || '-0' ||
            CAST(c.c_custkey % 9 + 1 AS STRING) || '-1' || CAST(c.c_custkey % 10 AS STRING) AS DATE) AS start_date,
       TIMESTAMP '2025-03-15 00:00:00' AS loaded_at
FROM customer c JOIN part p ON p.p_partkey = c.c_custkey
"""

CRAWL_FX = """
SELECT p_partkey + 1 AS id,
       'https://www.site' || CAST(p_partkey AS STRING) || '.com.au/' AS website_url,
       CASE WHEN p_partkey % 10 = 0 THEN NULL
            WHEN p_partkey % 10 <= 3 THEN ' ' || p_name || ' ' || p_brand || ' ' || p_type || ' Pty Ltd'
            WHEN p_partkey % 10 <= 5 THEN replace(p_name, 'e', '') || ' ' || p_brand || ' ' || p_type
            ELSE 'Unrelated Site ' || CAST(p_partkey AS STRING) END AS scraped_company_name,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE ' ' || lower(p_type) END AS scraped_industry,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(10000000000 + p_partkey AS STRING) END AS scraped_abn,
       'Title: ' || p_name AS html_content_snippet,
       TIMESTAMP '2025-03-16 00:00:00' AS loaded_at
FROM part
"""

MATCHES_FX = """
SELECT c.id AS match_id, c.id AS cc_id, r.abn AS abn,
       CASE WHEN c.scraped_abn IS NOT NULL THEN 'direct_abn'
            WHEN c.id % 10 <= 4 THEN 'fuzzy_name' ELSE 'llm' END AS match_method,
       CAST(CASE WHEN c.scraped_abn IS NOT NULL THEN 0.95
            WHEN c.id % 10 <= 4 THEN 0.82 ELSE 0.70 END AS DECIMAL(3,2)) AS match_confidence,
       'fixture' AS match_reasoning, TIMESTAMP '2025-03-17 00:00:00' AS created_at
FROM crawl_fx c JOIN registry_fx r ON r.abn = CAST(10000000000 + c.id - 1 AS STRING)
WHERE c.scraped_abn IS NOT NULL OR c.id % 10 BETWEEN 2 AND 6
"""

PAGES_FX = """
SELECT page_id,
       CASE WHEN page_id % 5 = 4 THEN url ELSE replace(url, '.example.com', '.example.com.au') END AS url,
       replace(replace(html, '</head>',
         CASE WHEN page_id % 4 = 0 THEN '<meta name="description" content=" About us "><script type="application/ld+json">{"@type":"Organization","name":"Org ' || CAST(page_id AS STRING) || ' Pty Ltd","industry":"Retail"}</script></head>'
              ELSE '</head>' END),
         '</article>',
         CASE page_id % 6 WHEN 0 THEN '<p>ABN: 12 345 678 901</p></article>'
              WHEN 1 THEN '<p>A.B.N. 98765432109</p></article>'
              WHEN 2 THEN '<p>Australian Business Number: 11' || chr(160) || '222' || chr(160) || '333' || chr(160) || '444</p></article>'
              ELSE '</article>' END) AS html
FROM pages
"""

# Register rows that replace old ones (even numbers) or are new, each sent twice.
INCOMING_REGISTRY_FX = """
SELECT CAST(10000000000 + 2 * c.c_custkey AS STRING) AS abn,
       c.c_name || ' v' || CAST(c.v AS STRING) AS entity_name,
       c.c_mktsegment AS entity_type, 'Active' AS entity_status,
       CAST(NULL AS STRING) AS address_line_1, CAST(NULL AS STRING) AS address_line_2,
       '2000' AS postcode, 'NSW' AS state, DATE '2024-01-01' AS start_date,
       c.v AS seq
FROM (SELECT *, 0 AS v FROM customer UNION ALL SELECT *, 1 AS v FROM customer) c
"""

# Crawl rows that refresh old ones or are new, each sent twice.
INCOMING_CRAWL_FX = """
SELECT 'https://www.site' || CAST(2 * p.p_partkey AS STRING) || '.com.au/' AS website_url,
       p.p_name || ' v' || CAST(p.v AS STRING) AS scraped_company_name,
       p.p_type AS scraped_industry, CAST(NULL AS STRING) AS scraped_abn,
       'H1: ' || p.p_brand AS html_content_snippet, p.v AS seq
FROM (SELECT *, 0 AS v FROM part UNION ALL SELECT *, 1 AS v FROM part) p
"""

# Date stamps in the shapes a register file may use.
STAMPS_FX = """
SELECT c_custkey, CASE c_custkey % 9
         WHEN 0 THEN d WHEN 1 THEN d || 'T10:11:12' WHEN 2 THEN d || ' 10:11:12'
         WHEN 3 THEN d || 'T10:11:12.345' WHEN 4 THEN ' ' || replace(d, '-', '') || ' '
         WHEN 5 THEN d || 'junk' WHEN 6 THEN d || 'T10:11:12Z' WHEN 7 THEN '31/12/2001'
         ELSE '2001-02-30' END AS stamp
FROM (SELECT c_custkey, '20' || lpad(CAST(c_custkey % 24 AS STRING), 2, '0') || '-0' ||
        CAST(c_custkey % 9 + 1 AS STRING) || '-1' || CAST(c_custkey % 10 AS STRING) AS d FROM customer) x
"""

# Answers of the assisted tier, good and bad.
ANSWERS_FX = """
SELECT c.id,
       CASE c.id % 8
         WHEN 0 THEN '```json' || chr(10) || '{"matched_abn": "' || CAST(10000000000 + c.id AS STRING) || '", "confidence": 0.9, "reasoning": "same name"}' || chr(10) || '```'
         WHEN 1 THEN 'Sure: {"matched_abn": ' || CAST(10000000000 + c.id AS STRING) || ', "confidence": "0.75"}'
         WHEN 2 THEN '{"matched_abn": null, "confidence": 0.0, "reasoning": "none"}'
         WHEN 3 THEN '{"matched_abn": "no_match", "confidence": 0.9}'
         WHEN 4 THEN '{"matched_abn": "10000000001", "confidence": 0.3}'
         WHEN 5 THEN '{"matched_abn": "10000000002", "confidence": 3}'
         WHEN 6 THEN 'no idea'
         ELSE '{"matched_abn": "10000000003"}' END AS answer,
       CASE c.id % 5
         WHEN 0 THEN '```json {"company_name": "Firm ' || CAST(c.id AS STRING) || '", "industry": "Retail"}```'
         WHEN 1 THEN '{"company_name": null, "industry": "Mining"}'
         WHEN 2 THEN '{"company_name": "Only Name"}'
         WHEN 3 THEN 'not json'
         ELSE '{"company_name": null, "industry": null}' END AS page_answer
FROM crawl_fx c
"""

TEXTS = {
    "registry_fx": REGISTRY_FX,
    "crawl_fx": CRAWL_FX,
    "matches_fx": MATCHES_FX,
    "pages_fx": PAGES_FX,
    "incoming_registry_fx": INCOMING_REGISTRY_FX,
    "incoming_crawl_fx": INCOMING_CRAWL_FX,
    "stamps_fx": STAMPS_FX,
    "answers_fx": ANSWERS_FX,
}

NEEDS = {"matches_fx": ["crawl_fx", "registry_fx"], "answers_fx": ["crawl_fx"]}
# Inputs that join their sources, of which the files of a few columns are far smaller than the rows.
JOINED = ["registry_fx", "matches_fx"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or an input derived from the given tables."""
    if name not in TEXTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sources = {"registry_fx": ["customer", "part"], "crawl_fx": ["part"], "pages_fx": ["pages"]}
    sources |= {"incoming_registry_fx": ["customer"], "incoming_crawl_fx": ["part"]}
    sources |= {"stamps_fx": ["customer"]}
    for source in [*sources.get(name, []), *NEEDS.get(name, [])]:
        rows = load(spark, sf_dir, source)
        (by_shuffle(rows) if name in JOINED else rows).createOrReplaceTempView(source)
    return spark.sql(TEXTS[name])
