"""Fixed schemas of the staging tables, the mart and the file sources."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


TEXT = T.StringType()
CONFIDENCE = T.DecimalType(3, 2)

REGISTRY = _struct(
    ("abn", TEXT),
    ("entity_name", TEXT),
    ("entity_type", TEXT),
    ("entity_status", TEXT),
    ("address_line_1", TEXT),
    ("address_line_2", TEXT),
    ("postcode", TEXT),
    ("state", TEXT),
    ("full_address", TEXT),
    ("start_date", T.DateType()),
    ("loaded_at", T.TimestampType()),
)

CRAWL = _struct(
    ("id", T.LongType()),
    ("website_url", TEXT),
    ("scraped_company_name", TEXT),
    ("scraped_industry", TEXT),
    ("scraped_abn", TEXT),
    ("html_content_snippet", TEXT),
    ("warc_file_path", TEXT),
    ("loaded_at", T.TimestampType()),
)

MATCHES = _struct(
    ("match_id", T.LongType()),
    ("cc_id", T.LongType()),
    ("abn", TEXT),
    ("match_method", TEXT),
    ("match_confidence", CONFIDENCE),
    ("match_reasoning", TEXT),
    ("created_at", T.TimestampType()),
)

# A match before it has an id and a time stamp.
MATCH_COLUMNS = ["cc_id", "abn", "match_method", "match_confidence", "match_reasoning"]

COMPANIES = _struct(
    ("company_id", T.LongType()),
    ("abn", TEXT),
    ("company_name", TEXT),
    ("website_url", TEXT),
    ("industry", TEXT),
    ("full_address", TEXT),
    ("state", TEXT),
    ("postcode", TEXT),
    ("entity_type", TEXT),
    ("entity_status", TEXT),
    ("start_date", T.DateType()),
    ("data_source", TEXT),
    ("match_confidence", CONFIDENCE),
    ("created_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

PAGE_ROW = _struct(
    ("domain", TEXT),
    ("url", TEXT),
    ("company_name", TEXT),
    ("industry", TEXT),
    ("scraped_abn", TEXT),
    ("title", TEXT),
    ("meta_description", TEXT),
    ("h1", TEXT),
    ("schema_org_name", TEXT),
    ("source", TEXT),
)

ARCHIVE_RECORD = _struct(
    ("rec_type", TEXT),
    ("target_uri", TEXT),
    ("payload", TEXT),
    ("file", TEXT),
    ("pos", T.LongType()),
)

_ADDRESS = T.StructType(
    [
        T.StructField(
            "AddressDetails",
            _struct(("AddressLine1", TEXT), ("AddressLine2", TEXT), ("State", TEXT), ("Postcode", TEXT)),
        )
    ]
)

# One <ABR> element: text is _VALUE, attributes carry a leading underscore.
REGISTER_XML = _struct(
    (
        "ABN",
        _struct(
            ("_VALUE", TEXT),
            ("_status", TEXT),
            ("_ABNStatus", TEXT),
            ("_ABNStatusFromDate", TEXT),
            ("_ABNStatusFrom", TEXT),
            ("_ABNFromDate", TEXT),
            ("_FromDate", TEXT),
        ),
    ),
    ("EntityType", _struct(("EntityTypeInd", TEXT))),
    (
        "MainEntity",
        _struct(
            ("NonIndividualName", _struct(("NonIndividualNameText", TEXT))),
            ("BusinessAddress", _ADDRESS),
            ("LegalAddress", _ADDRESS),
        ),
    ),
)

MATCH_METHODS = ["direct_abn", "fuzzy_name", "llm", "manual"]
DATA_SOURCES = ["ABR", "CC", "BOTH"]
