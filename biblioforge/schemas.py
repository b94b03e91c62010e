"""Record layouts and value lists of the catalogue."""

from __future__ import annotations

# Enumerations of the record schema.
LANGUAGES = ["ja", "en", "other"]
PERSPECTIVES = ["law_regulation", "theory", "practice", "case", "trend", "qualification"]
STATUSES = ["draft", "validated", "rejected"]
FORMAT_TYPES = ["hardcover", "paperback", "ebook", "pdf", "epub", "kindle", "audiobook", "online_access", "bundle", "other"]
CURRENCIES = ["JPY", "USD", "EUR", "GBP", "CNY", "KRW", "other"]
REVIEW_ACTIONS = ["KEEP_ORIGINAL", "APPLY_SUGGESTION", "DELETE_FROM_MASTER", "SKIP", "UPDATE_SEGMENT"]

BOOK_V1 = (
    "record_id string, title string, subtitle string, authors array<string>, publisher string, language string, publication_year int, segment string, "
    "subsegment string, perspective string, topics array<string>, isbn_or_issn string, format string, access_type string, audience_level string, "
    "official_status string, pages int, edition string, series string, instrument_or_asset_class string, jurisdiction string, source_url string, "
    "catalog_url string, notes string, related_regulation string, qualification_target string, recommended_for string, data_source string, "
    "dataset_status string, last_reviewed_at string"
)
PRICE = "struct<amount:double,currency:string,price_type:string>"
FORMAT = f"struct<format_type:string,isbn:string,asin:string,price:{PRICE},url:string,url_status:string,url_verified_at:string,availability:string>"
EDITION = f"struct<edition_number:int,edition_label:string,publication_year:int,is_latest:boolean,pages:int,description:string,table_of_contents:array<string>,formats:array<{FORMAT}>>"
BOOK_V2 = (
    "work_id string, title string, subtitle string, authors array<string>, editors array<string>, language string, publisher string, series string, "
    "segment string, subsegment string, perspective string, topics array<string>, instrument_or_asset_class string, jurisdiction string, "
    "audience_level string, official_status string, related_regulation string, qualification_target string, "
    f"editions array<{EDITION}>, notes string, recommended_for string, data_sources array<string>, importance_score double, dataset_status string, "
    "created_at string, updated_at string, last_reviewed_at string"
)
REVIEW = "work_id string, title string, reasons array<string>, details map<string,string>, original_data map<string,string>, suggested_changes map<string,string>, needs_review boolean"
CHANGE = "timestamp string, work_id string, title string, action string, review_reasons array<string>, reason string, before map<string,string>, after map<string,string>"


def _closed(required: list[str], **properties: dict) -> dict:
    return {"type": "object", "required": required, "additionalProperties": False, "properties": properties}


_STRING, _STRINGS = {"type": "string"}, {"type": "array", "items": {"type": "string"}}

# Names, enumerations, patterns and bounds of a work as JSON.
PRICE_SCHEMA = _closed(
    ["amount", "currency"], amount={"type": "number", "minimum": 0}, currency={"type": "string", "enum": ["USD", "JPY", "EUR", "GBP", "CHF", "CAD", "AUD"]}, price_type={"type": "string", "enum": ["list", "sale", "rental"]}
)
FORMAT_SCHEMA = _closed(
    ["format_type"],
    format_type={"type": "string", "enum": ["hardcover", "paperback", "ebook", "pdf", "kindle", "audiobook", "online_access", "bundle", "print_replica", "other"]},
    isbn={"type": "string", "pattern": "^(97[89])?[0-9]{9}[0-9X]$"}, asin={"type": "string", "pattern": "^[A-Z0-9]{10}$"}, price=PRICE_SCHEMA, url={"type": "string", "format": "uri"},
    url_status={"type": "string", "enum": ["valid", "invalid", "redirect", "unchecked"]}, url_verified_at={"type": "string", "format": "date"},
    availability={"type": "string", "enum": ["available", "out_of_stock", "preorder", "discontinued", "unknown"]},
)
EDITION_SCHEMA = _closed(
    ["edition_number", "publication_year", "is_latest", "formats"],
    edition_number={"type": "integer", "minimum": 1}, edition_label=_STRING, publication_year={"type": "integer", "minimum": 1800, "maximum": 2100}, is_latest={"type": "boolean"}, pages={"type": "integer", "minimum": 1},
    description=_STRING, table_of_contents=_STRINGS, formats={"type": "array", "minItems": 1, "items": FORMAT_SCHEMA},
)
WORK_SCHEMA = _closed(
    ["work_id", "title", "language", "publisher", "segment", "subsegment", "perspective", "editions", "dataset_status"],
    work_id={"type": "string", "pattern": "^[a-z0-9_]+$"}, language={"type": "string", "enum": LANGUAGES}, perspective={"type": "string", "enum": PERSPECTIVES}, dataset_status={"type": "string", "enum": STATUSES},
    audience_level={"type": "string", "enum": ["introductory", "intermediate", "advanced", "mixed"]}, official_status={"type": "string", "enum": ["public", "private"]}, importance_score={"type": "number", "minimum": 0, "maximum": 100},
    editions={"type": "array", "minItems": 1, "items": EDITION_SCHEMA}, authors=_STRINGS, editors=_STRINGS, topics=_STRINGS, data_sources=_STRINGS,
    **{c: _STRING for c in "title subtitle publisher series segment subsegment instrument_or_asset_class jurisdiction related_regulation qualification_target notes recommended_for created_at updated_at last_reviewed_at".split()},
)
