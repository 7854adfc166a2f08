"""Table layouts and controlled vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: vocabularies and column orders that results must share -----------
LEVELS = ["federal", "state", "county", "city", "utility"]
RAW_TYPES = [
    "tax_credit",
    "grant",
    "rebate",
    "loan",
    "financing",
    "exemption",
    "subsidy",
    "investment",
]
AMOUNT_TYPES = ["fixed_dollar", "percentage", "per_unit", "up_to", "tiered"]
INCENTIVE_TYPES = ["Grants", "Rebates", "Finance Solutions", "Tax Credits", "Investments"]
TYPE_TO_INCENTIVE = {
    "tax_credit": "Tax Credits",
    "exemption": "Tax Credits",
    "grant": "Grants",
    "subsidy": "Grants",
    "rebate": "Rebates",
    "loan": "Finance Solutions",
    "financing": "Finance Solutions",
    "investment": "Investments",
}
TABLE_COLUMNS = [
    "program_name",
    "state",
    "city",
    "incentive_type",
    "property_type",
    "description",
    "eligibility_criteria",
    "incentive_amount",
    "valid_until",
    "updated_at",
    "review_needed",
    "program_links",
]
PROVENANCE_COLUMN = "extraction_source"
REQUIRED_COLUMNS = [
    "program_name",
    "state",
    "city",
    "property_type",
    "description",
    "incentive_amount",
    "program_links",
]
# --- end of fixed values ------------------------------------------------------------

#: Columns giving every record its place: trust order of the source, then position.
ORDER_COLUMNS = ["source_ord", "rec_ord"]

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.LongType()),
        T.StructField("source_ord", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("utility", T.StringType()),
        T.StructField("render", T.StringType()),
        T.StructField("wait_selector", T.StringType()),
        T.StructField("timeout_ms", T.IntegerType()),
    ]
)

#: Values a registry row takes where the column is missing or null.
REGISTRY_DEFAULTS = {
    "state": "FL",
    "county": "",
    "city": "",
    "utility": "",
    "render": "auto",
    "timeout_ms": 45000,
}

CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.LongType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error", T.BooleanType()),
        T.StructField("header_type", T.StringType()),
        T.StructField("static_html", T.StringType()),
        T.StructField("pdf_text", T.StringType()),
        T.StructField("rendered_html", T.StringType()),
        T.StructField("elapsed_s", T.DoubleType()),
    ]
)

ANSWER_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.LongType()),
        T.StructField("first_pos", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)

LINK_STATUS_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error", T.BooleanType()),
    ]
)

_STRINGS = T.ArrayType(T.StringType())

#: The 28 fields of a raw record, in order.
RAW_FIELDS = {
    "program_name": T.StringType(),
    "category": T.StringType(),
    "type": T.StringType(),
    "level": T.StringType(),
    "amount_type": T.StringType(),
    "amount_value": T.DoubleType(),
    "amount_max": T.DoubleType(),
    "amount_text": T.StringType(),
    "eligible_property_types": _STRINGS,
    "eligible_project_types": _STRINGS,
    "zip_codes": _STRINGS,
    "state": T.StringType(),
    "county": T.StringType(),
    "city": T.StringType(),
    "utility_provider": T.StringType(),
    "income_required": T.BooleanType(),
    "income_limit_pct_ami": T.DoubleType(),
    "requires_homeownership": T.BooleanType(),
    "eligibility_notes": T.StringType(),
    "description": T.StringType(),
    "application_url": T.StringType(),
    "program_administrator": T.StringType(),
    "source_url": T.StringType(),
    "expires_at": T.StringType(),
    "last_verified_at": T.StringType(),
    "confidence_score": T.DoubleType(),
    "active": T.BooleanType(),
    "extraction_source": T.StringType(),
}
RAW_COLUMNS = list(RAW_FIELDS)
VOCABULARY = {"type": RAW_TYPES, "level": LEVELS, "amount_type": AMOUNT_TYPES}
LIST_COLUMNS = [name for name, kind in RAW_FIELDS.items() if kind == _STRINGS]

AUDIT_COLUMNS = ["source", "url", "level", "content_type", "text_chars", "records", "elapsed_s"]
