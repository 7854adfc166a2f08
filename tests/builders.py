"""Small records with only the fields a test is about."""

from __future__ import annotations

from pyspark.sql import types as T

from gleanery.schema import ORDER_COLUMNS, RAW_FIELDS, TABLE_COLUMNS

RAW_ROW = T.StructType(
    [T.StructField(c, T.LongType()) for c in ORDER_COLUMNS]
    + [T.StructField(n, kind) for n, kind in RAW_FIELDS.items()]
)
FINAL_ROW = T.StructType(
    [T.StructField(c, T.LongType()) for c in ORDER_COLUMNS]
    + [T.StructField(n, T.StringType()) for n in [*TABLE_COLUMNS, "extraction_source"]]
)

_LISTS = ("eligible_property_types", "eligible_project_types", "zip_codes")
REBATE = {
    "program_name": "Heat pump offer",
    "source_url": "https://power.example.org",
    "type": "rebate",
    "level": "utility",
    "amount_type": "fixed_dollar",
    "amount_value": 200.0,
    "utility_provider": "Bay Power",
    "application_url": "https://power.example.org/apply",
    "eligibility_notes": "Owners only.",
    "requires_homeownership": True,
    "state": "FL",
    "active": True,
}


def raw_frame(spark, *rows):
    """Raw records: ``REBATE`` with each row's own fields on top."""
    full = []
    for i, row in enumerate(rows):
        base = {"source_ord": 0, "rec_ord": i, **{n: [] for n in _LISTS}, **REBATE, **row}
        full.append(tuple(base.get(f.name) for f in RAW_ROW.fields))
    return spark.createDataFrame(full, RAW_ROW)


FINISHED = {
    "program_name": "Offer",
    "state": "FL",
    "city": "Tampa",
    "incentive_type": "Rebates",
    "property_type": "All",
    "description": "d",
    "eligibility_criteria": "e",
    "incentive_amount": "$1",
    "valid_until": "Ongoing",
    "updated_at": "2026-05-04",
    "review_needed": "No",
    "program_links": "https://example.org",
    "extraction_source": "llm",
}


def final_frame(spark, *rows):
    """Finished rows: ``FINISHED`` with each row's own columns on top."""
    full = []
    for i, row in enumerate(rows):
        base = {"source_ord": 0, "rec_ord": i, **FINISHED, **row}
        full.append(tuple(base.get(f.name) for f in FINAL_ROW.fields))
    return spark.createDataFrame(full, FINAL_ROW)
