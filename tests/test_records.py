"""Duplicates and normalisation of raw records."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanery.operators.dedupe import keep_first
from gleanery.operators.normalise import PlaceDefaults, normalise
from gleanery.schema import TABLE_COLUMNS
from tests.builders import raw_frame

DAY = "2026-02-01"


def one(spark, **fields):
    return normalise(raw_frame(spark, fields), F.lit(DAY)).first()


def test_duplicates_drop_and_the_trusted_copy_stays(spark):
    same = {"program_name": "Clean Energy", "level": "federal", "program_administrator": "IRS"}
    frame = raw_frame(
        spark,
        {**same, "source_ord": 2, "rec_ord": 0, "amount_value": 1.0},
        {**same, "program_name": "CLEAN\n energy", "source_ord": 1, "rec_ord": 9, "amount_value": 2.0},
        {**same, "program_administrator": " irs ", "source_ord": 1, "rec_ord": 7, "amount_value": 3.0},
        {**same, "level": "state"},
        {**same, "level": None, "program_administrator": None},
    )
    kept = keep_first(frame)
    assert kept.columns == frame.columns
    assert kept.filter("level = 'federal'").first().amount_value == 3.0
    assert kept.count() == 3


def test_one_key_holding_most_rows_is_combined_before_the_shuffle(spark):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.lit(0).cast("long").alias("source_ord"),
        F.col("id").alias("rec_ord"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("program_name"),
        F.lit("city").alias("level"),
        F.lit("x").alias("program_administrator"),
    )
    kept = keep_first(rows)
    assert kept.count() == 200_000 - 66_667 + 1
    assert kept.filter("program_name = 'hot'").first().rec_ord == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_utility_rebate(spark):
    row = one(spark)
    assert (row.incentive_type, row.state, row.city) == ("Rebates", "FL", "Bay Power territory")
    assert (row.incentive_amount, row.property_type, row.valid_until) == ("$200", "All", "Ongoing")
    assert (row.review_needed, row.program_links) == ("No", "https://power.example.org/apply")
    assert row.eligibility_criteria == "Owner-occupied required | Owners only."
    assert row.updated_at == DAY


def test_federal_percentage(spark):
    row = one(
        spark, type="tax_credit", level="federal", amount_type="percentage", amount_value=30.0, amount_max=1200.5
    )
    assert (row.state, row.city, row.incentive_amount) == ("USA", "Federal", "30% (up to $1,200.50)")
    assert row.valid_until == "Unknown"
    assert row.review_reasons == ["expiry unknown"]
    assert row.eligibility_criteria.endswith(" [needs review: expiry unknown]")


@pytest.mark.parametrize(
    ("fields", "city"),
    [
        ({"level": "county", "county": "Hillsborough"}, "Hillsborough County"),
        ({"level": "county", "county": "Lake County"}, "Lake County"),
        ({"level": "county"}, "Hillsborough County"),
        ({"level": "city"}, "Tampa"),
        ({"level": "state", "city": "x"}, "Statewide"),
        ({"level": "utility", "utility_provider": None}, "Utility territory"),
        ({"level": None, "county": "Lake"}, "Lake"),
        ({"level": None}, "Statewide"),
    ],
)
def test_city(spark, fields, city):
    assert one(spark, **fields).city == city


def test_place_defaults_are_parameters(spark):
    frame = raw_frame(spark, {"level": "city", "state": None})
    row = normalise(frame, F.lit(DAY), PlaceDefaults(state="GA", city="Macon")).first()
    assert (row.state, row.city) == ("GA", "Macon")


def test_missing_amount_is_a_reason(spark):
    row = one(spark, amount_type=None, amount_value=None)
    assert row.review_needed == "Yes"
    assert row.incentive_amount == "See program page"
    assert "amount unspecified" in row.eligibility_criteria


def test_reasons_in_order(spark):
    row = one(
        spark,
        type=None,
        eligibility_notes=None,
        requires_homeownership=None,
        level="federal",
        amount_value=None,
        application_url=None,
        source_url="",
        confidence_score=0.123,
    )
    assert row.eligibility_criteria == (
        "See program page [needs review: incentive_type unresolved; eligibility unspecified; "
        "amount unspecified; expiry unknown; missing link; low confidence (0.12)]"
    )
    assert row.incentive_type == "Grants"


@pytest.mark.parametrize(
    ("words", "label"),
    [
        ("a TAX-FREE rebate", "Tax Credits"),
        ("Rebate and loan", "Rebates"),
        ("open space grant", "Finance Solutions"),
        ("a grant", "Grants"),
        ("tax credits", "Tax Credits"),
    ],
)
def test_classifier_takes_the_first_hit(spark, words, label):
    row = one(spark, type=None, description=words, eligibility_notes=None)
    assert row.incentive_type == label and "incentive_type unresolved" not in row.review_reasons


def test_amount_kinds(spark):
    cases = [
        ({"amount_type": "up_to", "amount_value": 1000.0}, "Up to $1,000"),
        ({"amount_type": "per_unit", "amount_value": 0.5}, "$0.50 per unit"),
        ({"amount_type": "tiered", "amount_text": "see table"}, "see table"),
        ({"amount_type": "tiered"}, "Tiered (see eligibility notes)"),
        ({"amount_type": "fixed_dollar", "amount_value": 0.0}, "$0"),
        ({"amount_type": None, "amount_text": " about $5 "}, "about $5"),
        ({"amount_type": "percentage", "amount_value": 12.345, "amount_max": 0.0}, "12.35%"),
    ]
    rows = normalise(raw_frame(spark, *[c for c, _ in cases]), F.lit(DAY)).orderBy("rec_ord").collect()
    assert [r.incentive_amount for r in rows] == [
        want if want != "12.35%" else f"{12.345:,.2f}%" for _, want in cases
    ]


def test_eligibility_parts(spark):
    row = one(
        spark,
        income_required=True,
        income_limit_pct_ami=120.0,
        eligible_project_types=["roof", "hvac", "roof"],
        zip_codes=["33603", "33602"],
        eligible_property_types=["sfh", "Condo", "sfh"],
        eligibility_notes=None,
        program_administrator="City",
        confidence_score=0.7,
        expires_at="permanent",
    )
    assert row.eligibility_criteria == (
        "Owner-occupied required | Income-qualified (≤ 120% AMI) | Eligible projects: hvac, roof"
        " | ZIP codes: 33602, 33603 | Administered by: City"
    )
    assert (row.property_type, row.valid_until, row.review_needed) == ("CONDO; SFH", "Ongoing", "No")


def test_records_that_cannot_be_printed_drop(spark):
    nan, inf = float("nan"), float("inf")
    frame = raw_frame(
        spark,
        {"program_name": "nan", "amount_value": nan},
        {"program_name": "inf ceiling", "amount_type": "percentage", "amount_max": inf},
        {"program_name": "tiered", "amount_type": "tiered", "amount_value": nan},
        {"program_name": "unused ceiling", "amount_max": nan},
        {"program_name": "bad link", "application_url": "https://[x/"},
        {"program_name": "good first", "source_url": "https://[x/"},
    )
    kept = {r.program_name for r in normalise(frame, F.lit(DAY)).collect()}
    assert kept == {"tiered", "unused ceiling", "good first"}


def test_columns(spark):
    frame = normalise(raw_frame(spark, {}), F.lit(DAY))
    assert [c for c in frame.columns if c in TABLE_COLUMNS] == TABLE_COLUMNS
