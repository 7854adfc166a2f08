"""Raw records to the twelve-column table, with the reasons for review."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import (
    blank_to_null,
    format_amount_number,
    format_significant,
    has_text,
    is_finite,
    join_distinct,
    join_present,
    strip_field,
    strip_space,
    truncate,
)
from gleanery.functions.urls import link_is_unreadable, resolve_link
from gleanery.schema import (
    ORDER_COLUMNS,
    PROVENANCE_COLUMN,
    TABLE_COLUMNS,
    TYPE_TO_INCENTIVE,
)

# --- fixed values: texts of the table and the words the classifier looks for ----------
SEE_PAGE = "See program page"
EVERGREEN = ["ongoing", "permanent", "indefinite", "evergreen"]
TYPE_KEYWORDS = [
    ("Tax Credits", ["tax credit", "tax exemption", "tax-free"]),
    ("Rebates", ["rebate"]),
    ("Finance Solutions", ["loan", "financing", "pace"]),
    ("Grants", ["grant"]),
]
LOW_CONFIDENCE = 0.7
DEFAULT_STATE = "FL"
DEFAULT_COUNTY = "Hillsborough County"
DEFAULT_CITY = "Tampa"
DEFAULT_UTILITY = "Utility"
FEDERAL_STATE = "USA"
FEDERAL_CITY = "Federal"
STATEWIDE = "Statewide"
TERRITORY = " territory"
TIERED = "Tiered (see eligibility notes)"
UNRESOLVED_TYPE = "incentive_type unresolved"
UNSPECIFIED_ELIGIBILITY = "eligibility unspecified"
UNSPECIFIED_AMOUNT = "amount unspecified"
UNKNOWN_EXPIRY = "expiry unknown"
MISSING_LINK = "missing link"
LOW_CONFIDENCE_IS = "low confidence ("
REVIEW_SUFFIX = " [needs review: "
# --- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class PlaceDefaults:
    """Names used where a record or its source leaves the place open."""

    state: str = DEFAULT_STATE
    county: str = DEFAULT_COUNTY
    city: str = DEFAULT_CITY
    utility: str = DEFAULT_UTILITY


def amount_text() -> Column:
    """Readable amount, '' if there is none."""
    kind, text = F.col("amount_type"), F.col("amount_text")
    value = format_amount_number(F.col("amount_value"))
    ceiling = F.when(
        F.coalesce(F.col("amount_max") != 0, F.lit(False)),
        F.concat(F.lit(" (up to $"), format_amount_number(F.col("amount_max")), F.lit(")")),
    ).otherwise(F.lit(""))
    structured = (
        F.when(kind == "percentage", F.concat(value, F.lit("%"), ceiling))
        .when(kind == "fixed_dollar", F.concat(F.lit("$"), value))
        .when(kind == "up_to", F.concat(F.lit("Up to $"), value))
        .when(kind == "per_unit", F.concat(F.lit("$"), value, F.lit(" per unit")))
        .when(
            kind == "tiered", F.coalesce(blank_to_null(text), F.lit(TIERED))
        )
    )
    return F.coalesce(
        F.when(F.col("amount_value").isNotNull(), structured), strip_space(text), F.lit("")
    )


def cannot_normalise() -> Column:
    """True where a figure to be printed is NaN or infinite, or the link cannot be read."""
    kind = F.col("amount_type")
    bad_value = kind.isin("percentage", "fixed_dollar", "up_to", "per_unit") & ~is_finite(
        F.col("amount_value")
    )
    bad_ceiling = (
        (kind == "percentage")
        & F.col("amount_value").isNotNull()
        & ~is_finite(F.col("amount_max"))
    )
    unreadable = link_is_unreadable(F.col("application_url"), F.col("source_url"))
    return F.coalesce(bad_value, F.lit(False)) | F.coalesce(bad_ceiling, F.lit(False)) | unreadable


def place(defaults: PlaceDefaults) -> tuple[Column, Column]:
    """State and city columns from the level and the place fields."""
    level = F.col("level")
    home = F.coalesce(F.upper(blank_to_null(F.col("state"))), F.lit(defaults.state))
    state = F.when(level == "federal", F.lit(FEDERAL_STATE)).otherwise(home)
    named = F.coalesce(blank_to_null(F.col("county")), F.lit(defaults.county))
    county = F.when(F.endswith(named, F.lit("County")), named).otherwise(
        F.concat(named, F.lit(" County"))
    )
    provider = F.coalesce(blank_to_null(F.col("utility_provider")), F.lit(defaults.utility))
    city = (
        F.when(level == "federal", F.lit(FEDERAL_CITY))
        .when(level == "state", F.lit(STATEWIDE))
        .when(level == "county", county)
        .when(level == "city", F.coalesce(blank_to_null(F.col("city")), F.lit(defaults.city)))
        .when(level == "utility", F.concat(provider, F.lit(TERRITORY)))
        .otherwise(
            F.coalesce(
                blank_to_null(F.col("city")), blank_to_null(F.col("county")), F.lit(STATEWIDE)
            )
        )
    )
    return state, city


def property_type() -> Column:
    """Upper-cased property types; "All" for an empty list."""
    listed = F.col("eligible_property_types")
    upper = F.transform(
        F.filter(listed, lambda item: item != ""), lambda item: F.upper(strip_space(item))
    )
    return F.when(F.size(listed) > 0, join_distinct(upper, "; ")).otherwise(F.lit("All"))


def eligibility() -> Column:
    """Conditions in a fixed order, '' if there are none."""
    percent = F.col("income_limit_pct_ami")
    income = F.when(
        F.coalesce(percent != 0, F.lit(False)),
        F.concat(F.lit("Income-qualified (≤ "), format_significant(percent), F.lit("% AMI)")),
    ).otherwise(F.lit("Income-qualified"))

    def listing(label: str, column: str) -> Column:
        items = F.col(column)
        return F.when(F.size(items) > 0, F.concat(F.lit(label), join_distinct(items, ", ")))

    administrator = F.col("program_administrator")
    return join_present(
        [
            F.when(F.col("requires_homeownership"), F.lit("Owner-occupied required")),
            F.when(F.col("income_required"), income),
            listing("Eligible projects: ", "eligible_project_types"),
            listing("ZIP codes: ", "zip_codes"),
            strip_space(F.col("eligibility_notes")),
            F.when(
                has_text(administrator), F.concat(F.lit("Administered by: "), administrator)
            ),
        ],
        " | ",
    )


def description() -> Column:
    """Description or notes, shortened; else the name."""
    texts = [blank_to_null(F.col(c)) for c in ("description", "eligibility_notes")]
    return F.coalesce(truncate(F.coalesce(*texts)), F.col("program_name"))


def incentive_type() -> Column:
    """Mapped from the raw type, else from words in the texts; null if neither tells."""
    mapped = F.create_map(*[F.lit(x) for pair in TYPE_TO_INCENTIVE.items() for x in pair])
    texts = [F.coalesce(c, F.lit("")) for c in ("description", "eligibility_notes", "amount_text")]
    lowered = F.lower(F.concat_ws(" ", *texts))
    guess = F.lit(None).cast("string")
    for label, words in reversed(TYPE_KEYWORDS):
        guess = F.when(F.rlike(lowered, F.lit("|".join(words))), F.lit(label)).otherwise(guess)
    return F.coalesce(F.try_element_at(mapped, F.col("type")), guess)


def valid_until() -> tuple[Column, Column]:
    """Expiry text, and whether a federal program leaves it unknown."""
    stated = F.coalesce(strip_space(blank_to_null(F.col("expires_at"))), F.lit("Unknown"))
    federal = F.coalesce(F.col("level") == "federal", F.lit(False))
    unknown = stated == "Unknown"
    evergreen = F.lower(stated).isin(*EVERGREEN) | (unknown & ~federal)
    return F.when(evergreen, F.lit("Ongoing")).otherwise(stated), unknown & federal


def updated_at(run_date: Column) -> Column:
    return F.coalesce(blank_to_null(F.col("last_verified_at")), run_date)


def normalise(
    records: DataFrame, run_date: Column, defaults: PlaceDefaults = PlaceDefaults()
) -> DataFrame:
    """Twelve table columns, provenance and ``review_reasons``, in place of the raw fields.

    Records that cannot be normalised are dropped.
    """
    state, city = place(defaults)
    expiry, expiry_unknown = valid_until()
    staged = records.filter(~cannot_normalise()).select(
        *[c for c in ORDER_COLUMNS if c in records.columns],
        "program_name",
        state.alias("state"),
        city.alias("city"),
        incentive_type().alias("known_type"),
        property_type().alias("property_type"),
        description().alias("description"),
        blank_to_null(eligibility()).alias("conditions"),
        blank_to_null(amount_text()).alias("amount"),
        expiry.alias("valid_until"),
        expiry_unknown.alias("expiry_unknown"),
        updated_at(run_date).alias("updated_at"),
        resolve_link(F.col("application_url"), F.col("source_url")).alias("program_links"),
        F.col("confidence_score").alias("confidence"),
        F.coalesce(blank_to_null(F.col(PROVENANCE_COLUMN)), F.lit("unknown")).alias(
            PROVENANCE_COLUMN
        ),
    )
    conditions = F.coalesce("conditions", F.lit(SEE_PAGE))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("known_type").isNull(), F.lit(UNRESOLVED_TYPE)),
            F.when(conditions == SEE_PAGE, F.lit(UNSPECIFIED_ELIGIBILITY)),
            F.when(F.col("amount").isNull(), F.lit(UNSPECIFIED_AMOUNT)),
            F.when(F.col("expiry_unknown"), F.lit(UNKNOWN_EXPIRY)),
            F.when(F.col("program_links") == "", F.lit(MISSING_LINK)),
            F.when(
                F.col("confidence") < LOW_CONFIDENCE,
                F.concat(
                    F.lit(LOW_CONFIDENCE_IS), F.format_number("confidence", 2), F.lit(")")
                ),
            ),
        )
    )
    flagged = F.size("review_reasons") > 0
    criteria = F.when(
        flagged,
        F.concat(
            conditions,
            F.lit(REVIEW_SUFFIX),
            F.array_join("review_reasons", "; "),
            F.lit("]"),
        ),
    ).otherwise(conditions)
    table = staged.withColumn("review_reasons", reasons).withColumns(
        {
            "incentive_type": F.coalesce("known_type", F.lit("Grants")),
            # The other columns are built from trimmed fields.
            "eligibility_criteria": strip_field(criteria),
            "incentive_amount": F.coalesce("amount", F.lit(SEE_PAGE)),
            "review_needed": F.when(flagged, F.lit("Yes")).otherwise(F.lit("No")),
        }
    )
    return table.select(
        *[c for c in ORDER_COLUMNS if c in records.columns],
        *TABLE_COLUMNS,
        PROVENANCE_COLUMN,
        "review_reasons",
    )
