"""Whitespace, truncation and number formatting as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Unicode White_Space, and what Python's str.split() adds to it ------
WHITE_SPACE = (
    "\t\n\v\f\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SEPARATOR_CONTROLS = "\x1c\x1d\x1e\x1f"
# --- end of fixed values ------------------------------------------------------------

#: The same two sets as a regular expression.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def blank_to_null(c: Column) -> Column:
    """Null for ``''``, the value otherwise."""
    return F.nullif(c, F.lit(""))


def has_text(c: Column) -> Column:
    """True for a non-null, non-empty string; never null."""
    return F.coalesce(c != "", F.lit(False))


def strip_space(c: Column) -> Column:
    """Trim every kind of whitespace, the separator controls included."""
    return F.btrim(c, F.lit(WHITE_SPACE + SEPARATOR_CONTROLS))


def strip_field(c: Column) -> Column:
    """Trim Unicode White_Space only: what typed string fields do on ingestion."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_space(c: Column) -> Column:
    """Trim, and turn every run of whitespace into one space."""
    return F.trim(F.regexp_replace(c, _SPACE_RUN, " "))


def dedupe_key(c: Column) -> Column:
    """Lower-cased, collapsed form; null counts as empty."""
    return collapse_space(F.lower(F.coalesce(c, F.lit(""))))


def truncate(c: Column, limit: int = 600) -> Column:
    """Collapse; beyond ``limit`` characters keep ``limit - 1`` and an ellipsis.

    The start of a long text is enough if it is still too long once collapsed: what
    follows can only lengthen it. Otherwise the whole text is collapsed.
    """
    start = collapse_space(F.substring(c, 1, 2 * limit))
    whole = collapse_space(c)

    def cut(text: Column) -> Column:
        return F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…"))

    return (
        F.when(F.length(start) > limit, cut(start))
        .when(F.length(whole) > limit, cut(whole))
        .otherwise(whole)
    )


def sanitize_amount(c: Column, limit: int = 200) -> Column:
    """Collapsed first ``limit`` characters; null for null and blank."""
    return blank_to_null(F.substring(collapse_space(c), 1, limit))


def is_finite(v: Column) -> Column:
    """True for a number that is neither NaN nor infinite (null counts as finite)."""
    return F.coalesce(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), F.lit(True))


def format_amount_number(v: Column) -> Column:
    """Thousands separators, and two decimals unless within 1e-9 of the integer part."""
    whole = v.try_cast("bigint")
    return (
        # Doubles this large are whole numbers, and beyond what bigint can hold.
        F.when(F.abs(v) >= F.lit(2.0**63), F.format_number(v, 0))
        .when(F.abs(v - whole) < 1e-9, F.format_number(whole, 0))
        .otherwise(F.format_number(v, 2))
    )


def format_significant(v: Column) -> Column:
    """Six significant digits without trailing zeros, exponent form when very large or small."""
    size = F.abs(v)
    # Sizes that six digits round to at least 1e-4 and below 1e6.
    plain = (size >= 9.999995e-05) & (size < 999999.5)
    places = F.greatest(F.lit(0), F.lit(5) - F.floor(F.log10(size)).cast("int"))
    fixed = F.replace(F.call_function("format_number", v, places), F.lit(","), F.lit(""))
    scientific = F.regexp_replace(F.format_string("%.5e", v), r"\.?0+e", "e")
    return (
        F.when(F.isnan(v), F.lit("nan"))
        .when(size == F.lit(float("inf")), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(v == 0, F.lit("0"))
        .when(plain, F.regexp_replace(fixed, r"\.0*$|(?<=\.\d{1,12})0+$", ""))
        .otherwise(scientific)
    )


def round_seconds(v: Column) -> Column:
    """Round half-even on the exact value to two places, as a double."""
    return F.replace(F.format_number(v, 2), F.lit(","), F.lit("")).try_cast("double")


def join_distinct(items: Column, separator: str) -> Column:
    """Distinct items in code-point order, joined."""
    return F.array_join(F.array_sort(F.array_distinct(items)), separator)


def join_present(parts: list[Column], separator: str) -> Column:
    """Join the parts that are neither null nor empty."""
    return F.concat_ws(separator, *[blank_to_null(p) for p in parts])
