"""Typed reading of JSON values with lax rules, as Column functions over VARIANT.

Each reader gives null for a value it does not accept, and for a missing key and JSON
null; ``is_missing`` tells these apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import strip_field

# --- fixed values: texts read as booleans --------------------------------------------
TRUE_TEXTS = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXTS = ["0", "off", "f", "false", "n", "no"]
# --- end of fixed values ------------------------------------------------------------

_NUMBER_KIND = r"^(BIGINT|DOUBLE|DECIMAL.*|FLOAT)$"
_DIGITS = r"[0-9]+(?:_[0-9]+)*+"
_NUMBER_TEXT = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)$"
)
_SENTINEL = "end-of-answer-3f9d0c"
_NAN_KEY = "not-a-number-3f9d0c"


def _without_bare_numbers(text: Column) -> Column:
    """JSON text with the bare words NaN and Infinity, which strict JSON lacks, rewritten.

    Infinity becomes a number too large for a double; NaN, for which no number stands,
    becomes an object that only ``read_double`` knows. Both are found by walking from one
    match to the next over whole strings, so words inside strings stay.
    """
    string = r'"(?:[^"\\]++|\\.)*+"'
    infinity = F.regexp_replace(text, rf'(?s)\G((?:[^"I]++|{string})*+)Infinity', "$11e999")
    return F.regexp_replace(
        infinity, rf'(?s)\G((?:[^"N]++|{string})*+)NaN', f'$1{{"{_NAN_KEY}":0}}'
    )


def wrap_json(payload: Column) -> Column:
    """The payload parsed as the first of two array items; '' and null count as ``{}``.

    Spark's parser stops at the end of the first value. In an array, trailing text breaks
    the syntax or hides the second item.
    """
    text = F.coalesce(F.nullif(payload, F.lit("")), F.lit("{}"))
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_SENTINEL}"]'))
    bare = F.when(F.rlike(wrapped, F.lit("NaN|Infinity")), _without_bare_numbers(wrapped))
    return F.coalesce(F.try_parse_json(wrapped), F.try_parse_json(bare))


def unwrap_json(wrapped: Column) -> Column:
    """The payload as VARIANT, null unless its whole text was one JSON value."""
    second = F.try_variant_get(wrapped, "$[1]", "string")
    third = F.try_variant_get(wrapped, "$[2]", "variant")
    return F.when(
        (second == _SENTINEL) & third.isNull(), F.try_variant_get(wrapped, "$[0]", "variant")
    )


def parse_json(payload: Column) -> Column:
    return unwrap_json(wrap_json(payload))


def kind(value: Column) -> Column:
    """Type name of a VARIANT value; VOID for JSON null, SQL null for a missing key."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    """True for JSON objects, the stand-in for NaN not among them."""
    # Looked up in the object: its kind would name every field.
    shape = F.try_variant_get(value, "$", f"struct<`{_NAN_KEY}`: variant>")
    return shape.isNotNull() & shape.getField(_NAN_KEY).isNull()


def is_missing(value: Column) -> Column:
    """True for a missing key and for JSON null."""
    return value.isNull() | F.is_variant_null(value)


def is_falsy(value: Column, value_kind: Column) -> Column:
    """True for missing, null, '', zero, false, and empty lists and objects."""
    items = F.try_variant_get(value, "$", "array<variant>")
    return (
        F.when(is_missing(value), F.lit(True))
        .when(value_kind == "STRING", F.try_variant_get(value, "$", "string") == "")
        .when(value_kind == "BOOLEAN", ~F.try_variant_get(value, "$", "boolean"))
        .when(
            F.rlike(value_kind, F.lit(_NUMBER_KIND)), F.try_variant_get(value, "$", "double") == 0
        )
        .when(F.startswith(value_kind, F.lit("ARRAY")), F.size(items) == 0)
        .otherwise(value_kind == "OBJECT<>")
    )


def read_string(value: Column, value_kind: Column) -> Column:
    """Strings only, trimmed."""
    return F.when(value_kind == "STRING", strip_field(F.try_variant_get(value, "$", "string")))


def read_word(value: Column, value_kind: Column, words: list[str]) -> Column:
    """Exactly one of the words."""
    text = F.try_variant_get(value, "$", "string")
    return F.when((value_kind == "STRING") & text.isin(*words), text)


def read_double(value: Column, value_kind: Column) -> Column:
    """Numbers, booleans as 1 and 0, and strings holding a number."""
    text = strip_field(F.try_variant_get(value, "$", "string"))
    return (
        F.when(
            F.rlike(value_kind, F.lit(_NUMBER_KIND)), F.try_variant_get(value, "$", "double")
        )
        .when(F.startswith(value_kind, F.lit(f"OBJECT<`{_NAN_KEY}`")), F.lit(float("nan")))
        .when(
            value_kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")
        )
        .when(
            (value_kind == "STRING") & F.rlike(text, F.lit(_NUMBER_TEXT)),
            F.replace(text, F.lit("_"), F.lit("")).try_cast("double"),
        )
    )


def read_boolean(value: Column, value_kind: Column) -> Column:
    """Booleans, the numbers 0 and 1, and the usual words in any case, untrimmed."""
    number = F.try_variant_get(value, "$", "double")
    word = F.lower(F.try_variant_get(value, "$", "string"))
    return (
        F.when(value_kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(
            F.rlike(value_kind, F.lit(_NUMBER_KIND)),
            F.when(number == 1, F.lit(True)).when(number == 0, F.lit(False)),
        )
        .when(
            value_kind == "STRING",
            F.when(word.isin(*TRUE_TEXTS), F.lit(True)).when(
                word.isin(*FALSE_TEXTS), F.lit(False)
            ),
        )
    )


def read_strings(value: Column, value_kind: Column) -> Column:
    """Lists holding only strings, each trimmed."""
    items = F.try_variant_get(value, "$", "array<variant>")
    only_strings = F.forall(items, lambda item: F.schema_of_variant(item) == "STRING")
    texts = F.transform(items, lambda item: strip_field(F.try_variant_get(item, "$", "string")))
    return F.when(F.startswith(value_kind, F.lit("ARRAY")) & only_strings, texts)
