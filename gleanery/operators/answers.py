"""From JSON answers to typed raw records, with the reasons of every rejected one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import coercion
from gleanery.functions.text import blank_to_null, has_text, strip_field, strip_space
from gleanery.schema import LIST_COLUMNS, ORDER_COLUMNS, RAW_COLUMNS, RAW_FIELDS, VOCABULARY

#: Raw field -> registry column whose value stands in where the answer's is falsy.
_FALSY_HINTS = {"county": "county", "city": "city", "utility_provider": "utility"}
_NOT_NULL = ["program_name", "source_url", "active"]


def explode_programs(answers: DataFrame, *, keep: list[str]) -> DataFrame:
    """One row per entry of ``$.programs`` that is an object, with its position ``pos``.

    Malformed payloads, payloads that are no object and answers without a list give no
    rows.
    """
    programs = F.try_variant_get(
        coercion.unwrap_json(F.col("wrapped")), "$.programs", "array<variant>"
    )
    # A column of its own, so that each payload is parsed once.
    return (
        answers.withColumn("wrapped", coercion.wrap_json(F.col("payload")))
        .select(*keep, F.posexplode(programs).alias("pos", "entry"))
        .filter(coercion.is_object(F.col("entry")))
    )


def _read(name: str) -> Column:
    """Typed value of a field, null where the answer's value is not accepted."""
    value, value_kind = F.col(f"raw.{name}"), F.col(f"kind.{name}")
    if name in VOCABULARY:
        return coercion.read_word(value, value_kind, VOCABULARY[name])
    kind = RAW_FIELDS[name]
    if kind == T.DoubleType():
        return coercion.read_double(value, value_kind)
    if kind == T.BooleanType():
        return coercion.read_boolean(value, value_kind)
    if name in LIST_COLUMNS:
        return coercion.read_strings(value, value_kind)
    return coercion.read_string(value, value_kind)


def _absent_hints(run_date: Column) -> dict[str, Column]:
    """Stand-ins used only where the key is absent; a null in the answer stays null."""
    return {
        "source_url": F.coalesce(blank_to_null(F.col("final_url")), F.col("hint.url")),
        "last_verified_at": run_date,
        "level": blank_to_null(F.col("hint.level")),
        "state": blank_to_null(F.col("hint.state")),
    }


def _values(names: list[str], run_date: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Typed values with hints in place, and where there was nothing to read."""
    absent = _absent_hints(run_date)
    values, missing = {}, {}
    for name in names:
        value, given = _read(name), F.col(f"raw.{name}")
        nothing = given.isNull() | (F.col(f"kind.{name}") == "VOID")
        if name in absent:
            hint = absent[name]
            known = F.when(hint.isin(*VOCABULARY[name]), hint) if name in VOCABULARY else hint
            value = F.when(given.isNull(), strip_field(known)).otherwise(value)
            nothing = F.when(given.isNull(), hint.isNull()).otherwise(nothing)
        elif name in _FALSY_HINTS:
            hint = F.col(f"hint.{_FALSY_HINTS[name]}")
            use = coercion.is_falsy(given, F.col(f"kind.{name}")) & has_text(hint)
            value = F.when(use, strip_field(hint)).otherwise(value)
        elif name == "active":
            value = F.when(given.isNull(), F.lit(True)).otherwise(value)
        elif name == "program_name":
            value = strip_space(value)
        values[name], missing[name] = value, nothing
    return values, missing


def _fault(name: str) -> Column:
    """Whether a field of the typed record must reject it."""
    value = F.col(name)
    if name in _NOT_NULL:
        fault = value.isNull()
        return fault | (value == "") if name == "program_name" else fault
    unread = value.isNull() & ~F.col(f"missing.{name}")
    # NaN sorts above every number, so it fails the upper bound as it should.
    return unread | ~value.between(0.0, 1.0) if name == "confidence_score" else unread


def type_records(entries: DataFrame, run_date: Column) -> DataFrame:
    """Typed raw records with ``reject_reasons``, empty for the ones to keep.

    Expects ``entry`` (an object VARIANT), ``final_url`` and ``hint``, a struct with the
    source's url, level, state, county, city and utility.
    """
    names = [n for n in RAW_COLUMNS if n != "extraction_source"]
    keep = [c for c in entries.columns if c not in ("entry", "hint")]
    # One pass over the object's keys; missing ones give null, JSON null stays a value.
    fields = ", ".join(f"{n}: variant" for n in names)
    raw = F.try_variant_get("entry", "$", f"struct<{fields}>")
    kinds = F.struct(*[coercion.kind(F.col(f"raw.{n}")).alias(n) for n in names])
    values, missing = _values(names, run_date)
    typed = (
        entries.withColumn("raw", raw)
        .withColumn("kind", kinds)
        .select(
            *keep,
            *[values[n].alias(n) for n in names],
            F.struct(*[missing[n].alias(n) for n in names]).alias("missing"),
        )
    )
    reasons = F.array_compact(F.array(*[F.when(_fault(n), F.lit(n)) for n in names]))
    lists = {
        n: F.coalesce(n, F.array().cast(RAW_FIELDS[n])).alias(n) for n in LIST_COLUMNS
    }
    return typed.select(
        *keep,
        *[lists.get(n, F.col(n)) for n in names],
        F.lit("llm").alias("extraction_source"),
        reasons.alias("reject_reasons"),
    )


def append_records(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Batches of raw records one after another, in the columns of the first."""
    for batch in more:
        first = first.unionByName(batch.select(*first.columns))
    return first


def accepted(typed: DataFrame) -> DataFrame:
    """Raw records without a reason to reject them.

    Meant for typed records that have been written: pushed below their typing, the filter
    would do it twice.
    """
    return typed.filter(F.size("reject_reasons") == 0).drop("reject_reasons")


def rejected(typed: DataFrame) -> DataFrame:
    """The other records: their place, name and reasons."""
    return typed.filter(F.size("reject_reasons") > 0).select(
        *[c for c in [*ORDER_COLUMNS, "source_id"] if c in typed.columns],
        "program_name",
        "reject_reasons",
    )


def conform_records(records: DataFrame) -> DataFrame:
    """Give already typed records the shape of ingested ones: trimmed, lists never null."""
    shaped = {}
    for name, kind in RAW_FIELDS.items():
        column = F.col(name) if name in records.columns else F.lit(None).cast(kind)
        if name == "state" and name not in records.columns:
            column = F.lit("FL")
        if name == "active":
            column = F.coalesce(column, F.lit(True))
        elif name == "extraction_source":
            column = F.coalesce(column, F.lit("unknown"))
        elif name in LIST_COLUMNS:
            column = F.transform(
                F.coalesce(column, F.array().cast(kind)), lambda item: strip_field(item)
            )
        elif name == "program_name":
            column = strip_space(column)
        elif kind == T.StringType() and name not in VOCABULARY:
            column = strip_field(column)
        shaped[name] = column
    others = [c for c in records.columns if c not in RAW_FIELDS]
    return records.select(*others, *[c.alias(n) for n, c in shaped.items()])
