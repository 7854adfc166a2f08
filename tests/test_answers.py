"""JSON answers: parsing, hints, lax typing and rejection."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import coercion
from gleanery.operators import answers
from gleanery.plans.build import raw_records, repeated_keys_allowed, run_date_column

HINTS = "source_id long, source_ord long, final_url string, hint struct<url string, level string, state string, county string, city string, utility string>"


def typed(spark, *programs, final_url="https://x.org/final", hint=None):
    source = {"url": "https://x.org", "level": "city", "state": "FL", "county": "", "city": "Tampa", "utility": ""}
    hints = spark.createDataFrame(
        [(1, 0, final_url, tuple({**source, **(hint or {})}.values()))], HINTS
    )
    payload = json.dumps({"programs": list(programs)})
    given = spark.createDataFrame([(1, 0, payload)], "source_id long, first_pos long, payload string")
    return raw_records(given, hints, run_date_column("2026-02-01"))


def test_hints_fill_and_invalid_entries_drop(spark):
    rows = typed(
        spark,
        {"program_name": " Roof Grant ", "type": "grant", "amount_value": 10000, "confidence_score": 0.78},
        {"type": "grant", "amount_value": 1000},
        "text",
        None,
    )
    (kept,) = answers.accepted(rows).collect()
    assert (kept.program_name, kept.source_url) == ("Roof Grant", "https://x.org/final")
    assert (kept.level, kept.state, kept.city, kept.rec_ord) == ("city", "FL", "Tampa", 0)
    assert (kept.last_verified_at, kept.extraction_source, kept.active) == ("2026-02-01", "llm", True)
    (dropped,) = answers.rejected(rows).collect()
    assert dropped.reject_reasons == ["program_name"]


def test_absent_and_falsy_are_told_apart(spark):
    rows = typed(
        spark,
        {"program_name": "a", "level": None, "state": None, "city": None},
        {"program_name": "b", "city": "  "},
        {"program_name": "c", "city": 0, "county": ""},
        {"program_name": "d", "city": []},
        {"program_name": "e", "city": 5},
        {"program_name": "f", "source_url": ""},
        {"program_name": "g", "source_url": None},
        {"program_name": "h", "active": None},
        final_url="",
    )
    found = {r.program_name: r for r in rows.collect()}
    assert (found["a"].level, found["a"].state, found["a"].city) == (None, None, "Tampa")
    assert found["a"].source_url == "https://x.org"
    assert found["b"].city == ""
    assert (found["c"].city, found["c"].county) == ("Tampa", "")
    assert found["d"].city == "Tampa"
    assert found["f"].source_url == ""
    rejects = {n: r.reject_reasons for n, r in found.items() if r.reject_reasons}
    assert rejects == {"e": ["city"], "g": ["source_url"], "h": ["active"]}


def test_unknown_hint_level_rejects(spark):
    rows = typed(spark, {"program_name": "a"}, {"program_name": "b", "level": "state"}, hint={"level": "moon"})
    assert {r.program_name: r.reject_reasons for r in rows.collect()} == {"a": ["level"], "b": []}


VALUES = [
    1, 0, 2, 1.0, 0.0, 0.5, -1, True, False, "", "a", " a ", "1", "0", "on", "OFF", "Yes", "n", "t",
    " true ", " 10 ", "1,000", "1_000", "_1", "1e3", ".5", "5.", "+2", "0x10", "1d", "inf", "NaN",
    "-Infinity", [], ["a", " b "], ["a", None], ["a", 1], {}, {"a": 1}, None, 12345678901234567890,
    "rebate", "Rebate", " rebate", "federal", 1e300,
]


def test_lax_typing_like_the_typed_model_library(spark):
    pydantic = pytest.importorskip("pydantic")
    from typing import Optional

    class Model(pydantic.BaseModel):
        model_config = pydantic.ConfigDict(str_strip_whitespace=True)
        s: Optional[str] = None
        d: Optional[float] = None
        b: Optional[bool] = None

    class Lists(pydantic.BaseModel):
        model_config = pydantic.ConfigDict(str_strip_whitespace=True)
        x: list[str] = []

    def expect(model, name, value):
        try:
            return True, getattr(model.model_validate({name: value}), name)
        except pydantic.ValidationError:
            return False, None

    df = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(VALUES)], "i int, j string")
    value = F.try_variant_get(coercion.parse_json(F.col("j")), "$.v", "variant")
    readers = {
        "s": coercion.read_string,
        "d": coercion.read_double,
        "b": coercion.read_boolean,
        "x": coercion.read_strings,
    }
    for name, reader in readers.items():
        got = reader(value, coercion.kind(value))
        if name == "x":
            got = F.when(coercion.is_missing(value), F.array().cast("array<string>")).otherwise(got)
        ok = coercion.is_missing(value) | got.isNotNull()
        rows = df.select("i", got.alias("got"), ok.alias("ok")).orderBy("i").collect()
        for row, given in zip(rows, VALUES):
            given = [] if name == "x" and given is None else given
            valid, wanted = expect(Lists if name == "x" else Model, name, given)
            assert row.ok == valid, (name, given)
            if valid:
                assert row.got == wanted or wanted != wanted, (name, given)


def test_only_whole_json_is_read(evaluate):
    good = ['{"a":1}', ' {"a":1} \n', "[]", "null", "", None, '"x"']
    bad = ["{", '{"a":1} x', '{"a":1},{"b":2}', "]", '{"a":1}] [', "  ", "{'a':1}", '{"a":1}, 7']
    read = evaluate(lambda c: coercion.parse_json(c).isNotNull(), good + bad)
    assert read == [True] * len(good) + [False] * len(bad)


def test_bare_nan_and_infinity_are_numbers(spark):
    body = (
        '{"programs":[{"program_name":"NaN \\" Infinity","amount_value":NaN,"amount_max":-Infinity,'
        '"income_limit_pct_ami":Infinity},{"program_name":NaN},{"program_name":"x","confidence_score":NaN}]}'
    )
    assert json.loads(body)["programs"][0]["program_name"] == 'NaN " Infinity'
    hints = spark.createDataFrame([(1, 0, "u", ("u", "city", "FL", "", "", ""))], HINTS)
    given = spark.createDataFrame([(1, 0, body)], "source_id long, first_pos long, payload string")
    first, second, third = raw_records(given, hints, run_date_column("2026-02-01")).orderBy("rec_ord").collect()
    assert first.program_name == 'NaN " Infinity' and first.reject_reasons == []
    assert first.amount_value != first.amount_value
    assert (first.amount_max, first.income_limit_pct_ami) == (float("-inf"), float("inf"))
    assert second.reject_reasons == ["program_name"]
    assert third.reject_reasons == ["confidence_score"]


def test_last_of_repeated_keys_wins(spark):
    given = spark.createDataFrame([('{"programs":[],"programs":[{"a":1,"a":2}]}',)], "payload string")
    with repeated_keys_allowed(spark):
        (row,) = answers.explode_programs(given, keep=[]).selectExpr("variant_get(entry, '$.a', 'int') a").collect()
    assert row.a == 2


def test_payloads_without_a_list_give_no_rows(spark):
    payloads = ["[1]", '{"programs": {"a": 1}}', '{"programs": null}', "{}", "", "oops", '{"programs": "x"}']
    given = spark.createDataFrame([(p,) for p in payloads], "payload string")
    assert answers.explode_programs(given, keep=[]).count() == 0


def test_confidence_bounds(spark):
    rows = typed(
        spark,
        *[{"program_name": str(c), "confidence_score": c} for c in (0, 1, "0.5", True, 1.01, -0.1, "nan", None)],
    )
    kept = [r.program_name for r in answers.accepted(rows).orderBy("rec_ord").collect()]
    assert kept == ["0", "1", "0.5", "True", "None"]
