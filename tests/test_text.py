"""Text and number functions against plain Python on many values."""

from __future__ import annotations

import random
import sys

from gleanery.functions import text

ALL_SPACE = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def words(seed: int, count: int) -> list[str]:
    draw = random.Random(seed)
    letters = ["a", "Ä", "ß", "z.", "€", "😀", "x-y", ""]
    return [
        "".join(
            draw.choice(letters) if draw.random() < 0.6 else draw.choice(ALL_SPACE)
            for _ in range(draw.randrange(0, 30))
        )
        for _ in range(count)
    ]


def numbers(seed: int, count: int) -> list[float]:
    draw = random.Random(seed)
    fixed = [0.0, -0.0, 1.0, 2.675, 0.005, 1e-10, 1234567.0, 999999.995, -0.001, 1e15, 0.125, 2.5]
    return fixed + [
        round(draw.uniform(-1e6, 1e6), draw.randrange(0, 6)) for _ in range(count)
    ]


def test_collapse_and_strip_like_python(evaluate):
    values = words(1, 500) + [c + "a" + c + "b" + c for c in ALL_SPACE]
    assert evaluate(text.collapse_space, values) == [" ".join(v.split()) for v in values]
    assert evaluate(text.strip_space, values) == [v.strip() for v in values]


def test_strip_field_keeps_separator_controls(evaluate):
    assert evaluate(text.strip_field, ["\x1ca\x1c", " a　", " \n"]) == ["\x1ca\x1c", "a", ""]


def test_dedupe_key_ignores_case_and_spacing(evaluate):
    assert evaluate(text.dedupe_key, ["  Solar\n CREDIT ", None]) == ["solar credit", ""]


def test_truncate(evaluate):
    def expected(value: str) -> str:
        collapsed = " ".join(value.split())
        return collapsed if len(collapsed) <= 10 else collapsed[:9].rstrip() + "…"

    padded = "ab" + " " * 50 + "cdefghijklmnop"
    values = words(2, 400) + [padded, "x" * 10, "x" * 11, "abcdefgh ijk", " " * 100 + "tail"]
    assert evaluate(lambda c: text.truncate(c, 10), values) == [expected(v) for v in values]


def test_sanitize_amount(evaluate):
    out = evaluate(text.sanitize_amount, [None, " \n", " up  to\t$5 ", "x" * 300])
    assert out == [None, None, "up to $5", "x" * 200]


def test_format_amount_number(evaluate):
    def expected(v: float) -> str:
        return f"{int(v):,}" if abs(v - int(v)) < 1e-9 else f"{v:,.2f}"

    values = numbers(3, 2000)
    assert evaluate(text.format_amount_number, values, "double") == [expected(v) for v in values]


def test_format_significant(evaluate):
    values = [v for v in numbers(4, 2000)] + [33.3333333, 80.0, 1e-5, 1.5e7, 99999.95, 0.00012345]
    values += [float("nan"), float("inf"), float("-inf")]
    assert evaluate(text.format_significant, values, "double") == [
        "0" if v == 0 else f"{v:g}" for v in values
    ]


def test_round_seconds(evaluate):
    values = [2.675, 0.125, 0.375, 1.005, 12345.678, 0.0]
    assert evaluate(text.round_seconds, values, "double") == [round(v, 2) for v in values]
