from __future__ import annotations

import itertools
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[NEXT]", "[SAYS]", "[ROLE]", "[/ROLE]", "[SYS]", "<", "[", "\\", "s>", "INST]",
          "ok", " ", "\n", "é人🙂", "/", "$1", "[\\INST]", "<\\\\s>"]


def conversations(seed=2, count=60):
    draw, rows = random.Random(seed), []
    for conv in range(count):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool [SAYS]", "", None])
            text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(12)))
            rows.append((conv, turn, role, draw.choice([text, text, text, None])))
    return rows


def read(spark, rows, columns="conv_id long, turn long, role string, text string"):
    frame = spark.createDataFrame(rows, columns).repartition(4)
    made = chat.format_turns(frame)
    return made.select(
        "*",
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.under_mask(F.col("formatted"), F.col("mask")).alias("learned"),
    ).collect()


def test_round_trip_of_texts_full_of_markers(spark):
    rows = conversations()
    out = {r.conv_id: r for r in read(spark, rows)}
    assert out.keys() == {r[0] for r in rows}
    for conv, own in itertools.groupby(rows, lambda r: r[0]):
        turns = [(role or "", text or "") for _, _, role, text in own]
        r = out[conv]
        assert [tuple(t) for t in r.turns] == turns
        assert r.learned == [t for role, t in turns if role == "assistant"]
        assert sum(m.chars for m in r.mask) == len(r.formatted)
        # the mask by position, against what stands there
        at, under = 0, []
        for m in r.mask:
            under += [r.formatted[at : at + m.chars]] * m.loss
            at += m.chars
        assert len(under) == len(r.learned)
        # adjacent turns of a role share a block
        blocks = len(list(itertools.groupby(turns, lambda t: t[0])))
        marks = sum(r.formatted.count(o) for o in ("<s>", "[INST]", "[SYS]", "[ROLE]"))
        assert marks == blocks


def test_the_written_form(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "<s>"), (1, 0, "tool", "t"), (1, 4, "system", "[\\SYS]")]
    (r,) = read(spark, rows)
    assert r.formatted == "[ROLE]tool[SAYS]t[/ROLE][INST]a[/INST]<s>b[NEXT]<\\s></s>[SYS][\\\\SYS][/SYS]"
    assert r.learned == ["b", "<s>"]


def test_ties_nulls_repeats_and_names(spark):
    rows = [(None, 1, "user", "of none"), (None, None, "user", "first"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a"), (6, 0, None, None)]
    out = {r.conv_id: [tuple(t) for t in r.turns] for r in read(spark, rows)}
    assert out == {None: [("user", "first"), ("user", "of none")], 5: [("user", "a"), ("user", "a"), ("user", "b")], 6: [("", "")]}
    columns = "conv_id long, turn long, role string, text string, Of int, T string, heads int, formatted string"
    clash = spark.createDataFrame([(1, 1, "user", "x", 3, "t", 4, "f")], columns)
    assert [tuple(r)[:2] for r in chat.format_turns(clash).collect()] == [(1, "[INST]x[/INST]")]
    assert chat.format_turns(clash.where("false")).collect() == []


def test_a_long_conversation(spark):
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], f"text {i} " * 3) for i in range(3000)]
    (r,) = read(spark, rows)
    assert [tuple(t) for t in r.turns] == [x[2:] for x in rows]
    assert r.learned == [x[3] for x in rows if x[2] == "assistant"]


def test_a_mask_that_does_not_fit_is_an_error(spark):
    made = chat.format_turns(spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string"))
    with pytest.raises(Exception, match="does not fit"):
        made.select(chat.under_mask(F.concat("formatted", F.lit("x")), F.col("mask"))).collect()


def test_no_python_in_the_plan(spark, sf_dir):
    plan = chat.op13_chat(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_matches_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{Path(sf_dir)}/conversations.parquet'")
    rows = [tuple(r) for r in chat.op13_chat(spark, sf_dir).collect()]
    assert sorted(rows) == sorted(con.execute(chat.CHAT_SQL).fetchall())
    assert any(r[0] == -7 for r in rows)
