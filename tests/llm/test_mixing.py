from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing

from messy_rows import MESSY


def test_exponent_meets_the_entropy_or_the_repeat_limit():
    tokens = np.array([10_000, 900, 500, 40, 0])
    exponent, shares, drawn = mixing.solve(tokens, budget=8_000, entropy_target=0.8)
    assert math.isclose(mixing.entropy(shares), 0.8 * math.log(4), rel_tol=1e-6)
    assert 0 < exponent < 1 and shares[4] == 0 and abs(drawn.sum() - 8_000) <= 4
    exponent, shares, drawn = mixing.solve(tokens, budget=8_000, repeat_limit=3.0)
    assert math.isclose(shares[3] * 8_000, 3.0 * 40, rel_tol=1e-6)
    assert mixing.solve(tokens, budget=None, repeat_limit=1.0)[2].tolist() == [10_000, 900, 500, 40, 0]
    with pytest.raises(ValueError):
        mixing.solve(tokens, budget=100_000, repeat_limit=2.0)


def rows_of(spark, n=400):
    rows = [(i, ["big", "mid", "low", None][min(3, (i % 10) // 4 + (i % 7 == 0))], i % 13) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, tokens long")


def test_draws_are_the_permuted_blocks_up_to_the_budget(spark, monkeypatch):
    """Against drawing block by block, document by document."""
    monkeypatch.setattr(mixing, "BLOCKS", 16)
    frame = rows_of(spark)
    drawn = mixing.mix(frame, tokens=F.col("tokens"), budget_share=1.5, entropy_target=0.99, repeat_limit=4.0)
    got = Counter((r.doc_id, r.source, r.mix_epoch, r.mix_block, r.mix_key) for r in drawn.collect())
    totals = Counter()
    for r in frame.collect():
        totals[r.source] += r.tokens
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    _, _, parts = mixing.solve(
        np.array([totals[s] for s in names]), budget=int(1.5 * sum(totals.values())),
        entropy_target=0.99, repeat_limit=4.0,
    )
    seed, id = F.lit(mixing.SEED), F.col("doc_id").cast("string")
    block = F.pmod(F.xxhash64(id, seed), F.lit(16)).cast("int")
    placed = frame.select("*", block.alias("b"), F.xxhash64(seed, id, F.lit("row")).alias("h")).withColumn(
        "keys", F.array(*[F.xxhash64(seed, "source", F.lit(e).cast("long"), "b") for e in range(6)])
    ).collect()
    want = Counter()
    for name, part in zip(names, parts.tolist()):
        own, epoch, left = [r for r in placed if r.source == name], 0, part
        while left > 0:
            order = sorted(own, key=lambda r: (r["keys"][epoch], r.b, r.h, r.doc_id))
            by_block = defaultdict(list)
            for r in order:
                by_block[r["keys"][epoch], r.b].append(r)
            full = sum(r.tokens for r in own) <= left
            for members in by_block.values():
                size = sum(r.tokens for r in members)
                whole = full or size <= left
                upto = 0
                for r in members:
                    upto += r.tokens
                    if whole or upto <= left:
                        want[r.doc_id, name, epoch, r.b, r["keys"][epoch]] += 1
                if not whole:
                    left = 0
                    break
                left -= size
            epoch += 1
    assert got == want


def test_default_budget_leaves_no_document_out(spark):
    frame = rows_of(spark)
    drawn = mixing.mix(frame, tokens=F.col("tokens"), repeat_limit=2.0, placed=False)
    assert drawn.columns == frame.columns
    counts = Counter(r.doc_id for r in drawn.collect())
    assert counts.keys() == {r.doc_id for r in frame.collect()} and set(counts.values()) <= {1, 2}


def test_query_keeps_the_budget(spark, sf_dir):
    rows = mixing.op1_mixing(spark, sf_dir).collect()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokens = {r.doc_id: r.n for r in documents.select("doc_id", mixing.word_tokens().alias("n")).collect()}
    assert all(r.n_tokens == tokens[r.doc_id] and 0 <= r.epoch < 4 for r in rows)
    total = sum(r.n_tokens for r in rows)
    # every source ends at most one document short of its part
    assert sum(tokens.values()) - 21 * max(tokens.values()) <= total <= sum(tokens.values())
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)


def test_messy_rows(spark, messy, empty):
    clashing = messy.withColumnRenamed("score", "mix_epoch")
    drawn = mixing.mix(clashing, repeat_limit=2.0)
    assert drawn.count() >= sum(bool((r[1] or "").strip()) for r in MESSY)
    again = mixing.mix(clashing, repeat_limit=2.0)
    assert sorted(map(str, drawn.collect())) == sorted(map(str, again.collect()))
    assert mixing.mix(empty, budget_share=1.0, entropy_target=0.9).collect() == []


def test_sources_without_tokens_are_drawn_once_without_a_budget(spark, messy):
    frame = messy.select("doc_id", "text", "source")
    extra = spark.createDataFrame([(20, None, "none"), (21, " ", "none"), (21, " ", "none")], frame.schema)
    for given in (frame.union(extra), extra):
        drawn = Counter(mixing.mix(given, repeat_limit=2.0, placed=False).collect())
        own = Counter(given.collect())
        assert drawn.keys() == own.keys() and all(n <= drawn[r] for r, n in own.items())
        assert all(drawn[r] == n for r, n in own.items() if r.source == "none")
    assert mixing.mix(extra, budget=5).collect() == []


def test_columns_named_as_inner_ones(spark):
    inner = ("row", "Source", "id", "block", "tokens", "n", "of", "epochs", "Rest", "key", "upto", "cut_key", "room",
             "epoch", "mix_source", "mix_epoch", "MIX_KEY", "mix_tokens", "plan_source", "left")
    rows = [(i, f"s{i % 3}", "a few words here", *range(len(inner))) for i in range(30)]
    columns = ["doc_id long", "origin string", "text string", *(f"{c} int" for c in inner)]
    frame = spark.createDataFrame(rows, ", ".join(columns))
    drawn = mixing.mix(frame, source="origin", repeat_limit=2.0, placed=False)
    assert drawn.columns == frame.columns
    assert {tuple(r) for r in drawn.collect()} == set(rows)
    placed = mixing.mix(frame, source="origin", repeat_limit=2.0)
    kept = [c for c in frame.columns if c.lower() not in ("mix_epoch", "mix_block", "mix_key", "mix_tokens")]
    assert placed.columns == [*kept, "mix_epoch", "mix_block", "mix_key", "mix_tokens"]
    assert {r.mix_tokens for r in placed.collect()} == {4}


def test_sources_of_one_total_are_solved_together():
    tokens, times = np.array([50, 700, 9000]), np.array([40, 3, 1])
    each = np.repeat(tokens, times)
    one = mixing.solve(tokens, budget=20_000, entropy_target=0.9, times=times)
    all_ = mixing.solve(each, budget=20_000, entropy_target=0.9)
    assert math.isclose(one[0], all_[0], rel_tol=1e-9)
    assert np.repeat(one[2], times).tolist() == all_[2].tolist()


def test_many_sources_take_joins_without_broadcast(spark):
    rows = [(i, f"source {i % 700}", i % 5) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    want = Counter(tuple(r) for r in mixing.mix(frame, tokens=F.col("tokens"), repeat_limit=2.0, placed=False).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = Counter(tuple(r) for r in mixing.mix(frame, tokens=F.col("tokens"), repeat_limit=2.0, placed=False).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == want and set(got) == set(rows) and set(got.values()) <= {1, 2}
