from __future__ import annotations

import math
import random
from pathlib import Path

import duckdb
import numpy as np
import pytest

from gleanery.llm import topk


def plain(rows, k):
    """All scores of all queries, in Python's integers."""
    usable = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for q in sorted({i for i, _ in usable if i % 20 == 0}):
        weights = min(v for i, v in usable if i == q)
        ends = 2**63 - 1  # sums beyond 64 bits are moved to the ends
        scores = [(-max(-ends, min(ends, sum(a * b for a, b in zip(weights, v)))), i) for i, v in usable if i != q and len(v) == len(weights)]
        out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return {q: x for q, x in out.items() if x}


def asked(spark, rows, k):
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(3)
    found: dict = {}
    for r in topk.top_k(frame, frame.where("vec_id % 20 = 0"), k, vector="v").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in found.items()}


@pytest.mark.parametrize("scale", [1.0, 50_000.0, 3e7])
def test_small_blocks_ties_and_large_numbers(spark, monkeypatch, scale):
    for name, value in (("CANDIDATES", 16), ("QUERIES", 2), ("STRIP", 2), ("LANE", 2)):
        monkeypatch.setattr(topk, name, value)
    draw = random.Random(int(scale))
    rows = [(i, [scale * draw.choice([draw.gauss(0, 1), 0.5, -0.25]) for _ in range(5)]) for i in range(150)]
    rows += [(200 + i, [0.5 * scale] * 5) for i in range(40)]  # one vector many times
    # the patched sizes reach the driver only; Lists and Best are the same code for any size
    assert asked(spark, rows, 7) == plain(rows, 7)


def test_unusable_rows_other_dimensions_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, []), (60, [3.0]), (80, None), (100, [1.0, nan]),
        (1, [1.0, 1.0]), (2, [1.0, None]), (3, [inf, 1.0]), (None, [9.0, 9.0]), (4, [1.0, 1.0]), (5, [-1.0, -0.01]),
        (6, []), (7, [2.0]),
    ]
    assert asked(spark, rows, 3) == plain(rows, 3)
    assert asked(spark, [(20, [1.0])], 3) == {}
    assert asked(spark, [], 3) == {}


@pytest.mark.parametrize("scale", [3, 40, 10**7])
def test_queries_stop_early_with_the_exact_best(monkeypatch, scale):
    monkeypatch.setattr(topk, "LEFT", 8)
    draw = np.random.default_rng(scale)
    centres = draw.normal(size=(30, 12)) * scale
    vectors = (centres[draw.integers(0, 30, 900)] + draw.normal(size=(900, 12)) * scale / 4).astype(np.int64)
    vectors[5] = 0
    ids = np.arange(900)
    best = topk.Best(ids[::20], vectors[::20], 10)
    for start in (0, 300, 600):
        best.read(topk.Lists.of(ids[start : start + 300], vectors[start : start + 300]))
    for query, (found, scores) in zip(ids[::20], best.found):
        exact = vectors.astype(object) @ vectors[query].astype(object)
        order = sorted((-s, i) for i, s in enumerate(exact) if i != query)[:10]
        assert list(zip(found.tolist(), scores.tolist())) == [(i, -s) for s, i in order]
    assert 0 < best.entries_read < best.entries


def test_share_of_entries_read(spark):
    (row,) = topk.share_read(
        *(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where(c) for c in ("true", "vec_id % 20 = 0")), 20
    ).collect()
    assert 0.9 * 100 * 2000 * 64 < row.entries <= 100 * 2000 * 64  # lists of weight nought are not read
    assert 0 < row.share < 0.95


def test_query_matches_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{Path(sf_dir)}/embeddings.parquet'")
    rows = [tuple(r) for r in topk.op8_top_k(spark, sf_dir).collect()]
    assert sorted(rows) == sorted(con.execute(topk.TOP_K_SQL).fetchall())
