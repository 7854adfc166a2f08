from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from gleanery.llm import packing

from messy_rows import MESSY


@pytest.fixture(scope="module")
def ranks():
    return packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def plain_best_fit(lengths, size):
    """Number of rows, looking at every row for the tightest fit."""
    free = []
    for n in lengths:
        fits = [(space, i) for i, space in enumerate(free) if space >= n]
        if fits:
            free[min(fits)[1]] -= n
        else:
            free.append(size - n)
    return sorted(free)


@pytest.mark.parametrize("size", [1, 7, 16, 33, 1000])
def test_tree_finds_the_tightest_row(size):
    draw = random.Random(size)
    lengths = sorted((draw.randint(1, size) for _ in range(500)), reverse=True)
    rows = packing.best_fit(lengths, size)
    assert sorted(i for row in rows for i in row) == list(range(500))
    assert sorted(size - sum(lengths[i] for i in row) for row in rows) == plain_best_fit(lengths, size)


def unpacked(rows, size):
    """Ids of each document from its segments; every other property is asserted."""
    parts = defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == size and r.cu_seqlens[-1] == r.n_tokens <= size
        assert set(ids[r.n_tokens :].tolist()) <= {50_256}
        for start, stop, id, piece in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.pieces, strict=False):
            parts[id].append((piece, ids[start:stop].tolist()))
            assert positions[start:stop].tolist() == list(range(stop - start))
    return parts


@pytest.mark.parametrize("limit", [packing.SHARD_TOKENS, 5_000])
def test_documents_come_back(spark, sf_dir, texts, ranks, limit):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(frame, ranks, row_tokens=128, shard_bytes=200_000, shard_tokens=limit).collect()
    tool = packing.encoder(ranks)
    parts = unpacked(rows, 128)
    for id, text in texts.items():
        assert sum((x for _, x in sorted(parts[id])), []) == tool.encode_ordinary(text)
    assert len({(r.shard, r.part, r.row) for r in rows}) == len(rows)
    assert len({r.shard for r in rows}) > 1


def test_query_fills_its_rows(spark, sf_dir):
    rows = packing.op5_packing(spark, sf_dir).collect()
    assert sum(r.n_tokens for r in rows) > 0.97 * packing.ROW_TOKENS * len(rows)


def test_messy_rows(spark, messy, empty, ranks):
    rows = packing.pack(messy, ranks, row_tokens=64).collect()
    tool, parts = packing.encoder(ranks), unpacked(rows, 64)
    for id in {r[0] for r in MESSY}:
        want = sorted(n for r in MESSY if r[0] == id for n in tool.encode_ordinary(r[1] or ""))
        assert sorted(n for _, x in parts[id] for n in x) == want
    assert packing.pack(empty, ranks).collect() == []
