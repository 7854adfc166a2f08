from __future__ import annotations

import math

import numpy as np
import pytest

from gleanery.llm import whitening


def blocks():
    draw = np.random.default_rng(1)
    return {
        "gauss": (draw.normal(size=(400, 24)) * 128).astype(int) + 100_000,
        "few directions": ((draw.normal(size=(300, 3)) @ draw.normal(size=(3, 24))) * 128).astype(int),
        "one eigenvalue": np.eye(24, dtype=int) * 50 + 100_000,
        "copies": np.repeat((draw.normal(size=(7, 24)) * 128).astype(int), 50, 0) + 100_000,
        "scales": (draw.normal(size=(300, 12)) * 10.0 ** np.arange(12)).astype(np.int64),
        "constant": np.full((5, 3), 7),
        "two": np.array([[1, 2], [3, 4]]),
    }


@pytest.mark.parametrize("name", blocks())
def test_updates_and_combinations_against_a_dense_solver(name):
    rows = blocks()[name]
    alone = whitening.Spectrum(rows.shape[1])
    for start in range(0, len(rows), 100):
        alone.add(rows[start : start + 100])
    parts = []
    for part in np.array_split(rows, 3):
        parts.append(whitening.Spectrum(rows.shape[1]))
        if len(part):
            parts[-1].add(part)
    both = parts[0].combine(parts[1]).combine(whitening.Spectrum.unpack(parts[2].pack()))
    centred = rows - rows.mean(0)
    scatter = centred.T @ centred
    largest = max(np.linalg.eigvalsh(scatter)[-1], 1e-300)
    for s in (alone, both):
        assert s.n == len(rows) and s.sums == rows.sum(0).tolist()
        assert np.abs(s.d - np.linalg.eigvalsh(scatter)).max() <= 1e-12 * largest
        assert np.abs(s.q.T @ s.q - np.eye(len(s.d))).max() < 1e-12
        assert np.abs(s.q * s.d @ s.q.T - scatter).max() <= 1e-12 * largest


def test_secular_roots_between_close_poles():
    d = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-12, 5.0])
    z2 = np.array([1e-3, 0.5, 1e-8, 2.0, 1e-6])
    origin, distance = whitening.secular_roots(d, z2)
    dense = np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(z2, z2)))
    assert np.allclose(d[origin] + distance, dense, rtol=1e-13, atol=1e-14)


def plain(rows, k):
    """By vector, from a dense solver: whitened values up to sign, deviation, explained."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    far = [sum(int(d) ** 2 for d in n * row - sums) for row in x]
    centred = (n * x - sums).astype(float) / n
    covariance = centred.T @ centred / n
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return centred @ q / np.sqrt(e), far, e / np.trace(covariance)


def test_rows_against_a_dense_solver(spark):
    draw = np.random.default_rng(5)
    mixed = draw.normal(size=(6, 6))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(200, 6)) @ mixed)]
    rows += [(500, rows[3][1])] * 90  # one vector and id many times
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    out = whitening.whitening(frame, components=4).collect()
    assert len(out) == 4 * len(rows)
    white, far, share = plain(rows, 4)
    at = {i: place for place, (i, _) in enumerate(rows)}
    for c in range(4):
        own = [r for r in out if r.component == c + 1]
        expected = np.array([white[at[r.vec_id], c] for r in own])
        got = np.array([r.whitened for r in own])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-10
        assert all(r.explained == pytest.approx(share[c], rel=1e-12) for r in own)
        assert all(int(r.deviation) == far[at[r.vec_id]] and r.n == len(rows) for r in own)
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-10


def test_unusable_rows_dimensions_and_names(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 2.0]), (2, [2.0, 1.0]), (None, [0.0, 5.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [1.0, inf]),
        (7, [1.0, None]), (8, [1.0]), (9, [3.0]), (10, [1.0, 2.0, 3.0]), (11, [7.0, 7.0]),
    ]
    rows = [(i, v, 0, "x", 1, 2.0) for i, v in vectors]
    columns = "vec_id long, embedding array<double>, V int, Component string, dim int, white double"
    out = whitening.whitening(spark.createDataFrame(rows, columns).repartition(3)).collect()
    found = sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in out)
    two = [(False, i, c) for i in (1, 2, 11) for c in (1, 2)] + [(True, 0, 1), (True, 0, 2)]
    assert found == sorted(two + [(False, 8, 1), (False, 9, 1)])  # a single vector has no variance
    assert {r.n for r in out if r.vec_id in (8, 9)} == {2}
    assert whitening.whitening(spark.createDataFrame([], columns)).collect() == []


def test_huge_components_do_not_overflow(spark):
    rows = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(20)]
    out = whitening.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) >= 20 and all(math.isfinite(r.whitened) for r in out)


def test_query_on_the_given_table(spark, sf_dir):
    out = whitening.op11_whitening(spark, sf_dir)
    assert dict(out.dtypes)["deviation"] == "bigint"
    rows = out.collect()
    assert len(rows) == 8 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert {r.identity_error for r in rows}.pop() <= 1e-10
