from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import resampling

from messy_rows import MESSY


def test_weights_are_ratios_of_smoothed_frequencies(spark, sf_dir, texts):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    targets = frame.where("doc_id % 3 = 0").select("doc_id")
    ratios = resampling.ratios(frame, targets, size=500)
    raw, good = Counter(), Counter()
    for id, text in texts.items():
        own = resampling.buckets(text, 500).tolist()
        raw.update(own)
        if id % 3 == 0:
            good.update(own)
    for b in range(500):
        want = math.log((good[b] + 1) / (sum(good.values()) + 500)) - math.log((raw[b] + 1) / (sum(raw.values()) + 500))
        assert math.isclose(ratios[b], want, abs_tol=1e-9)
    weighed = resampling.log_weights(frame, ratios).select("doc_id", "log_weight").collect()
    for r in weighed:
        assert math.isclose(r.log_weight, sum(ratios[b] for b in resampling.buckets(texts[r.doc_id], 500)), abs_tol=1e-6)


def test_cut_is_the_kth_largest(spark):
    values = [3.0, 3.0, 3.0, -1.7e308, 1.7e308, 0.0, -0.0, 5e-324, 2.5, None, float("nan"), 7.25] + [0.5] * 20
    frame = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted((v for v in values if v is not None and v == v), reverse=True)
    for k in range(1, len(ordered) + 1):
        assert resampling.cut(frame, "key", k) == ordered[k - 1]
    assert resampling.cut(frame, "key", 0) is None and resampling.cut(frame, "key", 99) is None


def test_query_selects_the_top_and_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = resampling.op6_resampling(spark, sf).cache()
    keys = sorted((r.key for r in rows.select("key").collect()), reverse=True)
    chosen = rows.where("selected").agg(F.count("*"), F.min("key")).first()
    assert chosen[0] == int(0.75 * len(keys)) and chosen[1] == keys[int(0.75 * len(keys)) - 1]
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    held = rows.join(labels, "doc_id").select("quality", "log_weight").collect()
    good, bad = ([r.log_weight for r in held if r.quality == q] for q in (1, 0))
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.95


def test_messy_rows(spark, messy, empty):
    targets = spark.createDataFrame([(1,), (None,), (4,)], "doc_id long")
    ratios = resampling.ratios(messy, targets)
    rows = resampling.resample(messy, ratios, 0.5).collect()
    assert len(rows) == len(MESSY)
    assert {r.log_weight for r in rows if r.doc_id in (2, 3, 7)} == {0.0}
    assert len({r.selected for r in rows if r.doc_id == 1}) == 1
    none = resampling.ratios(empty, targets)
    assert not none.any() and resampling.resample(empty, none, 0.5).collect() == []
    assert np.isfinite(ratios).all()
