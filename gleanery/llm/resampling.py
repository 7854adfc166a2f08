"""Quality by importance resampling.

Texts are bags of hashed word 1-grams and 2-grams. Two generative models, smoothed bucket
frequencies, are counted: one over target texts (labelled good), one over all texts. A
text's log importance weight is the log-likelihood ratio of its n-grams under the two. The
sample is the top k of log weight plus Gumbel noise, which draws without replacement in
proportion to the weights.
"""

from __future__ import annotations

from math import isfinite
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common

BUCKETS = 10_000
SMOOTHING = 1.0
#: Labelled target texts that the target model is counted on, at most.
TARGET_ROWS = 20_000
SEED = 40_961
#: Bins that one look at the keys divides them into.
BINS = 4096


def buckets(text: str, size: int = BUCKETS) -> np.ndarray:
    """Bucket numbers of the text's words and pairs of words, repeats included."""
    words = text.encode().lower().split()
    one = np.fromiter(map(crc32, words), np.uint64, len(words))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([one % np.uint64(size), (two >> np.uint64(17)) % np.uint64(size)]).astype(np.int64)


def ratios(
    df: DataFrame,
    targets: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    most: int = TARGET_ROWS,
    size: int = BUCKETS,
) -> np.ndarray:
    """Log ratio of target to raw frequency for every bucket.

    The raw model counts every text of ``df``. The target model counts those whose id is in
    ``targets``, at most ``most`` of these ids, picked by a hash. What is broadcast is at most
    ``most`` ids; what reaches the driver is two counts a bucket. Without target texts all
    ratios are 0.
    """
    picked = (
        targets.select(F.col(id).cast("long").alias("target"))
        .dropna().distinct().orderBy(F.xxhash64("target"), "target").limit(most)
    )
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), common.whole(text).alias("t"))
    marked = rows.join(F.broadcast(picked), F.col("id") == F.col("target"), "left").select(
        F.col("target").isNotNull().alias("good"), "t"
    )
    common.prepare(df.sparkSession)

    def count(batches):
        totals = np.zeros((2, size), np.int64)
        for batch in common.slices(batches):
            for good, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.bincount(buckets(value, size), minlength=size)
                totals[0] += own
                if good:
                    totals[1] += own
        model, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(model, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[model, bucket])],
            ["model", "bucket", "n"],
        )

    counts = np.zeros((2, size))
    counted = marked.mapInArrow(count, "model int, bucket int, n long").groupBy("model", "bucket")
    for row in counted.agg(F.sum("n").alias("n")).collect():
        counts[row.model, row.bucket] = row.n
    if not counts[1].any():
        return np.zeros(size)
    raw, good = counts + SMOOTHING
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def log_weights(df: DataFrame, ratios: np.ndarray, text: str = "text", name: str = "log_weight") -> DataFrame:
    """Every row of ``df`` with its log importance weight in a new column.

    Null and empty texts weigh 0. Other columns pass through; one of that name is replaced.
    """

    def run(texts):
        return pa.array([float(ratios[buckets(t, len(ratios))].sum()) for t in texts], pa.float64())

    return common.append_column(df, run, common.whole(text), name, "double")


def gumbel(id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise that depends on the id and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id}`").cast("string"), F.lit(seed)), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(2**53))
    return -F.log(-F.log(uniform))


def cut(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of ``key``, None if there are fewer; nulls and NaN don't count.

    Every look divides the range that holds it into ``BINS`` parts and counts them in one
    aggregate, until the range has one value.
    """
    own = df.select(F.col(f"`{key}`").alias("key")).where(F.col("key").isNotNull() & ~F.isnan("key"))
    low, high, count = own.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if k <= 0 or count < k:
        return None
    above = 0  # values over ``high``
    while low < high:
        if isfinite(high - low):
            width, offset = (high - low) / BINS, F.col("key") - F.lit(low)
        else:
            width, offset = 1.0, (F.col("key") / 2 - F.lit(low / 2)) * (BINS / (high / 2 - low / 2))
        if width:
            number = F.least(F.floor(offset / F.lit(width)), F.lit(BINS - 1))
        else:  # a few of the smallest numbers: the ends, and what lies between
            number = F.when(F.col("key") == low, 0).when(F.col("key") == high, 2).otherwise(1)
        inside = own.where(F.col("key").between(low, high))
        bins = inside.groupBy(number.alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r.low):
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n
    return low


def resample(
    df: DataFrame, ratios: np.ndarray, share: float, *, text: str = "text", id: str = "doc_id", seed: int = SEED
) -> DataFrame:
    """Every row of ``df`` with ``log_weight``, ``key`` and ``selected``.

    Selected is the top ``share`` of rows (rounded down) by key, the weight plus Gumbel noise;
    rows that tie with the last one are selected too, so equal rows share their fate. An
    empty table gives no rows.
    """
    weighed = log_weights(df, ratios, text).withColumn("key", F.col("log_weight") + gumbel(id, seed))
    own = weighed.select(*[F.col(f"`{c}`") for c in weighed.columns if c != text])
    keys = common.stage(own, "keys")
    last = cut(keys, "key", int(share * keys.count()))
    chosen = F.lit(False) if last is None else F.col("key") >= F.lit(last)
    return keys.withColumn("selected", chosen)


def op6_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarters of all documents, drawn towards those labelled good; labels with crc32 % 4 = 2 unused."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    usable = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    good = common.table(spark, sf_dir, "labels").where((F.col("quality") == 1) & usable)
    return resample(documents, ratios(documents, good), 0.75).select(
        "doc_id", "log_weight", "key", "selected"
    )
