"""Lookup join whose right side is broadcast only when small enough, and a filter before joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap for each row marked in it, and bits of the largest one (16 MiB).
BITS_A_ROW, MOST_BITS = 32, 1 << 27


def _byte_limit(df: DataFrame) -> int:
    """The session's own broadcast limit in bytes; negative if broadcasts are off."""
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if setting.startswith("-"):
        return -1
    return df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def fits_broadcast(df: DataFrame) -> bool:
    """True when the optimizer's size estimate is within the session's broadcast limit."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= _byte_limit(df)


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``left`` with ``right``, which holds at most one row per ``key``.

    A right side within the broadcast limit leaves ``left`` where it is. Beyond it both are
    shuffled by the key for a sort-merge join. Adaptive execution splits the left rows of a
    heavy key over several tasks, as many as its size calls for, and hands only that key's
    partition of the right side to each of them.
    """
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key, how)
    return left.join(right.hint("merge"), key, how)


def maybe_among(left: DataFrame, keys: list[Column], right: DataFrame, right_keys: list[Column]) -> DataFrame:
    """The rows of ``left`` whose keys may be among those of ``right``: all that are, few others.

    The hashes of ``right``'s keys are marked in a bitmap of bounded size, which is broadcast, so that
    ``left`` stays where it is. Meant before a join that has to move ``left``: that one decides. Of
    the other rows about one in ``BITS_A_ROW`` stays, more once the bitmap is at its bound.
    """
    wanted = max(right.count(), 1) * BITS_A_ROW
    bits = F.lit(min(MOST_BITS, 1 << wanted.bit_length()))
    marked = right.select(F.pmod(F.xxhash64(*right_keys), bits).alias("spot"))
    bitmap = marked.groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("marks")
    )
    spot = F.pmod(F.xxhash64(*keys), bits)
    at = F.bitmap_bit_position(spot)
    byte = F.hex(F.substring(bitmap["marks"], (F.shiftright(at, 3) + 1).cast("int"), F.lit(1)))
    there = F.getbit(F.conv(byte, 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1
    return left.join(F.broadcast(bitmap), (F.bitmap_bucket_number(spot) == bitmap["bucket"]) & there, "left_semi")
