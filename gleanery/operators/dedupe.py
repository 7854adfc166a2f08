"""First-wins removal of duplicate programs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import dedupe_key
from gleanery.operators.joins import fits_broadcast, maybe_among
from gleanery.schema import ORDER_COLUMNS


_KEY_NAMES = ["key_name", "key_level", "key_administrator"]


def _key() -> list[Column]:
    return [
        dedupe_key(F.col("program_name")),
        F.coalesce("level", F.lit("")),
        dedupe_key(F.col("program_administrator")),
    ]


def duplicate_key() -> list[Column]:
    """Name and administrator ignoring case and spacing, and the level."""
    return [key.alias(name) for key, name in zip(_key(), _KEY_NAMES)]


def counts_around(records: DataFrame) -> DataFrame:
    """Rows ``step, records``: how many records there are before and after first-wins.

    One aggregate over the keys; the records themselves stay where they are.
    """
    per_key = records.groupBy(*duplicate_key()).agg(F.count("*").alias("n"))
    both = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"), F.count("*").alias("after")
    )
    return both.selectExpr("stack(2, 'before', before, 'after', after) AS (step, records)")


def _at_first_places(
    records: DataFrame, order: list[str], written: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The records that stand at the first place of their duplicate key, and few others of that key.

    Places are compared over narrow columns, then by a hash. Of the records only those found are read
    whole, where they lie while the places are within the broadcast limit. Beyond it a bitmap of the
    places drops nearly all other records where they lie; the rest is shuffled by key and place and
    looked up in a hash table, so that no record is sorted for it.
    """
    place = F.struct(*order).alias("place")
    firsts = written(records.groupBy(*duplicate_key()).agg(F.min(place).alias("place")))
    there = [firsts["place"].getField(c) for c in order]
    if fits_broadcast(firsts):
        found = F.broadcast(firsts)
    else:
        records = maybe_among(records, [F.col(c) for c in order], firsts, there)
        found = firsts.hint("shuffle_hash")
    # Keys are never null, so the join deals records out as they are grouped next.
    same = [key == firsts[name] for key, name in zip(_key(), _KEY_NAMES)]
    same.append(F.xxhash64(*order) == F.xxhash64(*there))
    return records.join(found, reduce(and_, same), "left_semi")


def keep_first(
    records: DataFrame,
    order: list[str] | None = None,
    written: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The first record of every duplicate key, by ``order`` (source trust, then position).

    ``min_by`` combines within each map task first, so a key held by a third of the
    records sends one row per task through the one shuffle. It sorts records whole; given
    ``written``, which writes a table and reads it back, only those at first places get there.
    """
    order = order or ORDER_COLUMNS
    group = _key()
    if written is not None:
        records = _at_first_places(records, order, written)
        # One place of a key is left, so that this splits no key; records then move only once.
        group.append(F.xxhash64(*order))
    first = F.min_by(F.struct(*records.columns), F.struct(*order)).alias("first")
    return records.groupBy(*group).agg(first).select("first.*")
