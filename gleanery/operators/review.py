"""Rules that flag finished rows for review: completeness and link verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import has_text, strip_space
from gleanery.operators.joins import lookup_join
from gleanery.schema import ORDER_COLUMNS, REQUIRED_COLUMNS


def flag_incomplete(table: DataFrame) -> DataFrame:
    """Set ``review_needed`` where a required column is blank; never clears it."""
    blank = F.lit(False)
    for name in REQUIRED_COLUMNS:
        blank = blank | ~has_text(strip_space(F.col(name)))
    return table.withColumn(
        "review_needed", F.when(blank, F.lit("Yes")).otherwise(F.col("review_needed"))
    )


def link_is_broken(status: Column, error: Column) -> Column:
    """True for a failed request and for a status other than 2xx, 3xx and 403.

    Null where the link was never probed.
    """
    reachable = status.between(200, 399) | (status == 403)
    return F.when(F.coalesce(error, F.lit(False)), F.lit(True)).otherwise(~reachable)


def verdicts(link_status: DataFrame) -> DataFrame:
    """One row per address: ``broken`` if any probe of it says so, null if none says anything."""
    broken = link_is_broken(F.col("status"), F.col("error"))
    return link_status.groupBy("url").agg(F.bool_or(broken).alias("broken"))


def checked_scope(table: DataFrame, max_checks: int, order: list[str]) -> DataFrame:
    """Rows among which links are checked: up to and including the ``max_checks``-th link.

    ``max_checks`` is how many links the caller is ready to probe. The cut-off is found by
    a top-k over the order columns, so no window passes over the whole table.
    """
    if max_checks < 0:
        return table.withColumn("in_scope", F.lit(True))
    place = F.struct(*order)
    counted = (
        table.filter(has_text(F.col("program_links")))
        .select(place.alias("place"))
        .orderBy("place")
        .limit(max_checks)
        .agg(F.struct(F.count("*").alias("links"), F.max("place").alias("cutoff")))
        .scalar()
    )
    # The cut-off does not matter if the table holds fewer links than may be checked.
    return table.withColumn(
        "in_scope",
        (counted.getField("links") < max_checks) | (place <= counted.getField("cutoff")),
    )


def flag_broken_links(
    table: DataFrame,
    link_status: DataFrame,
    max_checks: int = 0,
    order: list[str] | None = None,
) -> DataFrame:
    """Set ``review_needed`` for empty and broken links among the first ``max_checks``.

    0 checks nothing, a negative number everything. Rows after the limit stay as they
    are, empty links included; so do links without a verdict.
    """
    if max_checks == 0:
        return table
    order = order or ORDER_COLUMNS
    known = verdicts(link_status).withColumnRenamed("url", "program_links")
    scoped = checked_scope(table, max_checks, order)
    joined = lookup_join(scoped, known, "program_links")
    flagged = F.col("in_scope") & (
        ~has_text(F.col("program_links")) | F.coalesce("broken", F.lit(False))
    )
    return joined.withColumn(
        "review_needed", F.when(flagged, F.lit("Yes")).otherwise(F.col("review_needed"))
    ).select(*table.columns)


def review_queue(table: DataFrame) -> DataFrame:
    """Flagged rows."""
    return table.filter(F.col("review_needed") == "Yes")
