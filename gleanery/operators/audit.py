"""Counts per source and per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import round_seconds
from gleanery.schema import AUDIT_COLUMNS


def records_per_source(records: DataFrame) -> DataFrame:
    """Number of raw records of every source that has any."""
    return records.groupBy("source_id").agg(F.count("*").alias("records"))


def audit(pages: DataFrame, records: DataFrame) -> DataFrame:
    """One row per source, with a zero for the ones without records, in trust order."""
    counted = pages.join(records_per_source(records), "source_id", "left")
    return counted.select(
        "source_ord",
        F.col("name").alias("source"),
        "url",
        "level",
        "content_type",
        "text_chars",
        F.coalesce("records", F.lit(0).cast("bigint")).alias("records"),
        F.coalesce(round_seconds(F.col("elapsed_s")), F.lit(0.0)).alias("elapsed_s"),
    ).select("source_ord", *AUDIT_COLUMNS)


def run_totals(table: DataFrame) -> DataFrame:
    """Rows of the table and how many of them are flagged."""
    return table.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("review_needed") == "Yes").alias("flagged"),
    )
