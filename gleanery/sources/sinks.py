"""Writers of the table, the review queue and the audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.operators.review import review_queue
from gleanery.schema import (
    AUDIT_COLUMNS,
    ORDER_COLUMNS,
    PROVENANCE_COLUMN,
    TABLE_COLUMNS,
)

_CSV = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    # A file is read back whole by one task.
    "maxRecordsPerFile": 1_000_000,
}


def table_columns(include_source: bool = False) -> list[Column]:
    """Output columns in order; provenance only on request, never empty."""
    columns = [F.col(c) for c in TABLE_COLUMNS]
    if include_source:
        known = F.coalesce(F.nullif(PROVENANCE_COLUMN, F.lit("")), F.lit("unknown"))
        columns.append(known.alias(PROVENANCE_COLUMN))
    return columns


def write_table(
    table: DataFrame,
    path: str,
    *,
    include_source: bool = False,
    order: list[str] | None = None,
) -> int:
    """Write CSV files in record order, headers included, and return the rows written.

    The sort is a range shuffle on the whole order key, so the files follow one another
    and a source with a third of all rows is spread like the rest.
    """
    written = Observation()
    (
        table.orderBy(*(order or ORDER_COLUMNS))
        .select(*table_columns(include_source))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .options(**_CSV)
        .csv(path)
    )
    return written.get["rows"]


def write_review_queue(table: DataFrame, path: str, order: list[str] | None = None) -> int:
    """Write the flagged rows, always with their provenance."""
    return write_table(review_queue(table), path, include_source=True, order=order)


def write_audit(audit: DataFrame, log_dir: str, started: datetime) -> str:
    """Write one JSON line per source into a folder named after the start of the run."""
    path = f"{log_dir}/run_{started:%Y%m%dT%H%M%S}.jsonl"
    (
        audit.orderBy("source_ord")
        .select(*AUDIT_COLUMNS)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .json(path)
    )
    return path
