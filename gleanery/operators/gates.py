"""Quality gates over a produced table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import strip_space
from gleanery.schema import INCENTIVE_TYPES, TABLE_COLUMNS

#: Rows a table must have.
MIN_ROWS = 60
FIRST_OFFENDERS = 5

#: Gate -> the column whose values it shows when it fails.
SHOWN = {
    "incentive_type": "incentive_type",
    "review_needed": "review_needed",
    "program_links": "program_name",
    "program_name": "row_index",
    "updated_at": "updated_at",
}


def _text(name: str) -> Column:
    """Column of a CSV read back, where an empty field may come as null."""
    return F.coalesce(F.col(name), F.lit(""))


def failures() -> dict[str, Column]:
    """Gate -> whether a row fails it."""
    dashed = (F.length(_text("updated_at")) == 10) & (
        F.substring(_text("updated_at"), 5, 1) == "-"
    )
    return {
        "incentive_type": ~_text("incentive_type").isin(*INCENTIVE_TYPES),
        "review_needed": ~_text("review_needed").isin("Yes", "No"),
        "program_links": ~F.startswith(_text("program_links"), F.lit("http")),
        "program_name": strip_space(_text("program_name")) == "",
        "updated_at": ~dashed,
    }


def gate_report(table: DataFrame, header: list[str] | None = None) -> DataFrame:
    """``gate, passed, offending`` rows from one pass over the table.

    ``header`` is the column list found in the files, the table's own by default. A header
    counts as a row: a table with nothing else fails ``coverage``, but not ``nonempty``.
    """
    if header is None:
        header = [c for c in table.columns if c != "row_index"]
    counts = table.agg(
        F.count("*").alias("rows"),
        *[F.count_if(bad).alias(f"bad_{gate}") for gate, bad in failures().items()],
    )
    return _report(
        counts, (F.col("rows") > 0) | F.lit(bool(header)), F.lit(header == TABLE_COLUMNS)
    )


def gate_files(lines: DataFrame) -> DataFrame:
    """``gate_report`` of files as ``readers.read_lines`` has them, header lines checked too.

    One pass, combined in each task to a row a file. A file's first line is told by a
    number: bit 0 is set if it is the right header, the others if it fails a gate as a row;
    it is counted like the rest and taken off. Every file must have the right header.
    """
    failing = failures()
    right = F.col("beyond").isNull()
    for name in TABLE_COLUMNS:
        right &= F.col(name).eqNullSafe(F.lit(name))
    marks = [right, *failing.values()]
    mark = sum((F.when(m, 1 << i).otherwise(0) for i, m in enumerate(marks)), F.lit(0))
    files = lines.groupBy("file").agg(
        (F.count("*") - 1).alias("rows"),
        F.min_by(mark.cast("bigint"), "line").alias("first"),
        *[F.count_if(bad).alias(f"bad_{gate}") for gate, bad in failing.items()],
    )

    def bit(i: int) -> Column:
        return F.shiftright("first", i).bitwiseAND(F.lit(1).cast("bigint"))

    counts = files.agg(
        F.count("*").alias("files"),
        F.count_if(bit(0) == 0).alias("wrong"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[
            F.coalesce(F.sum(F.col(f"bad_{gate}") - bit(i)), F.lit(0)).alias(f"bad_{gate}")
            for i, gate in enumerate(failing, 1)
        ],
    )
    return _report(counts, F.col("files") > 0, (F.col("files") > 0) & (F.col("wrong") == 0))


def _report(counts: DataFrame, nonempty: Column, header_ok: Column) -> DataFrame:
    """A row a gate from one row of counts."""

    def line(gate: str, passed: Column, offending: Column) -> Column:
        return F.struct(
            F.lit(gate).alias("gate"),
            passed.alias("passed"),
            offending.cast("bigint").alias("offending"),
        )

    lines = [
        line("nonempty", nonempty, F.lit(0)),
        line("columns", header_ok, F.when(header_ok, 0).otherwise(1)),
        *[line(g, F.col(f"bad_{g}") == 0, F.col(f"bad_{g}")) for g in failures()],
        line(
            "coverage",
            F.col("rows") >= MIN_ROWS,
            F.greatest(F.lit(0), F.lit(MIN_ROWS) - F.col("rows")),
        ),
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def offending_values(table: DataFrame) -> DataFrame:
    """Distinct ``gate, value`` rows of the gates that report every bad value once."""
    gates = ["incentive_type", "review_needed", "updated_at"]
    failing = failures()
    lines = F.array_compact(
        F.array(
            *[
                F.when(
                    failing[g], F.struct(F.lit(g).alias("gate"), _text(SHOWN[g]).alias("value"))
                )
                for g in gates
            ]
        )
    )
    return table.select(F.explode(lines).alias("line")).select("line.*").distinct()


def first_offenders(table: DataFrame, gate: str, order: list[str]) -> DataFrame:
    """The first few rows failing a gate, in row order, and the value shown for each."""
    shown = F.col(SHOWN[gate]).cast("string").alias("value")
    return (
        table.filter(failures()[gate])
        .orderBy(*order)
        .limit(FIRST_OFFENDERS)
        .select(F.lit(gate).alias("gate"), *order, shown)
    )


def type_distribution(table: DataFrame) -> DataFrame:
    """Rows per incentive type, zeros included, sorted by type."""
    counts = table.groupBy("incentive_type").agg(F.count("*").alias("rows"))
    words = F.explode(F.array(*[F.lit(t) for t in INCENTIVE_TYPES])).alias("incentive_type")
    vocabulary = table.sparkSession.range(1).select(words)
    return (
        vocabulary.join(counts, "incentive_type", "left")
        .select("incentive_type", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))
        .orderBy("incentive_type")
    )


def flagged_share(table: DataFrame) -> DataFrame:
    """Rows, flagged rows, and the flagged share in percent to one decimal."""
    counts = table.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("review_needed") == "Yes").alias("flagged"),
    )
    share = F.when(F.col("rows") > 0, F.col("flagged") / F.col("rows") * 100).otherwise(F.lit(0.0))
    return counts.withColumn("flagged_pct", F.format_number(share, 1))
