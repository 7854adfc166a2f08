"""Scans: registry, captures, answers, link verdicts, and tables written earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.schema import (
    ANSWER_SCHEMA,
    CAPTURE_SCHEMA,
    LINK_STATUS_SCHEMA,
    PROVENANCE_COLUMN,
    REGISTRY_DEFAULTS,
    REGISTRY_SCHEMA,
    TABLE_COLUMNS,
)

_CSV = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _read(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType
) -> DataFrame:
    options = {**_CSV, "enforceSchema": False} if fmt == "csv" else {}
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def with_registry_defaults(registry: DataFrame) -> DataFrame:
    """Registry columns in order, missing or null ones at their defaults."""
    columns = []
    for field in REGISTRY_SCHEMA.fields:
        given = field.name in registry.columns
        value = F.col(field.name) if given else F.lit(None)
        if field.name in REGISTRY_DEFAULTS:
            value = F.coalesce(value, F.lit(REGISTRY_DEFAULTS[field.name]))
        columns.append(value.cast(field.dataType).alias(field.name))
    return registry.select(*columns)


def read_registry(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Source registry; ``source_ord`` carries the trust order."""
    return with_registry_defaults(_read(spark, path, fmt, REGISTRY_SCHEMA))


def read_captures_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, CAPTURE_SCHEMA)


def read_answers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Answers: one JSON payload and the position its first entry has in its source."""
    answers = _read(spark, path, fmt, ANSWER_SCHEMA)
    return answers.withColumn("first_pos", F.coalesce("first_pos", F.lit(0)))


def read_link_status(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, LINK_STATUS_SCHEMA)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names as written in the files; empty if no file has a line.

    The first line of every file is read. Where files differ, it is a header other than the
    table's own.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"),
    )
    firsts = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    expected = ",".join(TABLE_COLUMNS)
    found = firsts.groupBy("header").count().orderBy(F.col("header") == expected, "header").first()
    return found["header"].split(",") if found else []


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A written table by position, header lines among the rows.

    ``file`` and ``line`` tell where a row stands: the smallest ``line`` of a file is its
    header. ``beyond`` has the field after the table's last column, null if there is none.
    A file is read whole by one task.
    """
    names = [*TABLE_COLUMNS, "beyond"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    given = spark.read.options(**{**_CSV, "header": False}).schema(schema).csv(path)
    return given.select(
        *names,
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_table(
    spark: SparkSession, path: str, *, include_source: bool = False, numbered: bool = True
) -> DataFrame:
    """A written table by position, each row with its number ``row_index`` from 0.

    Without ``numbered`` the number is left out and the files are read once. Rows are numbered per file, files by the numbers in their names; the only window runs
    over one row per file. A file is read whole by one task, so positions in it are
    consecutive.
    """
    names = [*TABLE_COLUMNS, *([PROVENANCE_COLUMN] if include_source else [])]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    given = spark.read.options(**_CSV).schema(schema).csv(path)
    texts = [F.coalesce(n, F.lit("")).alias(n) for n in names]
    if not numbered:
        return given.select(*texts)
    rows = given.select(
        *texts,
        F.col("_metadata.file_name").alias("file_name"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    files = rows.groupBy("file_name").agg(
        F.count("*").alias("rows"), F.min("row_id").alias("first_id")
    )
    numbers = [
        F.regexp_extract("file_name", pattern, 1).try_cast("int")
        for pattern in (r"^part-(\d+)", r"c(\d+)\.csv")
    ]
    before = F.sum("rows").over(
        Window.orderBy(*numbers, "file_name").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = files.select(
        "file_name", "first_id", F.coalesce(before, F.lit(0)).alias("rows_before")
    )
    return rows.join(offsets, "file_name").select(
        *names, (F.col("row_id") - F.col("first_id") + F.col("rows_before")).alias("row_index")
    )


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """The ``program_links`` column of a written table, found by its header name."""
    return spark.read.options(**_CSV).csv(path).select("program_links")
