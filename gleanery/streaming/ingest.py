"""Typing of answers as they arrive; duplicates are settled later, over all records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gleanery.plans.build import raw_records, repeated_keys_allowed
from gleanery.schema import ANSWER_SCHEMA


def answer_stream(spark: SparkSession, path: str) -> DataFrame:
    """New answer files of a folder."""
    return spark.readStream.schema(ANSWER_SCHEMA).parquet(path)


def start_ingest(
    answers: DataFrame, hints: DataFrame, run_date: Column, path: str, checkpoint: str
) -> StreamingQuery:
    """Append the typed records of all waiting answers to ``path``, then stop.

    Every stage up to the raw records works on single rows, so there is no state to keep
    and a restart from ``checkpoint`` writes each answer once.
    """
    # a stream keeps the settings of its start, repeated JSON keys are read as in a build
    with repeated_keys_allowed(answers.sparkSession):
        return (
            raw_records(answers, hints, run_date)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
