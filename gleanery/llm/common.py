"""What the corpus operators share: staged tables, worker set-up, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows of text that a Python worker turns into results at a time.
SLICE_ROWS = 512
#: Bytes of rows that Spark hands a Python worker at a time, unless the session says otherwise.
#: By rows alone a batch of long texts is a task's whole share, held by the JVM and the worker.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, and bound what they get at a time."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a temporary one only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back; cuts lineage, survives executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few results at a time.

    After the last one the worker gives back what it no longer uses: it may lie idle while
    other stages run.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    batch = None
    release()


def release() -> None:
    """Give back to the system what this process has left free."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], schema: str
) -> DataFrame:
    """Apply ``function`` to slices of Arrow batches; it returns the columns of ``schema``."""
    prepare(df.sparkSession)
    names = df.sparkSession.createDataFrame([], schema).columns

    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(function(batch), names)

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def append_column(
    df: DataFrame,
    function: Callable[[list], pa.Array],
    source: Column,
    name: str,
    kind: str,
    as_list: bool = True,
) -> DataFrame:
    """``df`` with a column made from ``source`` by Arrow slices; the rest passes through.

    A column of that name is replaced. ``function`` gets the source's values as a list, or
    as an Arrow array.
    """
    prepare(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    given = fresh(df, "given")
    frame = df.select(*kept, source.alias(given))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[:-1]]
    names = [*frame.columns[:-1], name]

    def run(batches):
        for batch in slices(batches):
            given = batch.column(batch.num_columns - 1)
            made = function(given.to_pylist() if as_list else given)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names)

    return frame.mapInArrow(run, ", ".join([*fields, f"`{name}` {kind}"]))


def keep_rows(df: DataFrame, function: Callable[[list], list[bool]], source: Column) -> DataFrame:
    """The rows of ``df`` for which ``function`` says so of ``source``'s values."""
    prepare(df.sparkSession)
    frame = df.select(*[F.col(f"`{c}`") for c in df.columns], source.alias(fresh(df, "given")))

    def run(batches):
        for batch in slices(batches):
            stays = function(batch.column(batch.num_columns - 1).to_pylist())
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
            yield own.filter(pa.array(stays, pa.bool_()))

    return frame.mapInArrow(run, df.schema)


def arrays_of(array: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a list array of numbers, nulls as empty ones."""
    offsets, values = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
    for i, there in enumerate(array.is_valid().to_pylist()):
        yield values[offsets[i] : offsets[i + 1]] if there else values[:0]


def lists_of(array: pa.Array) -> Iterator[list]:
    """The same as lists."""
    return (values.tolist() for values in arrays_of(array))


def strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())
