"""Tables written between stages, in the folder the cluster names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach."""
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    return f"{base.rstrip('/')}/gleanery-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged tables once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, folder: str, name: str, packed: bool = True) -> DataFrame:
    """Write ``df`` and read it back: later stages neither repeat its work nor lose it.

    Texts make up most of what is staged, so it is written with the codec that packs them best.
    Narrow tables that may be broadcast are left to the session's, by which their size is judged.
    """
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite")
    if packed:
        writer = writer.option("compression", "zstd")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
