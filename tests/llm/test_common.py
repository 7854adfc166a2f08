from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from gleanery.llm import common


def test_workers_get_long_texts_in_bounded_batches(spark):
    def sizes(batches):
        for b in batches:
            columns = [pa.array([b.num_rows]), pa.array([b.nbytes]), pa.array([max(map(len, b.column(1).to_pylist()))])]
            yield pa.RecordBatch.from_arrays(columns, ["n", "bytes", "longest"])

    size = F.when(F.col("id") == 7, 3 * common.BATCH_BYTES).otherwise(100_000)
    texts = spark.range(0, 300, 1, 1).select("id", F.repeat(F.lit("x"), size.cast("int")).alias("text"))
    common.prepare(spark)
    seen = texts.mapInArrow(sizes, "n long, bytes long, longest long").collect()
    assert sum(r.n for r in seen) == 300  # and a text beyond the bound goes whole
    assert max(r.longest for r in seen) == 3 * common.BATCH_BYTES
    assert all(r.bytes < r.longest + 2 * common.BATCH_BYTES for r in seen)


def test_a_sessions_own_batch_size_stays(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    common.prepare(other)
    assert other.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
