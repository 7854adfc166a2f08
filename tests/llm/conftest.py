from __future__ import annotations

import duckdb
import pytest

from messy_rows import MESSY, MESSY_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def texts():
    """``(doc_id, text)`` of the smallest tables, read without Spark."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(MESSY, MESSY_COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], MESSY_COLUMNS)
