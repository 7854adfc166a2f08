"""Registered queries beside their SQL, one or two of each family; compare.py runs all."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from contract import catalog

SF = "/root/testdata/sf0.001"
SOME = [
    "a05_csv_sink",
    "b05_row_validity",
    "b07_unprintable_dropped",
    "c03_extraction_request",
    "c04_final_projection",
    "d01_visible_text",
    "e06_typed_extraction",
    "f06_significant_digits",
    "g02_audit_join",
    "h01_first_wins",
    "i01_bounded_link_check",
    "j05_gate_report",
    "k01_injected_pages",
]


def test_every_query_has_its_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["host", "pages", "text_chars", "needs_render"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", SOME)
def test_query_matches_its_sql(spark, name):
    assert difference(spark, connect(SF), name, SF) is None


def test_entry_without_the_corpus_package():
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import sys; sys.modules['gleanery.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "print('pipeline' in e.queries(), len(e.queries()) == len(e.oracle_sql()))"
    )
    root = Path(__file__).resolve().parents[1]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["False", "True"]
