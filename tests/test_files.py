"""Written files: header, quoting, order, counts, and reading them back."""

from __future__ import annotations

import csv
import json
from datetime import datetime
from pathlib import Path

from gleanery.schema import TABLE_COLUMNS
from gleanery.sources import readers, sinks
from tests.builders import final_frame


def parts(path) -> list[list[list[str]]]:
    """Rows of every part file, in file order."""
    files = sorted(Path(path).glob("part-*.csv"))
    return [list(csv.reader(f.open(newline="", encoding="utf-8"))) for f in files]


def test_header_order_and_quoting(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [
        {"program_name": 'say "hi", twice', "description": "two\nlines", "rec_ord": 1},
        {"program_name": "first ≤", "city": "", "rec_ord": 0},
    ]
    assert sinks.write_table(final_frame(spark, *rows), path) == 2
    (written,) = parts(path)
    assert written[0] == TABLE_COLUMNS
    assert [r[0] for r in written[1:]] == ["first ≤", 'say "hi", twice']
    assert written[1][2] == "" and written[2][5] == "two\nlines"
    back = readers.read_table(spark, path).orderBy("row_index").collect()
    assert [(r.row_index, r.program_name) for r in back] == [(0, "first ≤"), (1, 'say "hi", twice')]
    assert back[0].city == "" and back[1].description == "two\nlines"
    assert readers.header_of(spark, path) == TABLE_COLUMNS


def test_header_without_rows(spark, tmp_path):
    path = str(tmp_path / "empty")
    assert sinks.write_table(final_frame(spark).limit(0), path) == 0
    assert [p[0] for p in parts(path)] == [TABLE_COLUMNS]
    assert readers.read_table(spark, path).count() == 0


def test_review_queue_holds_flagged_rows_with_provenance(spark, tmp_path):
    path = str(tmp_path / "review")
    frame = final_frame(spark, {}, {"review_needed": "Yes", "extraction_source": ""})
    assert sinks.write_review_queue(frame, path) == 1
    (written,) = parts(path)
    assert written[0] == [*TABLE_COLUMNS, "extraction_source"]
    assert written[1][-1] == "unknown"


def test_rows_are_numbered_across_files(spark, tmp_path):
    path = str(tmp_path / "many")
    frame = final_frame(spark, *[{"description": str(i)} for i in range(500)])
    spread = frame.repartition(7).orderBy("rec_ord").select(*sinks.table_columns())
    spread.write.option("header", True).option("maxRecordsPerFile", 90).csv(path)
    assert len(parts(path)) > 5
    rows = readers.read_table(spark, path).collect()
    assert sorted(r.row_index for r in rows) == list(range(500))
    assert all(r.description == str(r.row_index) for r in rows)


def test_links_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "named")
    spark.createDataFrame([("x", "https://a"), ("y", None)], "other string, program_links string").write.option(
        "header", True
    ).csv(path)
    links = readers.read_links(spark, path)
    assert links.columns == ["program_links"]
    assert {r[0] for r in links.collect()} == {"https://a", None}


def test_audit_lines(spark, tmp_path):
    rows = [(1, "b", None, "city", "empty", 0, 0, 0.0), (0, "a", "https://a", "state", "html_text", 12, 3, 0.25)]
    schema = (
        "source_ord long, source string, url string, level string, content_type string, "
        "text_chars long, records long, elapsed_s double"
    )
    started = datetime(2026, 5, 4, 2, 45, 36)
    path = sinks.write_audit(spark.createDataFrame(rows, schema), str(tmp_path), started)
    assert path.endswith("run_20260504T024536.jsonl")
    lines = [
        json.loads(line)
        for f in sorted(Path(path).glob("part-*.json"))
        for line in f.read_text(encoding="utf-8").splitlines()
    ]
    assert [line["source"] for line in lines] == ["a", "b"]
    assert list(lines[0]) == ["source", "url", "level", "content_type", "text_chars", "records", "elapsed_s"]
    assert lines[1]["url"] is None


def test_registry_defaults(spark, tmp_path):
    path = str(tmp_path / "registry")
    header = "source_id,source_ord,name,url,level,state,county,city,utility,render,wait_selector,timeout_ms"
    Path(path).mkdir()
    Path(path, "r.csv").write_text(f'{header}\n7,0,"Town, rebates",https://t.org,city,,,Tampa,,,,\n', encoding="utf-8")
    row = readers.read_registry(spark, path, "csv").first()
    assert (row.name, row.state, row.county, row.render, row.timeout_ms) == ("Town, rebates", "FL", "", "auto", 45000)


def test_headers_of_all_files(spark, tmp_path):
    from gleanery.plans import build

    path = str(tmp_path / "table")
    sinks.write_table(final_frame(spark, {}, {}), path)
    assert readers.header_of(spark, path) == TABLE_COLUMNS
    (tmp_path / "table" / "part-99999-x-c000.csv").write_text("wrong,header\n")
    assert readers.header_of(spark, path) == ["wrong", "header"]
    code, report = build.gate(spark, path)
    assert code == 1 and not {r.gate: r.passed for r in report.collect()}["columns"]


def test_a_header_alone_is_not_empty(spark, tmp_path):
    from gleanery.plans import build

    path = str(tmp_path / "table")
    sinks.write_table(final_frame(spark).limit(0), path)
    passed = {r.gate: r.passed for r in build.gate(spark, path)[1].collect()}
    assert passed["nonempty"] and passed["columns"] and not passed["coverage"]


def test_gates_of_files_are_those_of_their_rows(spark, tmp_path):
    from gleanery.operators import gates

    path = str(tmp_path / "table")
    rows = [{"incentive_type": "", "description": "two\nlines"}, {"updated_at": "x"}] * 40
    frame = final_frame(spark, *[{**r, "description": f"{i}"} for i, r in enumerate(rows)])
    spread = frame.repartition(5).select(*sinks.table_columns())
    spread.write.options(**sinks._CSV).csv(path)
    given = sorted(gates.gate_report(readers.read_table(spark, path, numbered=False)).collect())
    assert {r.gate: r.offending for r in given}["incentive_type"] == 40
    lines = readers.read_lines(spark, path)
    assert sorted(gates.gate_files(lines).collect()) == given
    plan = gates.gate_files(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan
    # a longer header, and the right one once more
    name = ",".join(TABLE_COLUMNS)
    for i, (header, passes) in enumerate([(name, True), (f"{name},more", False)]):
        (tmp_path / "table" / f"part-9999{i}-x-c000.csv").write_text(f"{header}\n")
        report = {r.gate: r for r in gates.gate_files(readers.read_lines(spark, path)).collect()}
        assert report["columns"].passed == passes and report["columns"].offending == 1 - passes
        assert report["incentive_type"].offending == 40


def test_no_line_at_all(spark, tmp_path):
    from gleanery.operators import gates

    (tmp_path / "part-00000.csv").write_text("")
    report = {r.gate: r for r in gates.gate_files(readers.read_lines(spark, str(tmp_path))).collect()}
    assert not report["nonempty"].passed and not report["columns"].passed
    assert report["coverage"].offending == 60 and report["updated_at"].passed
