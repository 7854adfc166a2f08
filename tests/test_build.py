"""Whole jobs on a handful of sources."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanery.functions.urls import url_key
from gleanery.operators import registry as reg
from gleanery.operators.captures import one_per_source, read_captures, worth_extracting
from gleanery.operators.requests import extraction_requests, locks_temperature
from gleanery.plans import build
from gleanery.plans.staging import stage
from gleanery.schema import (
    ANSWER_SCHEMA,
    CAPTURE_SCHEMA,
    INCENTIVE_TYPES,
    REGISTRY_SCHEMA,
    TABLE_COLUMNS,
)
from gleanery.sources.readers import read_table, with_registry_defaults
from gleanery.streaming.ingest import answer_stream, start_ingest

BODY = "<p>" + "A page about a $1,000 rebate for new roofs. " * 12 + "</p>"
SOURCES = [
    ("Tampa Homes", "https://tampa.example.org", "city", {"city": "Tampa"}),
    ("Lake Energy", "https://lake.example.org", "county", {"county": "Lake"}),
    ("Tax Office", "https://tax.example.org", "federal", {}),
    ("Grid Savings", "https://grid.example.org", "utility", {"utility": "Grid Co"}),
]


def registry(spark):
    rows = []
    for i, (name, url, level, places) in enumerate(SOURCES):
        row = {"source_id": i, "source_ord": i, "name": name, "url": url, "level": level, **places}
        rows.append(tuple(row.get(f.name) for f in REGISTRY_SCHEMA.fields))
    return with_registry_defaults(spark.createDataFrame(rows, REGISTRY_SCHEMA))


def captures(spark, html=BODY, skip=()):
    rows = [
        (i, url, 200, False, "text/html", html, None, None, 0.123)
        for i, (_, url, _, _) in enumerate(SOURCES)
        if i not in skip
    ]
    return spark.createDataFrame(rows, CAPTURE_SCHEMA)


def one_per_request(asked):
    program = F.struct(
        F.concat("name", F.lit(" program")).alias("program_name"),
        F.lit("rebate").alias("type"),
        F.lit("up_to").alias("amount_type"),
        F.lit(1000).alias("amount_value"),
        F.lit("2030-12-31").alias("expires_at"),
        F.lit("Owners only.").alias("eligibility_notes"),
        F.lit(0.85).alias("confidence_score"),
    )
    return asked.select("source_id", F.to_json(F.struct(F.array(program).alias("programs"))).alias("payload"))


def written(path):
    files = sorted(Path(path).glob("part-*.csv"))
    return [row for f in files for row in csv.reader(f.open(newline="", encoding="utf-8"))]


@pytest.fixture
def places(tmp_path):
    return {
        "output_path": str(tmp_path / "table"),
        "review_path": str(tmp_path / "review"),
        "log_dir": str(tmp_path / "logs"),
    }


def test_run_writes_table_queue_and_audit(spark, places):
    counts = build.run(
        registry(spark), captures(spark), extract=one_per_request, run_date=date(2026, 2, 1), **places
    )
    header, *rows = written(places["output_path"])
    assert header == TABLE_COLUMNS
    assert [r[0] for r in rows] == [f"{name} program" for name, *_ in SOURCES]
    assert [r[2] for r in rows] == ["Tampa", "Lake County", "Federal", "Grid Co territory"]
    assert all(r[3] in INCENTIVE_TYPES and r[7] == "Up to $1,000" for r in rows)
    assert counts == {"before": 4, "after": 4, "records": 4, "flagged": 0}
    (log,) = Path(places["log_dir"]).glob("run_*.jsonl")
    lines = spark.read.json(str(log)).orderBy("source").collect()
    assert [(r.source, r.records, r.elapsed_s) for r in lines] == [
        (n, 1, 0.12) for n in sorted(name for name, *_ in SOURCES)
    ]
    code, report = build.gate(spark, places["output_path"])
    assert code == 1 and {r.gate for r in report.collect() if not r.passed} == {"coverage"}
    assert build.gate(spark, places["output_path"] + "-none") == (2, None)


def test_empty_pages_give_a_header_only(spark, places):
    counts = build.run(
        registry(spark), captures(spark, html=""), extract=one_per_request, run_date="2026-02-01", **places
    )
    assert counts == {"before": 0, "after": 0, "records": 0, "flagged": 0}
    assert written(places["output_path"]) == [TABLE_COLUMNS]


def test_nothing_selected_writes_nothing(spark, places):
    counts = build.run(
        registry(spark),
        captures(spark),
        extract=one_per_request,
        names=["no such source"],
        run_date="2026-02-01",
        **places,
    )
    assert counts == {"before": 0, "after": 0, "records": 0, "flagged": 0}
    assert not Path(places["output_path"]).exists()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_failing_source_leaves_the_others(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_failing_source(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_failing_source(spark):
    answers = spark.createDataFrame(
        [(i, 0, p) for i, p in enumerate(['{"programs":[{"program_name":"a"},{"x":1}]}', "oops", '{"programs":[{"program_name":"b"}]}'])],
        "source_id long, first_pos long, payload string",
    )
    built = build.build(registry(spark), captures(spark, skip=(2,)), answers, run_date="2026-02-01")
    audit = {r.source: (r.content_type, r.records) for r in built.audit.collect()}
    assert audit == {
        "Tampa Homes": ("html_text", 1),
        "Lake Energy": ("html_text", 0),
        "Tax Office": ("empty", 0),
        "Grid Savings": ("html_text", 0),
    }
    assert [r.program_name for r in built.table.collect()] == ["a"]
    assert built.rejects.first().reject_reasons == ["program_name"]


def test_answers_or_extract(spark):
    with pytest.raises(ValueError):
        build.build(registry(spark), captures(spark), run_date="2026-02-01")


def test_python_extractor(spark):
    def extract(asked):
        def read(batches):
            for batch in batches:
                batch["payload"] = '{"programs":[{"program_name":"' + batch["name"] + '"}]}'
                yield batch[["source_id", "payload"]]

        return asked.select("source_id", "name").mapInPandas(read, "source_id long, payload string")

    built = build.build(registry(spark), captures(spark), extract=extract, names=["tampa", "TAX"], run_date="2026-02-01")
    assert {r.program_name for r in built.table.collect()} == {"Tampa Homes", "Tax Office"}


def test_selection_is_literal_and_ignores_case(spark):
    sources = registry(spark)
    assert reg.select_sources(sources, None).count() == reg.select_sources(sources, []).count() == 4
    assert [r.name for r in reg.select_sources(sources, ["ENERGY", "tax o"]).orderBy("source_ord").collect()] == [
        "Lake Energy",
        "Tax Office",
    ]
    assert reg.select_sources(sources, ["%", "_"]).count() == 0


def test_jurisdiction(spark):
    out = registry(spark).orderBy("source_ord").select(reg.jurisdiction().alias("j")).collect()
    assert [r.j for r in out] == ["Tampa, FL", "Lake, FL", "United States", "Grid Co service territory"]


def test_captured_and_waiting(spark):
    sources = registry(spark)
    done = sources.limit(1).select(url_key(F.col("url")).alias("url_sha"))
    done = done.unionByName(done)
    assert reg.already_captured(sources, done).count() == 1
    assert reg.still_to_capture(sources, done).count() == 3


CHOICES = [
    # render, status, error, header, static, pdf, rendered -> type, needs browser, chars > 0
    ("auto", 200, False, "text/html", BODY, None, None, "html_text", False, True),
    ("auto", 200, False, "text/html", "short", None, BODY, "js_text", True, True),
    ("auto", 200, False, "text/html", "short", None, None, "html_text", True, True),
    ("auto", 404, False, "text/html", BODY, None, None, "empty", True, False),
    ("auto", None, True, None, None, None, None, "empty", True, False),
    ("static", 200, False, "text/html", "short", None, BODY, "html_text", False, True),
    ("static", 503, False, None, BODY, None, BODY, "empty", False, False),
    ("js", 200, False, "text/html", BODY, None, BODY, "js_text", True, True),
    ("js", 200, False, "text/html", BODY, None, "<script>x</script>", "empty", True, False),
    ("auto", 200, False, "Application/PDF", None, "x" * 500, None, "pdf_text", False, True),
    ("static", 200, False, None, None, None, None, "html_text", False, False),
]


def test_capture_choice(spark):
    rows = [
        (i, f"https://a.org/{i}", status, error, header, static, pdf, rendered, 0.0)
        for i, (_, status, error, header, static, pdf, rendered, *_) in enumerate(CHOICES)
    ]
    sources = spark.createDataFrame(
        [(i, "https://a.org", c[0]) for i, c in enumerate(CHOICES)], "source_id long, url string, render string"
    )
    out = read_captures(spark.createDataFrame(rows, CAPTURE_SCHEMA), sources).orderBy("source_id").collect()
    assert [(r.content_type, r.needs_render, r.text_chars > 0) for r in out] == [c[7:] for c in CHOICES]
    assert out[1].final_url == "https://a.org" and out[0].final_url == "https://a.org/0"
    assert out[4].final_url == "https://a.org"


def test_requests_clip_and_skip_short_pages(spark):
    pages = registry(spark).select("*", F.lit("").alias("final_url"), F.lit("html_text").alias("content_type"))
    text = F.when(F.col("source_id") == 0, F.lit(" " * 50 + "x" * 39)).otherwise(F.repeat(F.lit("%s {y}"), 5000))
    pages = pages.withColumn("text", text).withColumn("extractable", worth_extracting(F.col("text")))
    asked = extraction_requests(pages, limit=100).orderBy("source_id").collect()
    assert [r.source_id for r in asked] == [1, 2, 3]
    assert asked[0].content == ("%s {y}" * 20)[:100] and asked[0].source_url == "https://lake.example.org"
    assert asked[0].prompt.endswith(asked[0].content + "\n") and asked[0].temperature == 0.0
    names = ["o1-mini", "O3", "gpt-5", "gpt-4o-mini", "", "go1"]
    frame = spark.createDataFrame([(n,) for n in names], "m string")
    assert [r.l for r in frame.select(locks_temperature(F.col("m")).alias("l")).collect()] == [
        True,
        True,
        True,
        False,
        False,
        False,
    ]


def test_links_are_checked_in_a_build(spark):
    verdicts = registry(spark).select("url", F.lit(404).alias("status"), F.lit(False).alias("error"))
    built = build.build(
        registry(spark),
        captures(spark),
        extract=one_per_request,
        run_date="2026-02-01",
        link_status=verdicts,
        check_links=2,
    )
    flags = [r.review_needed for r in built.table.orderBy("source_ord").collect()]
    assert flags == ["Yes", "Yes", "No", "No"]


def test_links_job(spark):
    sources = registry(spark)
    verdicts = sources.select("url", F.lit(200).alias("status"), F.lit(False).alias("error"))
    assert build.check_links(sources, verdicts)[0] == 0
    failing = verdicts.withColumn("status", F.when(F.col("url").contains("lake"), 500).otherwise(200))
    code, report, links = build.check_links(sources, failing)
    assert code == 1 and links is None and report.filter("status = 'FAIL'").count() == 1


def test_stream_of_answers_gives_the_batch_records(spark, tmp_path):
    payloads = [(i % 4, i, f'{{"programs":[{{"program_name":"p{i}"}},{{"bad":1}}]}}') for i in range(20)]
    answers = spark.createDataFrame(payloads, ANSWER_SCHEMA)
    pages = read_captures(captures(spark), registry(spark))
    hints = stage(build.source_hints(pages), str(tmp_path), "hints")
    day = build.run_date_column("2026-02-01")
    incoming, out, mark = (str(tmp_path / n) for n in ("incoming", "out", "mark"))
    for half in (answers.filter("first_pos < 10"), answers.filter("first_pos >= 10")):
        half.write.mode("append").parquet(incoming)
        start_ingest(answer_stream(spark, incoming), hints, day, out, mark).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = build.raw_records(answers, hints, day)
    assert streamed.count() == batch.count() == 40
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0


def test_read_table_of_a_run(spark, places):
    build.run(
        registry(spark), captures(spark), extract=one_per_request, run_date="2026-02-01", include_source=True, **places
    )
    table = read_table(spark, places["output_path"], include_source=True)
    assert {r.extraction_source for r in table.collect()} == {"llm"}


def test_a_failing_request_ends_nothing(spark, places):
    def extract(request):
        if request["name"] == "Lake Energy":
            raise RuntimeError("no answer")
        return '{"programs": [{"program_name": "P", "level": "state"}]}'

    built = build.build(
        registry(spark), captures(spark), extract=build.each_request(extract), run_date="2026-02-01"
    )
    assert [tuple(r) for r in built.failures.collect()] == [(1, "RuntimeError: no answer")]
    counts = {r.source: r.records for r in built.audit.collect()}
    assert counts == {"Tampa Homes": 1, "Lake Energy": 0, "Tax Office": 1, "Grid Savings": 1}
    assert built.table.count() == 1


def test_recrawled_sources_count_once(spark):
    again = captures(spark).withColumns({"error": F.lit(True), "status": F.lit(500)})
    both = captures(spark).unionByName(again)
    built = build.build(registry(spark), both, extract=one_per_request, run_date="2026-02-01")
    assert {(r.source, r.records, r.content_type) for r in built.audit.collect()} == {
        (name, 1, "html_text") for name, *_ in SOURCES
    }
    assert built.records.count() == len(SOURCES)


def recrawls(spark):
    """Each source's good capture, with what must lose against it or is the same."""
    good = captures(spark)
    bad = good.withColumns({"error": F.lit(True), "status": F.lit(500)})
    unknown = good.withColumns({
        "error": F.lit(None).cast("boolean"), "status": F.lit(None).cast("int"), "static_html": F.lit("<p>unknown</p>"),
    })
    return good.unionByName(unknown).unionByName(bad).unionByName(good)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_the_capture_of_a_recrawled_source(spark, tmp_path, limit):
    """An unknown status loses against a known one; both ways of joining give the same texts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        one = one_per_source(recrawls(spark), registry(spark), lambda d: stage(d, str(tmp_path), "first"))
        texts = read_captures(one, registry(spark)).select("source_id", "text", "final_url").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = read_captures(captures(spark), registry(spark)).select("source_id", "text", "final_url").collect()
    assert sorted(texts) == sorted(want)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_no_markup_in_any_exchange(spark, tmp_path, limit):
    """With a recrawl present, what is shuffled or broadcast holds neither markup column."""
    good = captures(spark)
    both = good.unionByName(good.withColumns({"status": F.lit(404), "static_html": F.lit("<p>gone</p>")}))
    both.write.parquet(str(tmp_path / "captures"))
    both = spark.read.parquet(str(tmp_path / "captures"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        one = one_per_source(both, registry(spark), lambda d: stage(d, str(tmp_path), "first"))
        pages = read_captures(one, registry(spark))
        root = pages._jdf.queryExecution().executedPlan().initialPlan()
        assert pages.count() == len(SOURCES)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def parts(of):
        return [of.apply(i) for i in range(of.size())]

    def nodes(node):
        return [node, *(x for child in parts(node.children()) for x in nodes(child))]

    moved = [{a.name() for a in parts(n.output())} for n in nodes(root) if "Exchange" in n.nodeName()]
    assert moved and not any({"static_html", "rendered_html"} & names for names in moved)


def test_answers_out_of_order_and_missing_verdicts_are_refused(spark):
    answers = spark.createDataFrame([(0, "{}"), (0, "{}")], "source_id long, payload string")
    with pytest.raises(ValueError, match="first_pos"):
        build.build(registry(spark), captures(spark), answers, run_date="2026-02-01")
    with pytest.raises(ValueError, match="link_status"):
        build.build(registry(spark), captures(spark), answers, run_date="2026-02-01", check_links=5)


def test_staged_tables_are_removed(spark, places, monkeypatch):
    folders = []
    real = build.remove
    monkeypatch.setattr(build, "remove", lambda s, folder: (folders.append(folder), real(s, folder)))
    build.run(registry(spark), captures(spark), extract=one_per_request, run_date="2026-02-01", **places)
    assert len(folders) == 1 and not Path(folders[0].removeprefix("file:")).exists()


def test_markup_is_read_above_the_join_with_a_small_registry(spark):
    pages = read_captures(captures(spark), registry(spark).limit(10))
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner") :]
    assert "regexp_replace" not in below and "static_html" in below
