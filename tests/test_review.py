"""Completeness, link checks and gates."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import gates, liveness, review
from gleanery.operators.joins import fits_broadcast, lookup_join
from gleanery.schema import ORDER_COLUMNS
from tests.builders import final_frame

VERDICTS = "url string, status int, error boolean"


def test_incomplete_rows_are_flagged_and_never_cleared(spark):
    rows = final_frame(
        spark, {}, {"program_links": ""}, {"city": " \n"}, {"review_needed": "Yes"}, {"updated_at": ""}
    )
    flags = [r.review_needed for r in review.flag_incomplete(rows).orderBy("rec_ord").collect()]
    assert flags == ["No", "Yes", "Yes", "Yes", "No"]


def expected_flags(rows, broken, limit):
    """The rule written as a loop over ordered rows."""
    flags, checked = [], 0
    for row in rows:
        flag = row["review_needed"]
        if limit != 0 and not (limit > 0 and checked == limit):
            if not row["program_links"]:
                flag = "Yes"
            else:
                checked += 1
                if row["program_links"] in broken:
                    flag = "Yes"
        flags.append(flag)
    return flags


@pytest.mark.parametrize("limit", [-1, 0, 1, 3, 17, 40, 41, 1000])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_bounded_link_check_like_a_loop(spark, limit, threshold):
    draw = random.Random(7)
    links = ["", *[f"https://h{i}.org" for i in range(6)]]
    rows = [{"program_links": draw.choice(links), "source_ord": i // 10} for i in range(60)]
    verdicts = [
        ("https://h0.org", 404, False),
        ("https://h1.org", 403, False),
        ("https://h2.org", None, True),
        ("https://h3.org", 302, False),
        ("https://h4.org", 500, False),
    ]
    broken = {"https://h0.org", "https://h2.org", "https://h4.org"}
    status = spark.createDataFrame(verdicts, VERDICTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = review.flag_broken_links(final_frame(spark, *rows), status, limit)
        got = [r.review_needed for r in out.orderBy(*ORDER_COLUMNS).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    full = [{"review_needed": "No", **r} for r in rows]
    assert got == expected_flags(full, broken, limit)


def test_lookup_join_splits_a_hot_key(spark):
    """A key with a third of the rows, at two sizes: the largest task is near the others."""
    import re

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        for size in (60_000, 240_000):
            key = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS key"
            left = spark.range(0, size, 1, 12).selectExpr("id", key, "uuid() AS pad")
            right = spark.range(0, size, 1, 4).selectExpr("id AS key", "id * 2 AS twice")
            joined = lookup_join(left, right, "key")
            by_task = joined.groupBy(F.spark_partition_id())
            tasks = by_task.agg(F.count("*").alias("count"), F.max("pad")).collect()
            assert sum(r["count"] for r in tasks) == size
            assert max(r["count"] for r in tasks) < 0.15 * size
            plan = joined.selectExpr("sum(twice)", "max(pad)")
            plan.collect()
            assert re.search("skew=true", plan._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_repeated_verdicts_do_not_repeat_rows(spark):
    from gleanery.operators.review import verdicts

    rows = [("a", 200, False), ("a", 404, False), ("b", 200, None), ("b", 200, True), ("c", None, None), (None, 404, False)]
    found = verdicts(spark.createDataFrame(rows, "url string, status int, error boolean"))
    assert {r.url: r.broken for r in found.collect() if r.url} == {"a": True, "b": True, "c": None}


def test_lookup_join_keeps_every_row_of_a_hot_key(spark):
    left = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS key")
    right = spark.range(20_000).selectExpr("id AS key", "id * 2 AS twice")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(right)
        joined = lookup_join(left, right, "key", "left")
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        wide = joined.selectExpr("count(*) n", "count(twice) m", "sum(twice) s").first()
        inner = lookup_join(left, right, "key", "inner").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fits_broadcast(right.limit(10))
    plain = left.join(right, "key", "left").selectExpr("count(*) n", "count(twice) m", "sum(twice) s")
    assert wide == plain.first()
    assert inner == wide.m


def test_gates(spark):
    good = [{} for _ in range(60)]
    passing = gates.gate_report(final_frame(spark, *good).drop("source_ord", "rec_ord", "extraction_source"))
    assert all(r.passed for r in passing.collect())
    bad = final_frame(
        spark,
        {"incentive_type": "Loan"},
        {"review_needed": "maybe", "program_links": "ftp://x"},
        {"updated_at": "2026/05/04"},
        {"program_name": "\t"},
        {"updated_at": "04-05-2026"},
    ).withColumnRenamed("rec_ord", "row_index")
    report = {r.gate: (r.passed, r.offending) for r in gates.gate_report(bad, ["x"]).collect()}
    assert report == {
        "nonempty": (True, 0),
        "columns": (False, 1),
        "incentive_type": (False, 1),
        "review_needed": (False, 1),
        "program_links": (False, 1),
        "program_name": (False, 1),
        "updated_at": (False, 2),
        "coverage": (False, 55),
    }
    values = {tuple(r) for r in gates.offending_values(bad).collect()}
    assert values == {
        ("incentive_type", "Loan"),
        ("review_needed", "maybe"),
        ("updated_at", "2026/05/04"),
        ("updated_at", "04-05-2026"),
    }
    assert gates.first_offenders(bad, "program_name", ["row_index"]).first().value == "3"
    counts = [tuple(r) for r in gates.type_distribution(bad).collect()]
    assert counts == [
        ("Finance Solutions", 0),
        ("Grants", 0),
        ("Investments", 0),
        ("Rebates", 4),
        ("Tax Credits", 0),
    ]
    assert gates.flagged_share(bad.limit(0)).first().flagged_pct == "0.0"


def test_liveness_reports(spark):
    sources = spark.createDataFrame(
        [(i, i, f"s{i}", u) for i, u in enumerate(["https://a.org/1", "https://b.org/2", "https://w.org/x", "https://z.org"])],
        "source_id long, source_ord long, name string, url string",
    )
    verdicts = spark.createDataFrame(
        [("https://a.org/1", 200, False), ("https://b.org/2", 503, False), ("https://w.org/x", None, True)], VERDICTS
    )
    statuses = [r.status for r in liveness.source_liveness(sources, verdicts, ["w.org"]).collect()]
    assert statuses == ["OK", "FAIL", "WARN", "UNKNOWN"]
    table = final_frame(spark, *[{"program_links": u} for u in ("https://b.org/2", " https://a.org/1 ", "", "https://b.org/2")])
    links = [tuple(r) for r in liveness.link_liveness(table, verdicts).collect()]
    assert links == [("https://a.org/1", "OK"), ("https://b.org/2", "FAIL")]
