"""What moves and what is sorted: plans of the stages that meet long texts, and their rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from contract import catalog
from contract import fixtures as fx
from gleanery.functions.coercion import is_object
from gleanery.operators import joins
from gleanery.operators.dedupe import keep_first
from gleanery.plans.staging import stage

SF = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def _nodes(plan):
    def parts(seq):
        return [seq.apply(i) for i in range(seq.size())]

    def walk(node):
        return [node, *(x for child in parts(node.children()) for x in walk(child))]

    root = plan._jdf.queryExecution().executedPlan()
    root = root.inputPlan() if root.nodeName() == "AdaptiveSparkPlan" else root
    return [(n.nodeName(), {a.name() for a in parts(n.output())}) for n in walk(root)]


@pytest.fixture(params=[None, "-1"])
def threshold(spark, request):
    if request.param:
        spark.conf.set(LIMIT, request.param)
    yield request.param
    spark.conf.unset(LIMIT)


def _records(spark):
    """Keys with many records, ties at the first place, null places and null keys."""
    return spark.range(0, 6_000, 1, 6).select(
        (F.col("id") % 7).alias("source_ord"),
        F.when(F.col("id") % 97 != 5, F.col("id") / 3).cast("long").alias("rec_ord"),
        F.when(F.col("id") % 3 == 0, " Hot  ").otherwise((F.col("id") % 50).cast("string")).alias("program_name"),
        F.when(F.col("id") % 4 != 0, "city").alias("level"),
        F.when(F.col("id") % 5 != 0, "x").alias("program_administrator"),
        F.repeat(F.lit("long text "), 50).alias("description"),
    )


def test_only_records_at_first_places_are_sorted_whole(spark, tmp_path, threshold):
    records = _records(spark)
    seen = []

    def written(firsts):
        seen.append(firsts.columns)
        firsts.write.parquet(str(tmp_path / "firsts"))
        return spark.read.parquet(str(tmp_path / "firsts"))

    kept = keep_first(records, written=written)
    assert kept.columns == records.columns and "description" not in seen[0]
    expected = keep_first(records)
    assert kept.count() == expected.count()
    assert kept.exceptAll(expected).isEmpty() and expected.exceptAll(kept).isEmpty()
    names = [name for name, _ in _nodes(kept)]
    join = "ShuffledHashJoin" if threshold else "BroadcastHashJoin"
    assert join in names and "SortMergeJoin" not in names


def test_records_beyond_the_limit_move_whole_once_and_few_others_with_them(spark, tmp_path):
    def written(firsts):
        firsts.write.parquet(str(tmp_path / "firsts"))
        return spark.read.parquet(str(tmp_path / "firsts"))

    settings = {LIMIT: "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        nodes = _nodes(keep_first(_records(spark), written=written))
    finally:
        for name in settings:
            spark.conf.unset(name)
    names = [name for name, _ in nodes]
    join = names.index("ShuffledHashJoin")
    assert "Exchange" not in names[:join]  # grouped where they were looked up
    moved = [place for place, (name, columns) in enumerate(nodes) if name == "Exchange" and "program_name" in columns]
    assert len(moved) == 1 and "BroadcastHashJoin" in names[moved[0] :]


@pytest.mark.parametrize("most_bits, most_others", [(joins.MOST_BITS, 2_000), (1 << 8, 19_600)])
def test_rows_that_may_be_among_others_are_all_that_are_and_few_more(spark, monkeypatch, most_bits, most_others):
    monkeypatch.setattr(joins, "MOST_BITS", most_bits)
    left = spark.range(0, 20_000).select((F.col("id") % 50).alias("a"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("b"))
    right = left.filter("a = 3").toDF("x", "y")
    kept = joins.maybe_among(left, [F.col("a"), F.col("b")], right, [F.col("x"), F.col("y")])
    assert kept.columns == left.columns and kept.filter("a = 3").count() == right.count() == 400
    assert kept.count() - 400 < most_others
    assert joins.maybe_among(left, [F.col("b")], right.limit(0), [F.col("y")]).isEmpty()


def test_texts_do_not_move_with_the_answers_they_go_into(spark):
    moved = [names for name, names in _nodes(fx.answers(spark, SF)) if name == "Exchange"]
    assert moved and not any({"text", "item", "items", "buf"} & names for names in moved)


def test_answers_are_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    def rows():
        return {tuple(r) for r in fx.answers(spark, SF).selectExpr("source_id", "first_pos", "md5(payload)").collect()}

    few = rows()
    monkeypatch.setattr(fx, "TASK_CHARS", 10_000)  # many tasks
    assert rows() == few
    spark.conf.set(LIMIT, "-1")
    try:
        assert rows() == few
    finally:
        spark.conf.unset(LIMIT)


def test_code_that_writes_answers_is_small_enough_to_be_compiled(spark, capsys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fx.answers(spark, SF).explain(mode="codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000  # the JVM interprets larger methods


def test_values_are_picked_by_place(spark):
    places = spark.createDataFrame([(n,) for n in (-1, 0, 1, 2, 3, None)], "n long")
    rows = places.select(fx.pick(F.col("n"), ["a", None, "c"]).alias("v")).collect()
    assert [r.v for r in rows] == [None, "a", None, "c", None, None]


def test_objects_are_told_without_naming_their_fields(spark):
    texts = ['{}', '{"a": {"b": 1}}', '[]', '[{}]', '"x"', "1", "true", "null", '{"not-a-number-3f9d0c": 0}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", is_object(F.parse_json("t")).alias("o"))
    assert [r.o for r in rows.collect()] == [True, True] + [False] * 7
    assert "schema_of_variant" not in rows._jdf.queryExecution().optimizedPlan().toString()


#: What a query reads of typed records once they are written.
READ = {
    "e06_typed_extraction": None,  # what it returns
    "i05_append_records": ["source_ord"],
    "a08_audit_jsonl": ["source_id"],
    "e03_absent_hints": None,
    "e04_falsy_hints": None,
    "e05_null_lists": ["source_id", "rec_ord", "eligible_property_types", "zip_codes"],
    "f17_run_date": ["last_verified_at"],
    "h02_records_per_source": ["source_id"],
    "b05_row_validity": ["source_ord", "rec_ord", "source_id", "program_name"],
}


def test_staged_texts_are_packed_tightly(spark, tmp_path):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts.coalesce(1).write.parquet(str(tmp_path / "plain"))
    staged = stage(texts.coalesce(1), str(tmp_path), "staged")
    assert sorted(staged.collect()) == sorted(texts.collect())
    plain, packed = (sum(p.stat().st_size for p in (tmp_path / n).glob("*.parquet")) for n in ("plain", "staged"))
    assert packed < 0.8 * plain


def test_places_that_may_be_broadcast_keep_the_codec_of_the_session(spark):
    firsts = fx.firsts_writer(spark)(spark.range(5).toDF("place"))
    assert not any(".zstd." in file for file in firsts.inputFiles()) and firsts.count() == 5


@pytest.mark.parametrize("name", READ)
def test_typed_records_are_written_in_the_columns_read_later(spark, monkeypatch, name):
    written = {}

    def watched(df, folder, table):
        written[table] = df.columns
        return stage(df, folder, table)

    monkeypatch.setattr(catalog, "stage", watched)
    rows = catalog.QUERIES[name](spark, SF)
    assert set(written["raw"]) == {*(READ[name] or rows.columns), "reject_reasons"}
    monkeypatch.setitem(catalog.QUERIES, name, lambda *_: rows)
    assert difference(spark, connect(SF), name, SF) is None
