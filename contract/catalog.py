"""Every registered query beside the SQL it must agree with."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import fixtures as fx
from contract import sqltext as q
from gleanery.functions import coercion, markup, text, urls
from gleanery.operators import answers as answering
from gleanery.operators import (
    audit,
    captures,
    dedupe,
    gates,
    liveness,
    normalise,
    registry,
    requests,
    review,
)
from gleanery.plans import build
from gleanery.plans.staging import shared_folder, stage
from gleanery.schema import (
    AMOUNT_TYPES,
    LEVELS,
    ORDER_COLUMNS,
    PROVENANCE_COLUMN,
    RAW_TYPES,
    TABLE_COLUMNS,
)
from gleanery.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Links the bounded check probes.
LINK_CHECKS = 50
MAX_REQUEST_CHARS = requests.MAX_CONTENT_CHARS


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def flat(items: Column) -> Column:
    """A list as text, so that results hold plain values only."""
    return F.array_join(items, "|")


def digest(value: Column) -> Column:
    """Fingerprint of a long text, over all of it."""
    return F.md5(value)


TABLE = ", ".join(TABLE_COLUMNS)
PLACE = ", ".join(ORDER_COLUMNS)


def _pages(spark, sf):
    """Pages read, written once like a build does, so that filters do not read them again."""
    return stage(fx.pages(spark, sf), shared_folder(spark), "pages")



def _raw(spark, sf, pages=None, answers=None):
    """Typed records of the answers, by default the ones of the fixtures."""
    hints = build.source_hints(pages or _pages(spark, sf))
    return build.raw_records(answers or fx.answers(spark, sf), hints, fx.run_date())


def _written_once(spark, raw, *columns):
    """Columns of typed records, written once before any filter like a build does.

    A build writes whole records since its table has them all. A query names the columns it
    reads, so that long texts are typed and checked but written only where they are read.
    """
    return stage(raw.select(*columns, "reject_reasons"), shared_folder(spark), "raw")


def _typed(spark, sf, *columns, pages=None):
    return _written_once(spark, _raw(spark, sf, pages), *columns)


# --- scans and sinks ------------------------------------------------------------------

_REGISTRY_COLUMNS = (
    "source_id, source_ord, name, url, level, state, county, city, utility, render, timeout_ms"
)


@query("a01_registry_scan", f"WITH {q.REGISTRY} SELECT {_REGISTRY_COLUMNS} FROM registry")
def _(spark, sf):
    path = f"{shared_folder(spark)}/registry"
    fx.registry(spark, sf).write.parquet(path)
    return readers.read_registry(spark, path).drop("wait_selector")


@query(
    "a02_page_text",
    f"""WITH {q.PAGES} SELECT source_id, content_type, final_url, needs_render,
    length(text) AS text_chars, md5(text) AS text_md5 FROM page_texts""",
)
def _(spark, sf):
    pages = fx.pages(spark, sf)
    return pages.select(
        "source_id",
        "content_type",
        "final_url",
        "needs_render",
        "text_chars",
        digest(F.col("text")).alias("text_md5"),
    )


def _captured(spark, sf):
    """Addresses captured so far: those of two pages in three."""
    done = fx.load(spark, sf, "pages").filter("page_id % 3 <> 0")
    return done.select(urls.url_key(F.col("url")).alias("url_sha"))


@query(
    "a03_capture_key",
    "SELECT page_id AS source_id, sha256(url) AS url_sha FROM pages WHERE page_id % 3 = 0",
)
def _(spark, sf):
    waiting = registry.still_to_capture(fx.registry(spark, sf), _captured(spark, sf))
    return waiting.select("source_id", "url_sha")


@query(
    "a04_answer_scan",
    """SELECT event_id % (SELECT count(*) FROM pages) AS source_id, count(*) AS entries,
    event_id % (SELECT count(*) FROM pages) <> 3 AS readable FROM events GROUP BY 1, 3""",
)
def _(spark, sf):
    path = f"{shared_folder(spark)}/answers"
    fx.answers(spark, sf).write.parquet(path)
    body = coercion.parse_json(F.col("payload"))
    programs = F.try_variant_get(body, "$.programs", "array<variant>")
    # The unreadable answer is counted by its commas between entries.
    separators = F.size(F.split("payload", r"(?<=[}\"]),(?=[{\"]just|\{\"program)"))
    return (
        readers.read_answers(spark, path)
        .groupBy("source_id")
        .agg(
            F.sum(F.coalesce(F.size(programs), separators)).alias("entries"),
            F.bool_and(programs.isNotNull()).alias("readable"),
        )
    )


def _written(spark, sf, include_source=False, table=None):
    path = f"{shared_folder(spark)}/table"
    sinks.write_table(
        fx.finished(spark, sf) if table is None else table, path, include_source=include_source
    )
    return path


_NUMBERED = "row_number() OVER (ORDER BY source_ord, rec_ord) - 1 AS row_index"


@query("a05_csv_sink", f"WITH {q.FINAL} SELECT {_NUMBERED}, {TABLE} FROM final")
def _(spark, sf):
    return readers.read_table(spark, _written(spark, sf))


@query(
    "a06_provenance_column",
    f"WITH {q.FINAL} SELECT {_NUMBERED}, program_name, 'llm' AS {PROVENANCE_COLUMN} FROM final",
)
def _(spark, sf):
    path = _written(spark, sf, include_source=True)
    return readers.read_table(spark, path, include_source=True).select(
        "row_index", "program_name", PROVENANCE_COLUMN
    )


@query(
    "a07_review_queue_sink",
    f"WITH {q.FINAL} SELECT {_NUMBERED}, {TABLE}, 'llm' AS {PROVENANCE_COLUMN} "
    "FROM final WHERE review_needed = 'Yes'",
)
def _(spark, sf):
    path = f"{shared_folder(spark)}/review"
    sinks.write_review_queue(fx.finished(spark, sf), path)
    return readers.read_table(spark, path, include_source=True)


def _audit(spark, sf):
    """Pages read, and the accepted records of their answers, counted."""
    pages = _pages(spark, sf)
    return audit.audit(pages, answering.accepted(_typed(spark, sf, "source_id", pages=pages)))


_AUDIT = f"""{q.RAW}, {q.PAGES}, {q.ANSWERED},
audit AS (
  SELECT p.source_ord, p.name AS source, p.url, p.level, p.content_type,
    length(p.text) AS text_chars, coalesce(n.records, 0) AS records,
    CAST(format('{{:.2f}}', p.elapsed) AS DOUBLE) AS elapsed_s
  FROM page_texts p
  LEFT JOIN (SELECT source_id, count(*) AS records FROM answered GROUP BY 1) n USING (source_id))"""


@query("a08_audit_jsonl", f"WITH {_AUDIT} SELECT * EXCLUDE (source_ord) FROM audit")
def _(spark, sf):
    path = sinks.write_audit(_audit(spark, sf), shared_folder(spark), datetime(2026, 2, 1, 3, 4, 5))
    schema = (
        "source string, url string, level string, content_type string, "
        "text_chars bigint, records bigint, elapsed_s double"
    )
    return spark.read.schema(schema).json(path)


@query(
    "a09_positional_scan",
    f"WITH {q.FINAL} SELECT {_NUMBERED}, incentive_type AS column_3, "
    "review_needed AS column_10 FROM final",
)
def _(spark, sf):
    table = readers.read_table(spark, _written(spark, sf))
    return table.select(
        "row_index",
        F.col(table.columns[3]).alias("column_3"),
        F.col(table.columns[10]).alias("column_10"),
    )


@query(
    "a10_link_column_scan",
    f"WITH {q.FINAL} SELECT nullif(program_links, '') AS program_links, count(*) AS n "
    "FROM final GROUP BY 1",
)
def _(spark, sf):
    links = readers.read_links(spark, _written(spark, sf))
    return links.groupBy("program_links").agg(F.count("*").alias("n"))


# --- filters ---------------------------------------------------------------------------


@query(
    "b01_source_selection",
    f"WITH {q.REGISTRY} SELECT source_id, name FROM registry "
    "WHERE contains(lower(name), 'th') OR contains(lower(name), '_') OR contains(lower(name), 'example.net')",
)
def _(spark, sf):
    chosen = registry.select_sources(fx.registry(spark, sf), ["TH", "_", "example.NET"])
    return chosen.select("source_id", "name")


@query(
    "b02_non_empty_page",
    f"WITH {q.PAGES} SELECT source_id FROM page_texts WHERE text <> ''",
)
def _(spark, sf):
    pages = _pages(spark, sf)
    return pages.filter(text.has_text(F.col("text"))).select("source_id")


@query(
    "b03_minimum_content",
    "SELECT doc_id FROM documents WHERE length(trim(text, E' \\n\\t\\r')) >= 40",
)
def _(spark, sf):
    documents = fx.load(spark, sf, "documents")
    return documents.filter(captures.worth_extracting(F.col("text"))).select("doc_id")


@query(
    "b04_object_entries",
    f"""WITH {q.EV} SELECT event_id % (SELECT count(*) FROM pages) AS source_id,
    event_id // (SELECT count(*) FROM pages) AS rec_ord FROM ev
    WHERE event_id % 19 <> 0 AND event_id % (SELECT count(*) FROM pages) <> 3""",
)
def _(spark, sf):
    entries = answering.explode_programs(
        fx.answers(spark, sf), keep=["source_id", "first_pos"]
    )
    return entries.select("source_id", (F.col("first_pos") + F.col("pos")).alias("rec_ord"))


@query(
    "b05_row_validity",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED}
    SELECT source_id, rec_ord, concat_ws('|',
      CASE WHEN event_id % 13 = 0 THEN 'program_name' END,
      CASE WHEN event_id % 17 = 0 THEN 'confidence_score' END) AS reasons
    FROM hinted WHERE length(trim(text)) >= 40 AND (event_id % 13 = 0 OR event_id % 17 = 0)""",
)
def _(spark, sf):
    typed = _typed(spark, sf, *ORDER_COLUMNS, "source_id", "program_name")
    return answering.rejected(typed).select(
        "source_id", "rec_ord", flat(F.col("reject_reasons")).alias("reasons")
    )


@query(
    "b06_flagged_rows",
    f"WITH {q.FINAL} SELECT {PLACE}, program_name FROM final WHERE review_needed = 'Yes'",
)
def _(spark, sf):
    return review.review_queue(fx.finished(spark, sf)).select(*ORDER_COLUMNS, "program_name")


@query(
    "b07_unprintable_dropped",
    f"""WITH {q.RAW} SELECT rec_ord FROM raw WHERE NOT (
      (rec_ord % 4 = 0 AND amount_value IS NOT NULL AND coalesce(amount_type, '') IN ('fixed_dollar', 'percentage', 'per_unit', 'up_to'))
      OR (rec_ord % 4 = 1 AND amount_value IS NOT NULL AND coalesce(amount_type, '') = 'percentage')
      OR rec_ord % 4 = 2)""",
)
def _(spark, sf):
    place, value = F.col("rec_ord"), F.col("amount_value")
    broken = fx.records(spark, sf).withColumns(
        {
            "amount_value": F.when((place % 4 == 0) & value.isNotNull(), F.lit(float("nan")))
            .otherwise(value),
            "amount_max": F.when(place % 4 == 1, F.lit(float("inf")))
            .otherwise(F.col("amount_max")),
            "application_url": F.when(place % 4 == 2, F.lit("http://[oops/x"))
            .otherwise(F.col("application_url")),
        }
    )
    return normalise.normalise(broken, fx.run_date()).select("rec_ord")


@query(
    "b08_vocabulary",
    f"""WITH {q.RAW} SELECT rec_ord, coalesce(type, '') <> '' AS known_type,
    level IS NOT NULL AND rec_ord % 3 <> 1 AS known_level,
    amount_type IS NOT NULL AND rec_ord % 2 = 0 AS known_amount_type FROM raw""",
)
def _(spark, sf):
    place = F.col("rec_ord")

    def known(column: Column, words: list[str]) -> Column:
        as_json = F.to_variant_object(F.struct(column.alias("w")))
        value = F.try_variant_get(as_json, "$.w", "variant")
        return coercion.read_word(value, coercion.kind(value), words).isNotNull()

    # Wrong case and padding are not in the vocabulary.
    level = F.when(place % 3 == 1, F.upper("level")).otherwise(F.col("level"))
    amount = F.when(place % 2 == 1, F.concat(F.lit(" "), "amount_type")).otherwise(
        F.col("amount_type")
    )
    return fx.records(spark, sf).select(
        "rec_ord",
        known(F.col("type"), RAW_TYPES).alias("known_type"),
        known(level, LEVELS).alias("known_level"),
        known(amount, AMOUNT_TYPES).alias("known_amount_type"),
    )


def _edge_hosts(spark, sf) -> list[str]:
    """Two hosts to treat as warn-only: the first and the last by name."""
    host = urls.authority(F.col("url"))
    return list(fx.load(spark, sf, "pages").agg(F.min(host), F.max(host)).first())


_EDGE_HOSTS = f"(SELECT min({q.HOST}) FROM pages), (SELECT max({q.HOST}) FROM pages)"


@query(
    "b09_warn_only_host",
    f"SELECT page_id, {q.HOST} IN ({_EDGE_HOSTS}) AS warns FROM pages",
)
def _(spark, sf):
    warns = liveness.warns_only(F.col("url"), _edge_hosts(spark, sf))
    return fx.load(spark, sf, "pages").select("page_id", warns.alias("warns"))


@query(
    "b10_http_url_test",
    f"""WITH {q.RAW} SELECT rec_ord, rec_ord % 5 = 0 AS application_ok,
    source_url <> '' AS source_ok FROM raw""",
)
def _(spark, sf):
    return fx.records(spark, sf).select(
        "rec_ord",
        urls.is_http_url(F.col("application_url")).alias("application_ok"),
        urls.is_http_url(F.col("source_url")).alias("source_ok"),
    )


# --- projections -----------------------------------------------------------------------


@query(
    "c01_jurisdiction",
    f"WITH {q.REGISTRY} SELECT source_id, {q.JURISDICTION} AS jurisdiction FROM registry",
)
def _(spark, sf):
    return fx.registry(spark, sf).select("source_id", registry.jurisdiction().alias("jurisdiction"))


@query(
    "c02_clip",
    f"""SELECT doc_id, length(substr(text, 1, {MAX_REQUEST_CHARS})) AS chars,
    md5(substr(text, 1, {MAX_REQUEST_CHARS})) AS content_md5 FROM documents""",
)
def _(spark, sf):
    clipped = requests.clip(F.col("text"))
    return fx.load(spark, sf, "documents").select(
        "doc_id",
        F.length(clipped).cast("bigint").alias("chars"),
        digest(clipped).alias("content_md5"),
    )


_PROMPT = (
    "'List the incentive programs this page describes as JSON: {\"programs\": [...]}.' || chr(10) "
    "|| 'Page: ' || name || ' <' || final_url || '> (' || content_type || ')' || chr(10) "
    "|| 'Area: ' || level || ', ' || jurisdiction || '; state=' || state || '; county=' || county "
    "|| '; city=' || city || '; utility=' || utility || chr(10) || 'Text:' || chr(10) || content || chr(10)"
)


@query(
    "c03_extraction_request",
    f"""WITH {q.PAGES}, slots AS (SELECT *, {q.JURISDICTION} AS jurisdiction,
      substr(text, 1, {MAX_REQUEST_CHARS}) AS content FROM page_texts WHERE length(trim(text)) >= 40)
    SELECT source_id, source_ord, final_url AS source_url, md5({_PROMPT}) AS prompt_md5,
      CAST(0 AS DOUBLE) AS temperature, CAST(NULL AS DOUBLE) AS locked_temperature FROM slots""",
)
def _(spark, sf):
    pages = _pages(spark, sf)
    asked = requests.extraction_requests(pages)
    locked = F.when(~requests.locks_temperature(F.lit("GPT-5-mini")), F.lit(0.0))
    return asked.select(
        "source_id",
        "source_ord",
        "source_url",
        digest(F.col("prompt")).alias("prompt_md5"),
        "temperature",
        locked.alias("locked_temperature"),
    )


@query("c04_final_projection", f"WITH {q.FINAL} SELECT {TABLE} FROM final")
def _(spark, sf):
    return fx.finished(spark, sf).select(*sinks.table_columns())


@query(
    "c05_constant_provenance",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED}
    SELECT 'llm' AS {PROVENANCE_COLUMN}, count(*) AS n FROM answered GROUP BY 1""",
)
def _(spark, sf):
    records = answering.accepted(_typed(spark, sf, PROVENANCE_COLUMN))
    return records.groupBy(PROVENANCE_COLUMN).agg(F.count("*").alias("n"))


@query("c06_registry_listing", f"WITH {q.REGISTRY} SELECT level, name, url FROM registry")
def _(spark, sf):
    return registry.list_sources(fx.registry(spark, sf))


# --- page text -------------------------------------------------------------------------


@query(
    "d01_visible_text",
    f"SELECT page_id, {q.visible('html')} AS visible FROM pages",
)
def _(spark, sf):
    # a third of the pages is malformed in ways that don't change what is shown
    pages = fx.malformed(fx.load(spark, sf, "pages"))
    return pages.select("page_id", markup.visible_text(F.col("html")).alias("visible"))


@query(
    "d02_content_type",
    f"WITH {q.PAGES} SELECT source_id, static_type FROM statics",
)
def _(spark, sf):
    joined = captures.with_sources(fx.captures(spark, sf), fx.registry(spark, sf))
    return joined.select("source_id", captures.static_type().alias("static_type"))


@query(
    "d03_capture_choice",
    f"WITH {q.PAGES} SELECT content_type, needs_render, count(*) AS pages FROM page_texts GROUP BY ALL",
)
def _(spark, sf):
    pages = fx.pages(spark, sf)
    return pages.groupBy("content_type", "needs_render").agg(F.count("*").alias("pages"))


_BY_HOST = f"""SELECT {q.HOST} AS host, count(*) AS pages,
    CAST(sum(length({q.visible('html')})) AS BIGINT) AS text_chars,
    count(*) FILTER (WHERE length({q.visible('html')}) < 400) AS needs_render
    FROM pages GROUP BY 1"""


@query("d04_text_chars", _BY_HOST)
def flagship(spark, sf):
    """Per host: pages, visible characters, and pages too short without a browser."""
    pages = fx.load(spark, sf, "pages").select(
        urls.authority(F.col("url")).alias("host"),
        F.length(markup.visible_text(F.col("html"))).alias("chars"),
    )
    return pages.groupBy("host").agg(
        F.count("*").alias("pages"),
        F.sum("chars").alias("text_chars"),
        F.count_if(F.col("chars") < captures.MIN_STATIC_CHARS).alias("needs_render"),
    )


# --- JSON ------------------------------------------------------------------------------

_SOURCE = "event_id % (SELECT count(*) FROM pages)"
_POSITION = "event_id // (SELECT count(*) FROM pages)"


@query(
    "e01_tolerant_parse",
    f"SELECT DISTINCT {_SOURCE} AS source_id, {_SOURCE} <> 3 AS readable FROM events",
)
def _(spark, sf):
    readable = coercion.parse_json(F.col("payload")).isNotNull()
    return fx.answers(spark, sf).groupBy("source_id").agg(F.bool_and(readable).alias("readable"))


@query(
    "e02_explode_programs",
    f"""SELECT {_SOURCE} AS source_id, count(*) AS entries, max({_POSITION}) AS last_pos
    FROM events WHERE event_id % 19 <> 0 AND {_SOURCE} <> 3 GROUP BY 1""",
)
def _(spark, sf):
    entries = answering.explode_programs(fx.answers(spark, sf), keep=["source_id", "first_pos"])
    return entries.groupBy("source_id").agg(
        F.count("*").alias("entries"),
        F.max(F.col("first_pos") + F.col("pos")).alias("last_pos"),
    )


def _answered(*columns: str, where: str = "true") -> str:
    return (
        f"WITH {q.RAW}, {q.PAGES}, {q.ANSWERED} "
        f"SELECT source_id, rec_ord, {', '.join(columns)} FROM answered WHERE {where}"
    )


def _accepted(spark, sf, *columns):
    return answering.accepted(_typed(spark, sf, "source_id", "rec_ord", *columns))


@query("e03_absent_hints", _answered("source_url", "last_verified_at", "level", "state"))
def _(spark, sf):
    return _accepted(spark, sf, "source_url", "last_verified_at", "level", "state")


@query("e04_falsy_hints", _answered("county", "city", "utility_provider"))
def _(spark, sf):
    return _accepted(spark, sf, "county", "city", "utility_provider")


def _joined(name: str) -> str:
    return f"array_to_string({name}, '|') AS {name}"


@query(
    "e05_null_lists",
    _answered(
        _joined("eligible_property_types"),
        _joined("zip_codes"),
        "0 AS zip_codes_missing",
    ),
)
def _(spark, sf):
    # empty lists arrive as null
    empty, null = F.lit('"zip_codes":[]'), F.lit('"zip_codes":null')
    given = fx.answers(spark, sf).withColumn("payload", F.replace("payload", empty, null))
    lists = ["eligible_property_types", "zip_codes"]
    typed = _written_once(spark, _raw(spark, sf, answers=given), "source_id", "rec_ord", *lists)
    return answering.accepted(typed).select(
        "source_id",
        "rec_ord",
        flat(F.col("eligible_property_types")).alias("eligible_property_types"),
        flat(F.col("zip_codes")).alias("zip_codes"),
        F.col("zip_codes").isNull().cast("int").alias("zip_codes_missing"),
    )


_TYPED = [
    "trim(program_name) AS program_name",
    "type",
    "amount_type",
    "amount_value",
    "amount_max",
    "amount_text",
    "income_required",
    "income_limit_pct_ami",
    "requires_homeownership",
    "eligibility_notes",
    "description",
    "application_url",
    "program_administrator",
    "expires_at",
    "confidence_score",
    "true AS active",
]


@query("e06_typed_extraction", _answered(*_TYPED))
def _(spark, sf):
    names = [c.split(" AS ")[-1] for c in _TYPED]
    return _accepted(spark, sf, *names)


@query(
    "e07_distinct_sorted_join",
    f"WITH {q.RAW} SELECT rec_ord, {q.sorted_list('eligible_project_types', ', ')} AS projects FROM raw",
)
def _(spark, sf):
    projects = text.join_distinct(F.col("eligible_project_types"), ", ")
    return fx.records(spark, sf).select("rec_ord", projects.alias("projects"))


@query(
    "e08_join_non_empty",
    f"""WITH {q.RAW} SELECT rec_ord, concat_ws(' | ', nullif(eligibility_notes, ''),
    nullif(amount_text, ''), nullif(county, '')) AS joined FROM raw""",
)
def _(spark, sf):
    parts = [F.col(c) for c in ("eligibility_notes", "amount_text", "county")]
    return fx.records(spark, sf).select("rec_ord", text.join_present(parts, " | ").alias("joined"))


# --- scalar functions --------------------------------------------------------------------


@query(
    "f01_collapse_whitespace",
    f"SELECT doc_id, md5({q.collapse('text')}) AS collapsed_md5 FROM documents",
)
def _(spark, sf):
    return fx.load(spark, sf, "documents").select(
        "doc_id", digest(text.collapse_space(F.col("text"))).alias("collapsed_md5")
    )


@query(
    "f02_dedupe_key",
    f"SELECT doc_id, md5({q.collapse('lower(text)')}) AS key_md5 FROM documents",
)
def _(spark, sf):
    return fx.load(spark, sf, "documents").select(
        "doc_id", digest(text.dedupe_key(F.col("text"))).alias("key_md5")
    )


@query("f03_truncate", f"SELECT doc_id, {q.shorten('text')} AS shortened FROM documents")
def _(spark, sf):
    return fx.load(spark, sf, "documents").select(
        "doc_id", text.truncate(F.col("text")).alias("shortened")
    )


@query(
    "f04_number_format",
    f"""SELECT event_id, {q.money('value')} AS plain, {q.money('(value * 1000)')} AS large,
    {q.money('floor(value)')} AS whole, {q.money('(value / -7)')} AS negative FROM events""",
)
def _(spark, sf):
    value = F.col("value")
    return fx.load(spark, sf, "events").select(
        "event_id",
        text.format_amount_number(value).alias("plain"),
        text.format_amount_number(value * 1000).alias("large"),
        text.format_amount_number(F.floor(value).cast("double")).alias("whole"),
        text.format_amount_number(value / -7).alias("negative"),
    )


def _per_record(spark, sf, **columns: Column) -> DataFrame:
    return fx.records(spark, sf).select("rec_ord", *[c.alias(n) for n, c in columns.items()])


def _from_raw(**columns: str) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"WITH {q.RAW} SELECT rec_ord, {listed} FROM raw"


@query("f05_amount_text", _from_raw(amount=q.AMOUNT))
def _(spark, sf):
    return _per_record(spark, sf, amount=normalise.amount_text())


@query(
    "f06_significant_digits",
    """SELECT event_id, format('{:g}', value) AS plain, format('{:g}', value * 1000) AS large,
    format('{:g}', value / 700000) AS small FROM events""",
)
def _(spark, sf):
    value = F.col("value")
    return fx.load(spark, sf, "events").select(
        "event_id",
        text.format_significant(value).alias("plain"),
        text.format_significant(value * 1000).alias("large"),
        text.format_significant(value / 700000).alias("small"),
    )


@query("f07_state_and_city", _from_raw(state_out=q.STATE, city_out=q.CITY))
def _(spark, sf):
    state, city = normalise.place(normalise.PlaceDefaults())
    return _per_record(spark, sf, state_out=state, city_out=city)


@query("f08_property_type", _from_raw(property_type=q.PROPERTY))
def _(spark, sf):
    return _per_record(spark, sf, property_type=normalise.property_type())


@query("f09_eligibility", _from_raw(conditions=q.CONDITIONS))
def _(spark, sf):
    return _per_record(spark, sf, conditions=normalise.eligibility())


@query("f10_description", _from_raw(description_out=q.DESCRIPTION))
def _(spark, sf):
    return _per_record(spark, sf, description_out=normalise.description())


@query(
    "f11_valid_until",
    _from_raw(
        valid_until=q.VALID_UNTIL,
        expiry_unknown=f"coalesce(level, '') = 'federal' AND {q.STATED} = 'Unknown'",
    ),
)
def _(spark, sf):
    stated, unknown = normalise.valid_until()
    return _per_record(spark, sf, valid_until=stated, expiry_unknown=unknown)


@query("f12_incentive_type", _from_raw(known_type=q.KNOWN_TYPE))
def _(spark, sf):
    return _per_record(spark, sf, known_type=normalise.incentive_type())


@query("f13_url_coercion", _from_raw(absolute=q.absolute("application_url")))
def _(spark, sf):
    return _per_record(spark, sf, absolute=urls.coerce_http_url(F.col("application_url")))


@query("f14_link_resolution", _from_raw(link=q.LINK))
def _(spark, sf):
    link = urls.resolve_link(F.col("application_url"), F.col("source_url"))
    return _per_record(spark, sf, link=link)


@query("f15_host", f"SELECT page_id, {q.HOST} AS host FROM pages")
def _(spark, sf):
    pages = fx.load(spark, sf, "pages")
    return pages.select("page_id", urls.authority(F.col("url")).alias("host"))


@query(
    "f16_amount_sanitise",
    f"SELECT doc_id, nullif(substr({q.collapse('text')}, 1, 200), '') AS amount FROM documents",
)
def _(spark, sf):
    return fx.load(spark, sf, "documents").select(
        "doc_id", text.sanitize_amount(F.col("text")).alias("amount")
    )


@query(
    "f17_run_date",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED}
    SELECT last_verified_at, count(*) AS n FROM answered GROUP BY 1""",
)
def _(spark, sf):
    records = answering.accepted(_typed(spark, sf, "last_verified_at"))
    return records.groupBy("last_verified_at").agg(F.count("*").alias("n"))


@query("f18_updated_at", _from_raw(updated_at="coalesce(last_verified_at, '2026-02-01')"))
def _(spark, sf):
    return _per_record(spark, sf, updated_at=normalise.updated_at(fx.run_date()))


@query("f19_sha256", "SELECT page_id, sha256(url) AS url_sha FROM pages")
def _(spark, sf):
    pages = fx.load(spark, sf, "pages")
    return pages.select("page_id", urls.url_key(F.col("url")).alias("url_sha"))


@query(
    "f20_round_seconds",
    """SELECT event_id, CAST(format('{:.2f}', value / 7) AS DOUBLE) AS seconds,
    CAST(format('{:.2f}', value / 8) AS DOUBLE) AS halves FROM events""",
)
def _(spark, sf):
    value = F.col("value")
    return fx.load(spark, sf, "events").select(
        "event_id",
        text.round_seconds(value / 7).alias("seconds"),
        text.round_seconds(value / 8).alias("halves"),
    )


# --- joins -------------------------------------------------------------------------------


@query(
    "g01_source_hints_join",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED} SELECT source_ord, level, count(*) AS n
    FROM hinted WHERE length(trim(text)) >= 40 GROUP BY 1, 2""",
)
def _(spark, sf):
    typed = _typed(spark, sf, "source_ord", "level")
    return typed.groupBy("source_ord", "level").agg(F.count("*").alias("n"))


@query("g02_audit_join", f"WITH {_AUDIT} SELECT * FROM audit")
def _(spark, sf):
    return _audit(spark, sf)


def _link_checked(limit: str) -> str:
    """Rows with their flag after the first so many links (all if '') were checked."""
    bound = (
        f"""(SELECT CASE WHEN count(*) < {limit} THEN NULL ELSE max(place) END FROM
          (SELECT source_ord * 1000000000 + rec_ord AS place FROM final
           WHERE program_links <> '' ORDER BY 1 LIMIT {limit}))"""
        if limit
        else "NULL"
    )
    return f"""WITH {q.FINAL}, {q.LINK_STATUS}, bound AS (SELECT {bound} AS last)
    SELECT f.source_ord, f.rec_ord, f.program_links,
      CASE WHEN (b.last IS NULL OR f.source_ord * 1000000000 + f.rec_ord <= b.last)
        AND (f.program_links = '' OR coalesce(v.broken, false)) THEN 'Yes' ELSE f.review_needed END AS review_needed
    FROM final f CROSS JOIN bound b LEFT JOIN verdicts v ON v.url = f.program_links"""


def _checked(spark, sf, limit: int) -> DataFrame:
    finished = stage(fx.finished(spark, sf), shared_folder(spark), "table")
    status = fx.probed_twice(fx.link_status(finished))
    table = review.flag_broken_links(finished, status, limit)
    return table.select(*ORDER_COLUMNS, "program_links", "review_needed")


@query("g03_link_verdict_join", _link_checked(""))
def _(spark, sf):
    return _checked(spark, sf, -1)


_TYPES = "(VALUES ('Grants'), ('Rebates'), ('Finance Solutions'), ('Tax Credits'), ('Investments')) t(incentive_type)"


@query(
    "g04_vocabulary_join",
    f"""WITH {q.FINAL} SELECT t.incentive_type, count(f.rec_ord) AS rows FROM {_TYPES}
    LEFT JOIN (SELECT rec_ord, CASE incentive_type WHEN 'Grants' THEN 'Rebates'
      ELSE incentive_type END AS incentive_type FROM final) f USING (incentive_type) GROUP BY 1""",
)
def _(spark, sf):
    # every row counts; one type is turned into another, so that a zero is among the counts
    kind = F.when(F.col("incentive_type") == "Grants", "Rebates").otherwise(F.col("incentive_type"))
    return gates.type_distribution(fx.finished(spark, sf).withColumn("incentive_type", kind))


@query(
    "g05_already_captured",
    "SELECT page_id AS source_id FROM pages WHERE page_id % 3 <> 0",
)
def _(spark, sf):
    done = registry.already_captured(fx.registry(spark, sf), _captured(spark, sf))
    return done.select("source_id")


@query(
    "g06_type_map",
    f"""WITH {q.RAW} SELECT type, {q.KNOWN_TYPE} AS incentive_type, count(*) AS n FROM raw
    GROUP BY ALL""",
)
def _(spark, sf):
    return fx.records(spark, sf).groupBy("type", normalise.incentive_type().alias("incentive_type")).agg(
        F.count("*").alias("n")
    )


# --- aggregation ---------------------------------------------------------------------------


@query(
    "h01_first_wins",
    f"""WITH {q.RAW}, {q.unique_rows()}
    SELECT source_ord, rec_ord, trim(program_name) AS program_name, level, program_administrator,
      md5(coalesce(description, '')) AS description_md5 FROM uniq""",
)
def _(spark, sf):
    return dedupe.keep_first(fx.records(spark, sf), written=fx.firsts_writer(spark)).select(
        *ORDER_COLUMNS,
        "program_name",
        "level",
        "program_administrator",
        digest(F.coalesce("description", F.lit(""))).alias("description_md5"),
    )


@query(
    "h02_records_per_source",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED}
    SELECT source_id, count(*) AS records FROM answered GROUP BY 1""",
)
def _(spark, sf):
    return audit.records_per_source(answering.accepted(_typed(spark, sf, "source_id")))


@query(
    "h03_counts_around_dedupe",
    f"""WITH {q.RAW}, {q.unique_rows()}
    SELECT 'before' AS step, count(*) AS records FROM raw
    UNION ALL SELECT 'after', count(*) FROM uniq""",
)
def _(spark, sf):
    return dedupe.counts_around(fx.records(spark, sf))


@query(
    "h04_run_totals",
    f"""WITH {q.FINAL} SELECT count(*) AS records,
    count(*) FILTER (WHERE review_needed = 'Yes') AS flagged FROM final""",
)
def _(spark, sf):
    return audit.run_totals(fx.finished(spark, sf))


@query(
    "h05_type_counts",
    f"WITH {q.FINAL} SELECT incentive_type, count(*) AS rows FROM final GROUP BY 1",
)
def _(spark, sf):
    return gates.type_distribution(fx.finished(spark, sf))


@query(
    "h06_flagged_share",
    f"""WITH {q.FINAL} SELECT count(*) AS rows,
    count(*) FILTER (WHERE review_needed = 'Yes') AS flagged,
    format('{{:.1f}}', 100.0 * count(*) FILTER (WHERE review_needed = 'Yes') / count(*)) AS flagged_pct
    FROM final""",
)
def _(spark, sf):
    return gates.flagged_share(fx.finished(spark, sf))


@query(
    "h07_distinct_links",
    f"WITH {q.FINAL} SELECT DISTINCT trim(program_links) AS url FROM final WHERE program_links <> ''",
)
def _(spark, sf):
    return liveness.distinct_links(fx.finished(spark, sf))


_KNOWN = "('Grants', 'Rebates', 'Finance Solutions', 'Tax Credits', 'Investments')"
_BAD = {
    "incentive_type": f"incentive_type NOT IN {_KNOWN}",
    "review_needed": "review_needed NOT IN ('Yes', 'No')",
    "program_links": "NOT starts_with(program_links, 'http')",
    "program_name": "trim(program_name) = ''",
    "updated_at": "NOT (length(updated_at) = 10 AND substr(updated_at, 5, 1) = '-')",
}


@query(
    "h08_distinct_offenders",
    f"WITH {q.DAMAGED} "
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{g}' AS gate, {g} AS value FROM damaged WHERE {_BAD[g]}"
        for g in ("incentive_type", "review_needed", "updated_at")
    ),
)
def _(spark, sf):
    return gates.offending_values(fx.damaged(spark, sf))


@query(
    "h09_rows_written",
    f"""WITH {q.FINAL} SELECT 'table' AS sink, count(*) AS rows FROM final
    UNION ALL SELECT 'review', count(*) FROM final WHERE review_needed = 'Yes'""",
)
def _(spark, sf):
    folder = shared_folder(spark)
    # two sinks, so the table is worked out once like a build does
    table = stage(fx.finished(spark, sf), folder, "finished")
    counts = {
        "table": sinks.write_table(table, f"{folder}/table"),
        "review": sinks.write_review_queue(table, f"{folder}/review"),
    }
    return spark.createDataFrame(list(counts.items()), "sink string, rows bigint")


# --- order and limits ------------------------------------------------------------------------


@query("i01_bounded_link_check", _link_checked(str(LINK_CHECKS)))
def _(spark, sf):
    return _checked(spark, sf, LINK_CHECKS)


@query("i02_stable_order", f"WITH {q.FINAL} SELECT {_NUMBERED}, {PLACE} FROM final")
def _(spark, sf):
    path = f"{shared_folder(spark)}/table"
    table = fx.finished(spark, sf)
    # The place goes through the file in a text column, to be seen after the sort.
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in ORDER_COLUMNS])
    sinks.write_table(table.withColumn("description", place), path)
    parts = F.split("description", "/")
    return readers.read_table(spark, path).select(
        "row_index",
        *[parts.getItem(i).cast("bigint").alias(c) for i, c in enumerate(ORDER_COLUMNS)],
    )


@query(
    "i03_sorted_links",
    f"""WITH {q.FINAL} SELECT url, row_number() OVER (ORDER BY url) - 1 AS position
    FROM (SELECT DISTINCT program_links AS url FROM final WHERE program_links <> '')""",
)
def _(spark, sf):
    path = f"{shared_folder(spark)}/links"
    links = liveness.distinct_links(fx.finished(spark, sf)).orderBy("url")
    as_table = links.select(
        *[
            (F.col("url") if c == "program_links" else F.lit("")).alias(c)
            for c in TABLE_COLUMNS
        ],
        "url",
    )
    sinks.write_table(as_table, path, order=["url"])
    return readers.read_table(spark, path).select(
        F.col("program_links").alias("url"), F.col("row_index").alias("position")
    )


@query(
    "i04_first_offenders",
    f"""WITH {q.DAMAGED}
    SELECT * FROM (SELECT 'program_links' AS gate, source_ord, rec_ord, program_name AS value
      FROM damaged WHERE {_BAD['program_links']} ORDER BY 2, 3 LIMIT 5)""",
)
def _(spark, sf):
    return gates.first_offenders(fx.damaged(spark, sf), "program_links", ORDER_COLUMNS)


@query(
    "i05_append_records",
    f"""WITH {q.RAW}, {q.PAGES}, {q.ANSWERED} SELECT source_ord, count(*) AS n FROM
    (SELECT source_ord FROM raw UNION ALL SELECT source_ord FROM answered) GROUP BY 1""",
)
def _(spark, sf):
    # two batches of one shape: records given as such, and those typed from answers
    given = fx.records(spark, sf).withColumn("reject_reasons", F.array().cast("array<string>"))
    both = answering.append_records(given, _raw(spark, sf))
    kept = answering.accepted(_written_once(spark, both, "source_ord"))
    return kept.groupBy("source_ord").agg(F.count("*").alias("n"))


@query(
    "i06_blank_name_rows",
    f"""WITH {q.DAMAGED}, numbered AS (SELECT *, {_NUMBERED} FROM damaged)
    SELECT 'program_name' AS gate, row_index, CAST(row_index AS VARCHAR) AS value
    FROM numbered WHERE program_name = '' ORDER BY row_index LIMIT 5""",
)
def _(spark, sf):
    path = _written(spark, sf, table=fx.damaged(spark, sf))
    return gates.first_offenders(readers.read_table(spark, path), "program_name", ["row_index"])


# --- flags and gates ---------------------------------------------------------------------------


@query(
    "j01_review_reasons",
    f"WITH {q.FINAL} SELECT {PLACE}, reasons FROM final",
)
def _(spark, sf):
    return fx.finished(spark, sf).select(
        *ORDER_COLUMNS, F.array_join("review_reasons", "; ").alias("reasons")
    )


@query(
    "j02_needs_review_suffix",
    f"WITH {q.FINAL} SELECT {PLACE}, eligibility_criteria, "
    "CASE WHEN reasons = '' THEN 'No' ELSE 'Yes' END AS review_needed FROM final",
)
def _(spark, sf):
    kept = dedupe.keep_first(fx.records(spark, sf), written=fx.firsts_writer(spark))
    table = normalise.normalise(kept, fx.run_date())
    return table.select(*ORDER_COLUMNS, "eligibility_criteria", "review_needed")


@query(
    "j03_completeness",
    f"""WITH {q.FINAL} SELECT {PLACE}, CASE WHEN review_needed = 'Yes' OR rec_ord % 3 = 0
      OR (rec_ord % 5 = 0) THEN 'Yes' ELSE 'No' END AS review_needed FROM final""",
)
def _(spark, sf):
    place = F.col("rec_ord")
    holed = fx.finished(spark, sf).withColumns(
        {
            "incentive_amount": F.when(place % 3 == 0, F.lit(" ")).otherwise(
                F.col("incentive_amount")
            ),
            "city": F.when(place % 5 == 0, F.lit(None)).otherwise(F.col("city")),
        }
    )
    return review.flag_incomplete(holed).select(*ORDER_COLUMNS, "review_needed")


@query(
    "j04_link_verdict",
    f"WITH {q.FINAL}, {q.LINK_STATUS} SELECT url, broken FROM verdicts",
)
def _(spark, sf):
    broken = review.link_is_broken(F.col("status"), F.col("error"))
    return fx.link_status(fx.finished(spark, sf)).select("url", broken.alias("broken"))


_COUNTED = ", ".join(
    f"count(*) FILTER (WHERE {bad}) AS bad_{gate}" for gate, bad in _BAD.items()
)


@query(
    "j05_gate_report",
    f"""WITH {q.DAMAGED}, counted AS (SELECT count(*) AS n, {_COUNTED} FROM damaged)
    SELECT 'nonempty' AS gate, n > 0 AS passed, 0 AS offending FROM counted
    UNION ALL SELECT 'columns', true, 0
    UNION ALL SELECT 'coverage', n >= 60, greatest(0, 60 - n) FROM counted """
    + "".join(
        f"UNION ALL SELECT '{g}', bad_{g} = 0, bad_{g} FROM counted " for g in _BAD
    ),
)
def _(spark, sf):
    path = _written(spark, sf, table=fx.damaged(spark, sf))
    return gates.gate_files(readers.read_lines(spark, path))


@query(
    "j06_source_liveness",
    f"""WITH {q.REGISTRY} SELECT source_ord, name, url, CASE
      WHEN source_ord % 7 = 3 THEN 'UNKNOWN' WHEN source_ord % 7 NOT IN (0, 2) THEN 'OK'
      WHEN name IN ({_EDGE_HOSTS}) THEN 'WARN' ELSE 'FAIL' END AS status FROM registry""",
)
def _(spark, sf):
    sources = fx.registry(spark, sf)
    page = F.col("source_id")
    verdicts = sources.filter(page % 7 != 3).select(
        "url",
        F.when(page % 7 == 0, 404).when(page % 7 == 1, 403).otherwise(200).alias("status"),
        (page % 7 == 2).alias("error"),
    )
    return liveness.source_liveness(sources, fx.probed_twice(verdicts), _edge_hosts(spark, sf))


@query(
    "j07_link_liveness",
    f"""WITH {q.FINAL}, {q.LINK_STATUS}
    SELECT l.url, CASE WHEN v.broken IS NULL THEN 'UNKNOWN' WHEN v.broken THEN 'FAIL' ELSE 'OK' END AS status
    FROM (SELECT DISTINCT program_links AS url FROM final WHERE program_links <> '') l
    LEFT JOIN verdicts v USING (url)""",
)
def _(spark, sf):
    finished = stage(fx.finished(spark, sf), shared_folder(spark), "table")
    return liveness.link_liveness(finished, fx.probed_twice(fx.link_status(finished)))


# --- extension points ----------------------------------------------------------------------------

_BUILT = f"""{q.RAW}, {q.PAGES}, {q.ANSWERED},
{q.unique_rows('answered', 'answered_uniq')},
{q.final_rows('answered_uniq')}"""


def _build(spark, sf, **options):
    captures = fx.recrawled(fx.captures(spark, sf))
    return build.build(fx.registry(spark, sf), captures, run_date=fx.RUN_DATE, **options)


@query("k01_injected_pages", f"WITH {_BUILT} SELECT {PLACE}, {TABLE} FROM final")
def _(spark, sf):
    built = _build(spark, sf, answers=fx.answers(spark, sf))
    return built.table.select(*ORDER_COLUMNS, *TABLE_COLUMNS)


def one_record_per_request(asked: DataFrame) -> DataFrame:
    """An extractor of one's own: one program per request, written in SQL functions."""
    program = F.struct(
        F.concat("name", F.lit(" program")).alias("program_name"),
        F.lit("rebate").alias("type"),
        F.lit("up_to").alias("amount_type"),
        F.length("content").alias("amount_value"),
        F.lit(0.85).alias("confidence_score"),
    )
    payload = F.to_json(F.struct(F.array(program).alias("programs")))
    return asked.select("source_id", payload.alias("payload"))


@query(
    "k02_injected_extractor",
    f"""WITH {q.PAGES}, asked AS (SELECT *, name || ' program' AS program_name FROM page_texts
      WHERE length(trim(text)) >= 40),
    firsts AS (SELECT * FROM asked QUALIFY row_number() OVER
      (PARTITION BY lower(program_name), level ORDER BY source_ord) = 1)
    SELECT source_ord, program_name, 'Rebates' AS incentive_type,
      'Up to $' || format('{{:,}}', CAST(length(substr(text, 1, {MAX_REQUEST_CHARS})) AS BIGINT)) AS incentive_amount,
      CASE WHEN level = 'federal' THEN 'USA' WHEN state = '' THEN 'FL' ELSE upper(state) END AS state,
      CASE level WHEN 'federal' THEN 'Federal' WHEN 'state' THEN 'Statewide'
        WHEN 'county' THEN CASE WHEN county = '' THEN 'Hillsborough County' ELSE county || ' County' END
        WHEN 'city' THEN CASE WHEN city = '' THEN 'Tampa' ELSE city END
        ELSE 'Grid Co territory' END AS city,
      coalesce(nullif(final_url, ''), url) AS program_links
    FROM firsts""",
)
def _(spark, sf):
    built = _build(spark, sf, extract=one_record_per_request)
    return built.table.select(
        "source_ord",
        "program_name",
        "incentive_type",
        "incentive_amount",
        "state",
        "city",
        "program_links",
    )


def fails_for_some(request: dict) -> str:
    """An extractor that raises for every fifth source."""
    if request["source_id"] % 5 == 0:
        raise ValueError("unreadable page")
    return json.dumps({"programs": [{"program_name": f"{request['name']} program", "type": "rebate"}]})


@query(
    "k03_failure_isolation",
    f"""WITH {q.PAGES}, asked AS (SELECT *, length(trim(text)) >= 40 AS worth FROM page_texts)
    SELECT source_ord, content_type, length(text) AS text_chars,
      CAST(worth AND source_id % 5 <> 0 AS INTEGER) AS records,
      CASE WHEN worth AND source_id % 5 = 0 THEN 'ValueError: unreadable page' END AS error
    FROM asked""",
)
def _(spark, sf):
    built = _build(spark, sf, extract=build.each_request(fails_for_some))
    failed = built.failures.withColumnRenamed("source_id", "source_ord")
    return built.audit.join(failed, "source_ord", "left").select(
        "source_ord", "content_type", "text_chars", "records", "error"
    )
