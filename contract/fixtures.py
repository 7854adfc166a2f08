"""Inputs of the registered queries, derived from the given tables as FIXTURES.md lays out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.urls import authority
from gleanery.operators.answers import conform_records
from gleanery.operators.captures import read_captures
from gleanery.operators.joins import fits_broadcast, lookup_join
from gleanery.plans.build import curate, run_date_column
from gleanery.plans.staging import shared_folder, stage
from gleanery.schema import LEVELS, RAW_TYPES
from gleanery.sources.readers import with_registry_defaults

RUN_DATE = "2026-02-01"
#: Entries one payload holds at most.
PAYLOAD_ENTRIES = 64
#: Characters of text that one task puts into payloads, about.
TASK_CHARS = 24_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_date() -> Column:
    return run_date_column(RUN_DATE)


def pick(index: Column, values: list[str | None]) -> Column:
    """The value at a 0-based position, null beyond the list.

    A list, not a chain of conditions: so the code generated for a record stays small enough to
    be compiled.
    """
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index)


def _strings(condition: Column, values: list[str]) -> Column:
    some = F.array(*[F.lit(v) for v in values])
    return F.when(condition, some).otherwise(F.array().cast("array<string>"))


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _with_texts(
    spark: SparkSession, sf_dir: str, events: DataFrame, group: list[str] | None = None
) -> DataFrame:
    """Events with the document each describes; rows of a group meet in one task.

    Texts go to the events while they are within the broadcast limit, and then only events are
    dealt by ``group``; beyond it events with their texts are. Tasks are as many as their texts
    call for, not as the narrow rows that bring them do.
    """
    documents = load(spark, sf_dir, "documents")
    total, chars = documents.agg(F.count("*"), F.coalesce(F.sum("n_chars"), F.lit(0))).first()
    texts = documents.select(F.col("doc_id").alias("text_id"), F.col("text"))
    keyed = events.withColumn("text_id", F.col("event_id") % total)
    tasks = 1 + events.count() * chars // max(total, 1) // TASK_CHARS
    if fits_broadcast(texts):
        dealt = keyed.repartition(tasks, *group) if group else keyed
        return lookup_join(dealt, texts, "text_id")
    joined = lookup_join(keyed.repartition(tasks, "text_id"), texts, "text_id")
    return joined.repartition(tasks, *group) if group else joined


def untrimmed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per event, as written, with its order columns and ``k``."""
    return _raw(_with_texts(spark, sf_dir, events_with_k(spark, sf_dir)))


def _raw(described: DataFrame, *keep: str) -> DataFrame:
    """Raw records of events with their texts, after the columns to keep."""
    event, user, k, value = (F.col(c) for c in ("event_id", "user_id", "k", "value"))
    level = pick(
        F.array_position(
            F.array(*[F.lit(t) for t in ("signup", "view", "click", "error", "purchase")]),
            F.col("event_type"),
        )
        - 1,
        LEVELS,
    )
    return described.select(
        *keep,
        (user % 10).alias("source_ord"),
        event.alias("rec_ord"),
        "k",
        F.when(event % 2 == 0, F.concat(F.lit("Program  "), user, F.lit(" ")))
        .otherwise(F.concat(F.lit("PROGRAM "), user))
        .alias("program_name"),
        F.when(k % 11 != 0, level).alias("level"),
        pick(event % 9, RAW_TYPES).alias("type"),
        pick(event % 6, ["fixed_dollar", "percentage", "per_unit", "up_to", "tiered"]).alias(
            "amount_type"
        ),
        F.when(k % 7 == 0, None)
        .when(k % 7 == 1, F.floor(value).cast("double"))
        .when(k % 7 == 2, value * 1000)
        .otherwise(value)
        .alias("amount_value"),
        F.when(event % 3 == 0, None)
        .when(event % 4 == 1, F.lit(0.0))
        .otherwise(value * 10)
        .alias("amount_max"),
        F.when(k % 5 == 0, F.concat(F.lit("about "), k, F.lit(" dollars"))).alias("amount_text"),
        (k.cast("double") / 100).alias("confidence_score"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("requires_homeownership"),
        F.when(k % 4 == 0, True).alias("income_required"),
        F.when(k % 8 == 0, F.lit(80.0))
        .when(k % 8 == 4, F.lit(33.3333333))
        .alias("income_limit_pct_ami"),
        _strings(k % 2 == 0, ["sfh", " condo ", "sfh"]).alias("eligible_property_types"),
        _strings(k % 3 == 0, ["roof", "hvac", "roof"]).alias("eligible_project_types"),
        _strings(k % 10 == 0, ["33603", "33602"]).alias("zip_codes"),
        F.when(k % 4 != 3, F.lit("fl")).alias("state"),
        pick(k % 6, ["North County", "South"]).alias("county"),
        F.when(k % 6 == 2, F.lit("Springfield")).alias("city"),
        F.when(k % 6 == 3, F.lit("Acme Power")).alias("utility_provider"),
        pick(
            k % 9,
            ["instant REBATE", "open space only", "matching grant", "tax-free", "low loan", ""],
        ).alias("eligibility_notes"),
        F.when(k % 6 != 5, F.col("text")).alias("description"),
        pick(
            event % 5,
            ["https://apply.example.org/a", "Example.COM/apply", "/relative", "not a url"],
        ).alias("application_url"),
        F.when(k == 99, F.lit(""))
        .otherwise(F.concat(F.lit("https://src"), user, F.lit(".example.org/p")))
        .alias("source_url"),
        pick(k % 5, ["2030-12-31", "Permanent", "Unknown", ""]).alias("expires_at"),
        F.concat(F.lit("Admin "), user % 10).alias("program_administrator"),
        F.when(k % 2 == 0, F.lit("2026-01-15")).alias("last_verified_at"),
        F.lit("llm").alias("extraction_source"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records shaped as ingested ones."""
    return conform_records(untrimmed_records(spark, sf_dir)).drop("k")


def firsts_writer(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Writes the first places of duplicate keys and reads them back."""
    folder = shared_folder(spark)
    return lambda firsts: stage(firsts, folder, "firsts", packed=False)


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished table of the raw records."""
    return curate(records(spark, sf_dir), run_date(), written=firsts_writer(spark))


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished table with values that fail the gates."""
    place = F.col("rec_ord")

    def spoil(name: str, every: int, value: Column) -> Column:
        return F.when(place % every == 0, value).otherwise(F.col(name))

    return finished(spark, sf_dir).withColumns(
        {
            "updated_at": spoil("updated_at", 7, F.concat(F.lit("2026/01/1"), place % 3)),
            "review_needed": spoil("review_needed", 11, F.lit("Maybe")),
            "incentive_type": spoil(
                "incentive_type", 13, F.concat(F.lit("Other "), place % 4)
            ),
            "program_name": spoil("program_name", 17, F.lit("")),
        }
    )


def malformed(pages: DataFrame) -> DataFrame:
    """Pages with stray quotes, unclosed and nested hidden elements; they show what they did."""
    body = "(?i)(<body[^>]*>)"
    damages = [
        F.regexp_replace("html", "<p>", "<p title=don't data-x=5'>"),
        F.regexp_replace("html", body, "$1<div><nav><a>menu</a></div>"),
        F.regexp_replace("html", body, "$1<header>a<header>b<nav>c</nav></header>d</header>"),
    ]
    html = F.col("html")
    for rest, damage in enumerate(damages):
        html = F.when(F.col("page_id") % 9 == rest, damage).otherwise(html)
    return pages.withColumn("html", html)


def recrawled(captures: DataFrame) -> DataFrame:
    """Every sixth source with a second capture, a failed one, every tenth with one of unknown fate."""
    again = captures.filter("source_id % 6 = 0").withColumns(
        {"error": F.lit(True), "status": F.lit(500), "static_html": F.lit("<p>try again later</p>")}
    )
    unknown = captures.filter("source_id % 10 = 0 AND NOT coalesce(error, false)").withColumns(
        {
            "error": F.lit(None).cast("boolean"),
            "status": F.lit(None).cast("int"),
            "static_html": F.lit("<p>who knows</p>"),
        }
    )
    return captures.unionByName(again).unionByName(unknown)


def probed_twice(link_status: DataFrame) -> DataFrame:
    """Every verdict beside one that found nothing wrong."""
    fine = link_status.withColumns({"status": F.lit(200), "error": F.lit(False)})
    return link_status.unionByName(fine)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per page."""
    page = F.col("page_id")
    given = load(spark, sf_dir, "pages").select(
        page.alias("source_id"),
        page.alias("source_ord"),
        authority(F.col("url")).alias("name"),
        "url",
        pick(page % 5, LEVELS).alias("level"),
        F.when(page % 10 == 3, F.lit("")).when(page % 4 == 1, F.lit("GA")).alias("state"),
        F.when(page % 5 == 2, F.when(page % 3 != 0, F.lit("Lake"))).alias("county"),
        F.when(page % 5 == 3, F.when(page % 3 != 0, F.lit("Rivertown"))).alias("city"),
        F.when(page % 5 == 4, F.lit("Grid Co")).alias("utility"),
        pick(page % 7, ["js", "static"]).alias("render"),
    )
    return with_registry_defaults(given)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per page; some failed, some PDF, some rendered, some moved."""
    page, url = F.col("page_id"), F.col("url")
    return load(spark, sf_dir, "pages").select(
        page.alias("source_id"),
        F.when(page % 23 == 0, F.lit(""))
        .when(page % 4 == 0, F.concat(url, F.lit("/final")))
        .otherwise(url)
        .alias("final_url"),
        F.when(page % 17 == 0, 404).otherwise(200).alias("status"),
        (page % 19 == 0).alias("error"),
        F.when(page % 13 == 0, F.lit("application/PDF"))
        .otherwise(F.lit("text/html; charset=utf-8"))
        .alias("header_type"),
        F.col("html").alias("static_html"),
        F.concat(F.lit("extracted "), url).alias("pdf_text"),
        F.when(page % 3 == 0, F.col("html")).alias("rendered_html"),
        (page / 7).alias("elapsed_s"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with the text read from their captures."""
    return read_captures(captures(spark, sf_dir), registry(spark, sf_dir))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON answers: a source's records in order, a bounded number to a payload.

    Some entries miss a key, hold an explicit null, break a rule or are no object, some
    write numbers and flags as text; one payload is no JSON.
    """
    total = load(spark, sf_dir, "pages").count()
    place = F.col("event_id")
    events = events_with_k(spark, sf_dir).withColumns(
        {
            "source_id": place % total,
            "first_pos": F.floor(place / (total * PAYLOAD_ENTRIES)).cast("bigint") * PAYLOAD_ENTRIES,
        }
    )
    group = ["source_id", "first_pos"]
    event = F.col("rec_ord")
    raw = _raw(_with_texts(spark, sf_dir, events, group), *group)
    numeric_name = F.concat(F.lit('"program_name":'), event)
    name = F.when(event % 13 == 0, numeric_name).otherwise(
        F.concat(F.lit('"program_name":"'), "program_name", F.lit('"'))
    )
    level = (
        F.when(event % 10 == 0, F.lit(""))
        .when((event % 11 == 0) | F.col("level").isNull(), F.lit(',"level":null'))
        .otherwise(F.concat(F.lit(',"level":"'), "level", F.lit('"')))
    )
    state = (
        F.when(event % 10 == 0, F.lit(""))
        .when(F.col("state").isNull(), F.lit(',"state":null'))
        .otherwise(F.concat(F.lit(',"state":"'), "state", F.lit('"')))
    )
    confidence = F.when(event % 17 == 0, F.lit(1.5)).otherwise(F.col("confidence_score"))
    value = F.when(
        event % 23 == 0,
        F.concat(F.lit(',"amount_value":" '), "amount_value", F.lit(' "')),
    ).otherwise(F.concat(F.lit(',"amount_value":'), "amount_value"))
    owner = F.col("requires_homeownership")
    home = F.when(
        event % 29 == 0,
        F.when(owner, F.lit(',"requires_homeownership":"YES"')).when(
            ~owner, F.lit(',"requires_homeownership":0')
        ),
    ).otherwise(F.concat(F.lit(',"requires_homeownership":'), owner.cast("string")))
    apart = [
        *group,
        "source_ord",
        "rec_ord",
        "k",
        "program_name",
        "level",
        "state",
        "amount_value",
        "requires_homeownership",
        "confidence_score",
        "extraction_source",
        "source_url",
    ]
    rest = F.to_json(
        F.struct(
            confidence.alias("confidence_score"),
            # An empty address goes in as an absent key.
            F.nullif("source_url", F.lit("")).alias("source_url"),
            *[c for c in raw.columns if c not in apart],
        )
    )
    entry = F.when(event % 19 == 0, F.lit('"just text"')).otherwise(
        F.concat(
            F.lit("{"),
            name,
            level,
            state,
            F.coalesce(value, F.lit("")),
            F.coalesce(home, F.lit("")),
            F.lit(","),
            # Only the brace that opens the rest goes; no walk over its characters.
            F.ltrim(rest, F.lit("{")),
        )
    )
    grouped = (
        raw.select(*group, F.struct(event.alias("rec_ord"), entry.alias("entry")).alias("item"))
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    body = F.concat(
        F.lit('{"programs":['), F.array_join(F.col("items.entry"), ","), F.lit("]}")
    )
    return grouped.select(
        "source_id",
        "first_pos",
        F.when(F.col("source_id") == 3, F.concat(body, F.lit(" trailing")))
        .otherwise(body)
        .alias("payload"),
    )


def link_status(table: DataFrame) -> DataFrame:
    """Verdicts on the distinct links of a finished table."""
    links = table.filter("program_links <> ''").select(F.col("program_links").alias("url"))
    host = F.regexp_extract("url", r"//src([0-9]+)\.", 1).try_cast("int")
    return (
        links.distinct()
        .withColumn("u", host)
        .filter(F.coalesce(F.col("u") % 7 != 3, F.lit(True)))
        .select(
            "url",
            F.when(F.col("u") % 7 == 0, 404)
            .when(F.col("u") % 7 == 1, 403)
            .when(F.col("u") % 7 == 2, None)
            .otherwise(200)
            .alias("status"),
            F.coalesce(F.col("u") % 7 == 2, F.lit(False)).alias("error"),
        )
    )
