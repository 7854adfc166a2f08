"""From capture metadata and markup to one text per source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.markup import visible_text
from gleanery.functions.text import blank_to_null, has_text, strip_space
from gleanery.operators.joins import fits_broadcast

#: Static text shorter than this is taken for a page that needs a browser.
MIN_STATIC_CHARS = 400
#: Pages with less text than this, trimmed, are not worth extracting from.
MIN_CONTENT_CHARS = 40


def _place(captures: DataFrame) -> Column:
    """Where a capture stands among those of its source: without an error first, then by status,
    an unknown one last, address and time taken; what is left is told apart by a hash of it all."""
    order = ["status", "final_url", "elapsed_s"]
    rest = [F.col(f"`{c}`") for c in captures.columns if c not in ("source_id", "error", *order)]
    return F.struct(
        F.coalesce("error", F.lit(False)).alias("failed"),
        F.col("status").isNull().alias("no_status"),
        *order,
        F.xxhash64(*rest).alias("rest"),
    )


def one_per_source(
    captures: DataFrame, registry: DataFrame, written: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One capture of every source in ``registry``; captures of others stay or go.

    Repeated captures are looked for by their keys; without any, all stay as they are. Else the
    first of each repeated source is found over narrow columns and a hash of the others. One row
    for each such source goes through ``written``, which writes a table and reads it back; captures
    are then read again and those kept that are first. While these rows are within the broadcast limit, captures stay
    where they are; beyond it, markup is turned into text before the join. So markup moves only
    where captures of a source are the same in every column.
    """
    if fits_broadcast(registry):
        captures = captures.join(F.broadcast(registry.select("source_id")), "source_id", "left_semi")
    repeated = captures.groupBy("source_id").count().filter("count > 1")
    if repeated.isEmpty():
        return captures
    narrow = captures.select("source_id", _place(captures).alias("place"))
    alike = narrow.groupBy("source_id", "place").agg(F.count("*").alias("times"))
    first = alike.groupBy("source_id").agg(
        F.min_by("times", "place").alias("times"), F.min("place").alias("first"), F.sum("times").alias("all_times")
    )
    winners = written(first.filter("all_times > 1").select("source_id", "first", "times"))
    here = captures.withColumn("place", _place(captures))
    if fits_broadcast(winners):
        joined = here.join(F.broadcast(winners), "source_id", "left")
    else:
        joined = with_texts(here).join(winners.hint("merge"), "source_id", "left")
    kept = joined.filter(F.col("first").isNull() | F.col("place").eqNullSafe(F.col("first"))).drop("place", "first")
    if winners.filter("times > 1").isEmpty():
        return kept.drop("times")
    again = F.coalesce(F.col("times") > 1, F.lit(False))
    same = kept.filter(again).dropDuplicates(["source_id"])
    return kept.filter(~again).unionByName(same).drop("times")


def with_texts(captures: DataFrame) -> DataFrame:
    """Visible text in place of markup: ``static_text`` and ``rendered_text``."""
    return captures.withColumns(
        {
            "static_text": visible_text(F.col("static_html")),
            "rendered_text": visible_text(F.col("rendered_html")),
        }
    ).drop("static_html", "rendered_html")


def with_sources(texts: DataFrame, registry: DataFrame) -> DataFrame:
    """Every source with its capture; one without a capture counts as a failed request.

    A registry within the broadcast limit leaves the captures where they are; the sources
    without one are then found by their keys alone.
    """
    found = texts.withColumn("error", F.coalesce("error", F.lit(False)))
    if fits_broadcast(registry):
        wanted = F.broadcast(registry.select("source_id"))
        there = texts.select("source_id").join(wanted, "source_id", "left_semi")
        waiting = registry.join(there, "source_id", "left_anti")
        joined = found.join(F.broadcast(registry), "source_id").unionByName(
            waiting, allowMissingColumns=True
        )
    else:
        joined = registry.join(found, "source_id", "left")
    return joined.withColumn("error", F.coalesce("error", F.lit(True)))


def static_type() -> Column:
    """Kind of a static capture, from its error flag, status, header type and address."""
    address = F.coalesce(blank_to_null(F.col("final_url")), F.col("url"))
    failed = F.coalesce("error", F.lit(False)) | F.coalesce(
        F.col("status") >= 400, F.lit(False)
    )
    pdf = F.contains(
        F.lower(F.coalesce("header_type", F.lit(""))), F.lit("pdf")
    ) | F.endswith(F.lower(address), F.lit(".pdf"))
    return (
        F.when(failed, F.lit("empty")).when(pdf, F.lit("pdf_text")).otherwise(F.lit("html_text"))
    )


def choose_text(captured: DataFrame) -> DataFrame:
    """Add ``text`` with its type, address and size, and what follows from them.

    Static text wins unless the source asks for a browser or the text is short; then
    rendered text does, if there is any. ``needs_render`` tells that a browser was called
    for, ``extractable`` that there is enough text to extract from. Given markup instead of
    texts, it is read only where the choice falls on it.
    """
    kind = static_type()
    lazy = "static_html" in captured.columns
    static_shown = visible_text(F.col("static_html")) if lazy else F.col("static_text")
    static = (
        F.when(F.col("render") == "js", F.lit(""))
        .when(kind == "html_text", static_shown)
        .when(kind == "pdf_text", F.col("pdf_text"))
    )
    staged = captured.withColumns(
        {"static_type": kind, "static_text": F.coalesce(static, F.lit(""))}
    )
    keep_static = (F.col("render") == "static") | (
        (F.col("render") != "js") & (F.length("static_text") >= MIN_STATIC_CHARS)
    )
    if lazy:
        shown = F.when(~keep_static, visible_text(F.col("rendered_html")))
        staged = staged.withColumn("rendered_text", shown).drop("static_html", "rendered_html")
    rendered = ~keep_static & has_text(F.col("rendered_text"))
    nothing = ~rendered & (F.col("render") == "js")
    # A failed request keeps the requested address, a bad status the one it ended at.
    static_url = F.when(F.coalesce("error", F.lit(False)), F.col("url")).otherwise(
        F.coalesce(blank_to_null(F.col("final_url")), F.col("url"))
    )
    return (
        staged.withColumns(
            {
                "needs_render": ~keep_static,
                "text": F.when(rendered, F.col("rendered_text")).otherwise(F.col("static_text")),
                "content_type": F.when(rendered, F.lit("js_text"))
                .when(nothing, F.lit("empty"))
                .otherwise(F.col("static_type")),
                "final_url": F.when(rendered | nothing, F.col("url")).otherwise(static_url),
            }
        )
        .withColumns(
            {
                "text_chars": F.length("text").cast("bigint"),
                "extractable": worth_extracting(F.col("text")),
            }
        )
        .drop(
            "static_type",
            "static_text",
            "rendered_text",
            "pdf_text",
            "status",
            "error",
            "header_type",
        )
    )


def read_captures(captures: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per source: its registry columns and the text captured for it.

    A small registry is joined first, where the markup lies, and only captures of its sources are
    read; for a large one the text is read before the join, so that markup is shuffled in
    neither case.
    """
    if fits_broadcast(registry):
        return choose_text(with_sources(captures, registry))
    texts = with_texts(captures) if "static_html" in captures.columns else captures
    return choose_text(with_sources(texts, registry))


def worth_extracting(text: Column) -> Column:
    """Non-empty text of at least the minimum length once trimmed."""
    return has_text(text) & (F.length(strip_space(text)) >= MIN_CONTENT_CHARS)
