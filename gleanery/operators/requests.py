"""Extraction requests: the batch input of whatever model reads the pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import blank_to_null
from gleanery.operators.registry import jurisdiction

#: Characters of page text a request carries.
MAX_CONTENT_CHARS = 16000
# --- fixed values: model names that take no temperature ------------------------------
FIXED_TEMPERATURE_MODELS = ["o1", "o3", "o4", "gpt-5"]
# --- end of fixed values ------------------------------------------------------------

PROMPT = (
    "List the incentive programs this page describes as JSON: "
    '{{"programs": [...]}}.\n'
    "Page: {name} <{source_url}> ({content_type})\n"
    "Area: {level}, {jurisdiction}; state={state}; county={county}; city={city}; "
    "utility={utility}\n"
    "Text:\n{content}\n"
)
#: Columns of a request that the prompt names, in its order.
_SLOTS = [
    "name",
    "source_url",
    "content_type",
    "level",
    "jurisdiction",
    "state",
    "county",
    "city",
    "utility",
    "content",
]


def locks_temperature(model: Column) -> Column:
    """True for models that accept no temperature setting."""
    name = F.lower(F.coalesce(model, F.lit("")))
    return F.rlike(name, F.lit("^(?:" + "|".join(FIXED_TEMPERATURE_MODELS) + ")"))


def clip(text: Column, limit: int = MAX_CONTENT_CHARS) -> Column:
    return F.substring(text, 1, limit)


def extraction_requests(
    pages: DataFrame, model: str = "gpt-4o-mini", limit: int = MAX_CONTENT_CHARS
) -> DataFrame:
    """One request row for every page with enough text; slots are never null."""
    slots = (
        pages.filter("extractable")
        .withColumn("jurisdiction", jurisdiction())
        .withColumn("source_url", F.coalesce(blank_to_null(F.col("final_url")), F.col("url")))
        .withColumn("content", clip(F.col("text"), limit))
        .select(
            "source_id", "source_ord", *[F.coalesce(s, F.lit("")).alias(s) for s in _SLOTS]
        )
    )
    template = PROMPT
    for slot in _SLOTS:
        template = template.replace("{" + slot + "}", "%s")
    template = template.replace("{{", "{").replace("}}", "}")
    return slots.withColumn("prompt", F.format_string(template, *_SLOTS)).withColumn(
        "temperature",
        F.when(~locks_temperature(F.lit(model)), F.lit(0.0)),
    )
