"""Registry rows: selection, jurisdiction, listing, and what is still to be captured."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import blank_to_null, has_text
from gleanery.functions.urls import url_key


def select_sources(registry: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Sources whose name contains any of the texts, ignoring case; all if none given."""
    if not names:
        return registry
    lowered = F.lower("name")
    return registry.filter(reduce(or_, [F.contains(lowered, F.lit(n.lower())) for n in names]))


def jurisdiction(default_state: str = "FL") -> Column:
    """Readable area of a source."""
    state = F.coalesce(F.col("state"), F.lit(""))
    level = F.col("level")

    def within(place: str) -> Column:
        return F.when(has_text(F.col(place)), F.concat(place, F.lit(", "), state)).otherwise(state)

    return (
        F.when(level == "federal", F.lit("United States"))
        .when(level == "state", F.coalesce(blank_to_null(state), F.lit(default_state)))
        .when(level == "county", within("county"))
        .when(level == "city", within("city"))
        .when(
            level == "utility",
            F.concat(F.coalesce("utility", F.lit("")), F.lit(" service territory")),
        )
        .otherwise(F.lit(""))
    )


def list_sources(registry: DataFrame) -> DataFrame:
    """Level, name and address in trust order."""
    return registry.orderBy("source_ord").select("level", "name", "url")


def still_to_capture(registry: DataFrame, captured: DataFrame) -> DataFrame:
    """Sources whose address has no capture yet; ``captured`` holds a ``url_sha`` column."""
    keyed = registry.withColumn("url_sha", url_key(F.col("url")))
    return keyed.join(captured.select("url_sha"), "url_sha", "left_anti")


def already_captured(registry: DataFrame, captured: DataFrame) -> DataFrame:
    """Sources whose address has been captured."""
    keyed = registry.withColumn("url_sha", url_key(F.col("url")))
    return keyed.join(captured.select("url_sha"), "url_sha", "left_semi")
