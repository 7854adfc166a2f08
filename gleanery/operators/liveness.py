"""Reports on whether source addresses and program links answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import strip_space
from gleanery.functions.urls import authority
from gleanery.operators.joins import lookup_join
from gleanery.operators.review import verdicts

# --- fixed values: hosts whose failure is only a warning ------------------------------
WARN_ONLY_HOSTS = ["www.rd.usda.gov"]
# --- end of fixed values ------------------------------------------------------------


def warns_only(url: Column, hosts: list[str] | None = None) -> Column:
    return authority(url).isin(*(hosts or WARN_ONLY_HOSTS))


def source_liveness(
    registry: DataFrame, link_status: DataFrame, warn_hosts: list[str] | None = None
) -> DataFrame:
    """OK, WARN or FAIL for every source in trust order; UNKNOWN if never probed."""
    joined = lookup_join(
        registry.select("source_id", "source_ord", "name", "url"),
        verdicts(link_status),
        "url",
    )
    status = (
        F.when(F.col("broken").isNull(), F.lit("UNKNOWN"))
        .when(~F.col("broken"), F.lit("OK"))
        .when(warns_only(F.col("url"), warn_hosts), F.lit("WARN"))
        .otherwise(F.lit("FAIL"))
    )
    return joined.select("source_ord", "name", "url", status.alias("status")).orderBy("source_ord")


def distinct_links(table: DataFrame) -> DataFrame:
    """Distinct non-empty links of a table."""
    links = table.select(strip_space(F.col("program_links")).alias("url"))
    return links.filter(F.col("url") != "").distinct()


def link_liveness(table: DataFrame, link_status: DataFrame) -> DataFrame:
    """OK or FAIL for every distinct link, sorted; UNKNOWN if never probed."""
    status = (
        F.when(F.col("broken").isNull(), F.lit("UNKNOWN"))
        .when(F.col("broken"), F.lit("FAIL"))
        .otherwise(F.lit("OK"))
    )
    return (
        distinct_links(table)
        .join(verdicts(link_status), "url", "left")
        .select("url", status.alias("status"))
        .orderBy("url")
    )
