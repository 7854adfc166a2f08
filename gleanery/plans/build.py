"""The three jobs: build the table, gate a table, check links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import answers as answering
from gleanery.operators.audit import audit
from gleanery.operators.captures import one_per_source, read_captures
from gleanery.operators.dedupe import counts_around, keep_first
from gleanery.operators.gates import gate_files
from gleanery.operators.joins import lookup_join
from gleanery.operators.liveness import link_liveness, source_liveness
from gleanery.operators.normalise import PlaceDefaults, normalise
from gleanery.operators.registry import select_sources
from gleanery.operators.requests import extraction_requests
from gleanery.operators.review import flag_broken_links, flag_incomplete
from gleanery.plans.staging import remove, shared_folder, stage
from gleanery.sources.readers import read_lines
from gleanery.sources.sinks import write_audit, write_review_queue, write_table

#: Requests in, answers out: any DataFrame transformation, ``mapInPandas`` included.
Extractor = Callable[[DataFrame], DataFrame]


def each_request(function: Callable[[dict], str]) -> Extractor:
    """An extractor from a function that takes one request and returns its payload.

    What it raises becomes the request's ``error``; the request then has no records and all
    others have theirs. Failures of the job itself still end it.
    """

    def extract(requests: DataFrame) -> DataFrame:
        def run(frames):
            for frame in frames:
                rows = []
                for request in frame.to_dict("records"):
                    try:
                        rows.append((request["source_id"], function(request), None))
                    except Exception as error:  # a failing page must not end the run
                        rows.append((request["source_id"], None, f"{type(error).__name__}: {error}"))
                yield pd.DataFrame(rows, columns=["source_id", "payload", "error"])

        return requests.mapInPandas(run, "source_id long, payload string, error string")

    return extract


@contextmanager
def repeated_keys_allowed(spark: SparkSession) -> Iterator[None]:
    """Let the last of repeated keys in a JSON object win, instead of failing the payload."""
    setting = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def run_date_column(run_date: date | str) -> Column:
    """ISO text of the day the run stands for."""
    return F.lit(run_date.isoformat() if isinstance(run_date, date) else run_date)


def source_hints(pages: DataFrame) -> DataFrame:
    """What an answer's records take from their source, for pages worth extracting."""
    hints = ["url", "level", "state", "county", "city", "utility"]
    return pages.filter("extractable").select(
        "source_id", "source_ord", "final_url", F.struct(*hints).alias("hint")
    )


def raw_records(answers: DataFrame, hints: DataFrame, run_date: Column) -> DataFrame:
    """Typed records of all answers, with ``reject_reasons``.

    The join comes before parsing, while an answer is still one row.
    """
    hinted = lookup_join(answers, hints, "source_id", "inner")
    entries = answering.explode_programs(
        hinted, keep=["source_id", "source_ord", "first_pos", "final_url", "hint"]
    )
    placed = entries.select(
        "source_id",
        "source_ord",
        (F.col("first_pos") + F.col("pos")).alias("rec_ord"),
        "final_url",
        "hint",
        "entry",
    )
    return answering.type_records(placed, run_date).drop("final_url")


def curate(
    records: DataFrame,
    run_date: Column,
    defaults: PlaceDefaults = PlaceDefaults(),
    written: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw records to finished rows: the first of each key, normalised, holes flagged.

    ``written`` is what ``keep_first`` takes: it spares sorting whole records.
    """
    return flag_incomplete(normalise(keep_first(records, written=written), run_date, defaults))


@dataclass
class Curated:
    """Results of a build."""

    table: DataFrame
    audit: DataFrame
    rejects: DataFrame
    #: ``source_id, error`` of the requests whose extraction failed.
    failures: DataFrame
    #: Accepted records before duplicates were removed.
    records: DataFrame
    #: Where the staged tables lie that the others read; the caller may remove it.
    folder: str


def build(
    registry: DataFrame,
    captures: DataFrame,
    answers: DataFrame | None = None,
    *,
    run_date: date | str,
    extract: Extractor | None = None,
    link_status: DataFrame | None = None,
    names: list[str] | None = None,
    check_links: int = 0,
    defaults: PlaceDefaults = PlaceDefaults(),
) -> Curated | None:
    """Run every stage over the selected sources; None if no source is selected.

    Answers come from the ``answers`` table or from ``extract`` applied to the requests,
    once. ``each_request`` makes an extractor of which a failing request ends nothing. Page
    text, extracted answers, raw records and the table are written once each to the shared
    folder. Several answers of one source need ``first_pos`` to be in order.
    """
    if (answers is None) == (extract is None):
        raise ValueError("give either answers or extract")
    if check_links != 0 and link_status is None:
        raise ValueError("check_links needs link_status")
    selected = select_sources(registry, names)
    if selected.isEmpty():
        return None
    folder = shared_folder(registry.sparkSession)
    day = run_date_column(run_date)

    captured = one_per_source(captures, selected, lambda first: stage(first, folder, "first_captures", packed=False))
    pages = stage(read_captures(captured, selected), folder, "pages")
    given = stage(extract(extraction_requests(pages)), folder, "answers") if extract else answers
    if "first_pos" not in given.columns:
        if not given.groupBy("source_id").count().filter("count > 1").isEmpty():
            raise ValueError("several answers of one source need first_pos")
        given = given.withColumn("first_pos", F.lit(0).cast("bigint"))
    if "error" not in given.columns:
        given = given.withColumn("error", F.lit(None).cast("string"))
    failures = given.filter("error IS NOT NULL").select("source_id", "error")
    given = given.select("source_id", "first_pos", "payload")

    with repeated_keys_allowed(registry.sparkSession):
        typed = stage(raw_records(given, source_hints(pages), day), folder, "raw")
    records = answering.accepted(typed)
    curated = curate(records, day, defaults, lambda firsts: stage(firsts, folder, "firsts", packed=False))
    table = stage(curated, folder, "table")
    if check_links != 0:
        checked = flag_broken_links(table, link_status, check_links)
        table = stage(checked, folder, "checked")
    return Curated(
        table=table,
        audit=audit(pages, records),
        rejects=answering.rejected(typed),
        failures=failures,
        records=records,
        folder=folder,
    )


def run(
    registry: DataFrame,
    captures: DataFrame,
    answers: DataFrame | None = None,
    *,
    output_path: str,
    review_path: str,
    log_dir: str,
    run_date: date | str,
    include_source: bool = False,
    **options,
) -> dict[str, int]:
    """Build and write table, review queue and audit; returns their counts.

    ``before`` and ``after`` count records around the removal of duplicates, ``records`` and
    ``flagged`` the rows written. Staged tables are removed. Nothing is written if no source is selected.
    """
    started = datetime.now()
    result = build(registry, captures, answers, run_date=run_date, **options)
    if result is None:
        return {"before": 0, "after": 0, "records": 0, "flagged": 0}
    written = write_table(result.table, output_path, include_source=include_source)
    flagged = write_review_queue(result.table, review_path)
    write_audit(result.audit, log_dir, started)
    around = {r["step"]: r["records"] for r in counts_around(result.records).collect()}
    remove(registry.sparkSession, result.folder)
    return {**around, "records": written, "flagged": flagged}


def gate(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Exit code and gate rows for a written table: 2 missing, 1 failing, 0 passing."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
        return 2, None
    rows = gate_files(read_lines(spark, path)).collect()  # one row a gate
    report = spark.createDataFrame(rows, "gate string, passed boolean, offending bigint")
    return (0 if all(r["passed"] for r in rows) else 1), report


def check_links(
    registry: DataFrame, link_status: DataFrame, table: DataFrame | None = None
) -> tuple[int, DataFrame, DataFrame | None]:
    """Exit code, source report and, given a table, link report; 1 if anything failed."""
    sources = source_liveness(registry, link_status)
    links = None if table is None else link_liveness(table, link_status)
    failed = [r for r in (sources, links) if r is not None]
    broken = any(not r.filter(F.col("status") == "FAIL").isEmpty() for r in failed)
    return (1 if broken else 0), sources, links


__all__ = [
    "Curated",
    "build",
    "check_links",
    "curate",
    "gate",
    "each_request",
    "raw_records",
    "run",
    "run_date_column",
    "source_hints",
]
