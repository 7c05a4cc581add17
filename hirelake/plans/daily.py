"""The whole daily run: raw files of one day to staging, bronze, silver, gold."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.operators.dedup import copies_report
from hirelake.operators.incremental import check_load_type, newer_than
from hirelake.operators.pages import attach_pages, extract_cards, matching_roles, postings
from hirelake.operators.quality import quality_report
from hirelake.plans.state import Lake, follow, load_day, read_gold, read_silver
from hirelake.sources.layers import empty_staging, is_staged, read_staging, sources_without_rows, stage, write_staging
from hirelake.sources.logged import Check
from hirelake.sources.raw import (
    read_raw,
    run_name,
    source_name,
    write_raw,
)


@dataclass(frozen=True)
class DailyRun:
    """What one run needs: raw folders (one per source), the lake's root, the
    day, the raw format, the load type, how raw files are read (see
    ``reader_options``), the number of buckets (see ``Lake``), and what looks at silver's
    new rows before they are published."""

    folders: Sequence[str]
    lake: str
    table_date: str
    source_type: str = "csv"
    load_type: str = "incremental"
    multi_line: bool = True
    any_case: bool = False
    buckets: int = 16
    check: Check | None = None

    @property
    def sources(self) -> list[str]:
        return [source_name(f) for f in self.folders]


@dataclass(frozen=True)
class DailyResult:
    """The run's tables and reports, read from what was written."""

    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    dedup: DataFrame
    quality: DataFrame


def ingest(spark: SparkSession, cfg: DailyRun) -> DataFrame:
    """Raw files of the day, all sources in one job, to staging; the staged rows
    come back. Raw files are parsed once, unless the day has been staged before:
    then what is staged cannot tell which sources have no rows now."""
    path = f"{cfg.lake}/staging"
    raw = read_raw(
        spark, cfg.folders, cfg.source_type, None, cfg.table_date, cfg.multi_line, cfg.any_case
    )
    again = is_staged(spark, path, cfg.sources, cfg.table_date)
    write_staging(stage(raw), path)
    staged = read_staging(spark, path, cfg.sources, cfg.table_date)
    for source in sources_without_rows(raw if again else staged, cfg.sources):
        empty_staging(spark, path, source, cfg.table_date)
    return read_staging(spark, path, cfg.sources, cfg.table_date)


def run_daily(spark: SparkSession, cfg: DailyRun) -> DailyResult:
    """Ingest, load, clean, check and count. Every source is a partition of the same
    tables, so more sources mean more data, not more jobs; only a source without any
    row costs a small write of its own. A run touches its own day and the buckets of
    its jobs; a run that is repeated changes nothing."""
    check_load_type(cfg.load_type)
    lake = Lake(cfg.lake, cfg.buckets)
    staged = ingest(spark, cfg)
    load_day(spark, lake, staged, cfg.sources, cfg.table_date, cfg.load_type)
    follow(spark, lake, cfg.check)
    silver = read_silver(spark, lake, cfg.sources)
    return DailyResult(
        bronze=lake.bronze.read(spark, F.col("source").isin(cfg.sources)),
        silver=silver,
        gold=read_gold(spark, lake, cfg.sources),
        dedup=copies_report(staged, "copies"),
        quality=quality_report(silver, by=["source"]),
    )


def last_processed_time(spark: SparkSession, lake: str, source: str, load_type: str) -> str:
    """The source's high-water mark in bronze; ``""`` for a full load and when there is
    no bronze or no time yet. Read from bronze's log, a row for each day."""
    if check_load_type(load_type) == "full":
        return ""
    return Lake(lake).bronze.maxima(spark, where=F.col("source") == source).first()["max_mark"] or ""


def collect_pages(
    search_pages: DataFrame,
    detail_pages: DataFrame,
    folder: str,
    site: str,
    url_prefix: str,
    country: str,
    stamp: str,
    mark: str | None = None,
    term: str = "keyword",
    terms: Sequence[str] = vocab.SEARCH_TERMS,
    keywords: Sequence[str] = vocab.ROLE_KEYWORDS,
) -> None:
    """Stored pages of one country to raw files in ``folder``: cards of all
    search terms, roles that match, newer than the mark, with their details.

    ``term`` is the column of ``search_pages`` that says which search a page is a
    result of; all searches are one job. ``stamp`` is the run's ``yyyyMMdd_HHmmss``.
    """
    asked = search_pages.where(F.col(term).isin(list(terms)))
    cards = extract_cards(asked, url_prefix, country, keep=[term])
    wanted = newer_than(matching_roles(cards, keywords), mark)
    rows: DataFrame = attach_pages(wanted, detail_pages)
    name: Column = run_name(site, F.col(term), F.lit(country), stamp)
    write_raw(postings(rows.withColumn("run", name), ["run"]), folder)
