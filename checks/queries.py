"""Every operator as a query over the test tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import detail_pages, postings, search_pages, table
from hirelake.functions.markup import inner_html, opening_tag, visible_text
from hirelake.functions.money import salary_max, salary_min
from hirelake.functions.text import clean_text, role_casing, role_matches, work_type_normalised
from hirelake.functions.times import parse_time_lenient, publish_time, render_time
from hirelake.operators import dedup, incremental, pages, quality, reports, words
from hirelake.operators.keys import dense_id
from hirelake.plans.daily import DailyRun, collect_pages, last_processed_time, run_daily
from hirelake.plans.silver import build_silver, clean_postings
from hirelake.plans.state import Lake, follow, load_day, read_gold, read_silver
from hirelake.schema import RAW
from hirelake.scratch import materialise, scratch_path
from hirelake.sources import layers, raw
from hirelake.streaming.ingest import stream_bronze

RAW_COLUMNS = RAW.fieldNames()
URL_PREFIX = "https://example.com/job/"
MARK = "1994-06-30 00:00:00"


# --- gold words -------------------------------------------------------------


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_frequency(table(spark, sf_dir, "documents"), "doc_id", "text", unique_keys=True)


def word_frequency_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return words.word_frequency_semi_join(docs, "doc_id", "text", unique_keys=True)


def word_frequency_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many texts per key: each word still counts once per key."""
    return words.word_frequency(table(spark, sf_dir, "conversations"), "conv_id", "text")


def word_frequency_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop words from a table: every region and nation name."""
    names = [
        spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.lower(c).alias("word"))
        for t, c in (("nation", "n_name"), ("region", "r_name"))
    ]
    stop = names[0].union(names[1])
    docs = table(spark, sf_dir, "documents")
    return words.word_frequency(docs, "doc_id", "text", stop, 50, unique_keys=True)


def word_frequency_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return words.word_frequency(docs, "doc_id", "text", top=20, by=["lang"], unique_keys=True)


def job_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words per job, before counting; summed up per job."""
    rows = words.job_words(table(spark, sf_dir, "documents"), "doc_id", "text", unique_keys=True)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.max("word").alias("last_word")
    )


# --- silver -----------------------------------------------------------------


def silver_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(postings(spark, sf_dir))


def silver_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(postings(spark, sf_dir), ["source"])


def trimmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir)
    return rows.select("URL", *[clean_text(F.col(c)).alias(c) for c in ("Job_ID", "Role", "work_type")])


def role_casing_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).select("URL", role_casing(F.col("Role")).alias("role"))


def work_type_normalised_(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = work_type_normalised(F.col("work_type")).alias("work_type")
    return postings(spark, sf_dir).select("URL", fixed)


def salary_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("salary")
    return postings(spark, sf_dir).select(
        "URL", "salary", salary_min(s).alias("salary_min"), salary_max(s).alias("salary_max")
    )


def role_keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).where(role_matches(F.col("Role"))).select("URL", "Role")


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir).dropna(subset=["Job_ID", "Role", "URL", "Publish_Time"])
    return rows.select("Job_ID", "Role", "URL", "Publish_Time")


# --- duplicates and keys ----------------------------------------------------

DEDUP_COLUMNS = ["Role", "Location", "Publish_Time", "country", "salary", "work_type"]


def dedup_ignoring_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir).select(*DEDUP_COLUMNS)
    timed = rows.withColumn("Publish_Time", parse_time_lenient(F.col("Publish_Time")))
    first = dedup.dedup_ignoring(timed, "Publish_Time", "copies")
    return first.withColumn("Publish_Time", render_time(F.col("Publish_Time")))


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_report(postings(spark, sf_dir).select(*DEDUP_COLUMNS), "Publish_Time")


def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def dense_id_(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    return dense_id(keys, [F.desc("key")], "id")


def dense_id_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return dense_id(rows, [F.desc("ts"), F.asc("event_id")], "id", ["event_type"])


# --- quality ----------------------------------------------------------------


def quality_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir)
    return quality.quality_nulls(rows, ["Job_ID", "Role", "Company", "Publish_Time", "URL"])


def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_duplicates(clean_postings(postings(spark, sf_dir)))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both checks over postings as they come, with gaps and repeated ids."""
    rows = postings(spark, sf_dir)
    return quality.quality_report(rows, "Job_ID", ["Job_ID", "Role", "Company", "Publish_Time", "URL"])


# --- times and increments ---------------------------------------------------


def publish_time_from_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.expr(
        """CASE event_id % 7 WHEN 0 THEN concat(event_id % 60, 'm ago')
           WHEN 1 THEN concat(event_id % 24, 'h ago') WHEN 2 THEN concat(event_id % 40, 'd+ ago')
           WHEN 3 THEN 'Just now' WHEN 4 THEN concat(event_id % 9, ' hari')
           WHEN 5 THEN concat(event_id % 9, ' jam') END"""
    )
    then = publish_time(F.col("age"), F.col("ts"))
    return table(spark, sf_dir, "events").withColumn("age", age).select(
        "event_id", render_time(then).alias("publish_time")
    )


def parse_time_lenient_(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        """CASE event_id % 5
           WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
           WHEN 1 THEN concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '+07:00')
           WHEN 2 THEN '2024-13-01 00:00:00' WHEN 3 THEN concat(' ', date_format(ts, 'yyyy-MM-dd'))
           ELSE event_type END"""
    )
    parsed = table(spark, sf_dir, "events").select("event_id", parse_time_lenient(text).alias("parsed"))
    return parsed.withColumn("rendered", render_time(F.col("parsed")))


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", "event_type", render_time(F.col("ts")).alias("Publish_Time"))


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_water_mark(_timed_events(spark, sf_dir))


def high_water_mark_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_water_mark(_timed_events(spark, sf_dir), by=["event_type"])


def newer_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the latest error event."""
    events = _timed_events(spark, sf_dir)
    mark = incremental.high_water_mark(events.where("event_type = 'error'")).scalar()
    return incremental.newer_than(events, mark)


def newer_than_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known mark on a stored time column, filtered in the scan."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    mark = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return incremental.newer_than(events, mark, "ts").select("event_id", "ts")


# --- pages ------------------------------------------------------------------


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and text of every link of the stored pages, by the card pattern:
    split at the opening tag, number, extract."""
    html = F.col("html")
    links = F.regexp_extract_all(html, F.lit(rf'({opening_tag("a", "href")}.*?</a>)'), F.lit(1))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("position", "link"))
    return rows.select(
        "page_id",
        "position",
        F.regexp_extract("link", 'href="([^"]*)"', 1).alias("href"),
        visible_text(F.col("link")).alias("label"),
    )


def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the article of every stored page, lines joined by "; "."""
    blocks = inner_html(F.col("html"), "article")
    lines = F.transform(blocks, lambda b: F.regexp_replace(visible_text(b), "\n", "; "))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(lines, " ").alias("article"))


def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_cards(search_pages(spark, sf_dir), URL_PREFIX, "indonesia", keep=["keyword"])


def page_cards_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.matching_roles(page_cards(spark, sf_dir)).select("Job_ID", "Role")


def page_job_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_details(detail_pages(spark, sf_dir))


def attach_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cards, order lines as detail pages: several, one or none each."""
    cards = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(URL_PREFIX), "o_orderkey").alias("URL"), F.col("o_orderpriority").alias("Role")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("page_id"),
        F.concat(F.lit(URL_PREFIX), "l_orderkey").alias("URL"),
        F.concat(F.lit("part "), "l_partkey").alias("job_desc"),
        F.col("l_returnflag").alias("salary"),
        F.col("l_linestatus").alias("work_type"),
    )
    return pages.attach_details(cards, lines)


def collected_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search and detail pages to raw JSON and CSV files, the JSON read back."""
    folder = scratch_path(spark, "collect") + "/Source_Data_board_north"
    collect_pages(
        search_pages(spark, sf_dir), detail_pages(spark, sf_dir), folder,
        "board", URL_PREFIX, "indonesia", "20250718_201025", MARK,
    )
    return raw.read_raw(spark, folder, "json")


# --- files and layers -------------------------------------------------------


def _raw_zone(spark: SparkSession, sf_dir: str, *formats: str) -> str:
    """The postings as raw files: a folder per source, a run per day."""
    root = scratch_path(spark, "raw")
    rows = postings(spark, sf_dir)
    stamp = F.concat(F.replace(F.col("day"), F.lit("-"), F.lit("")), F.lit("_201025"))
    run = F.concat_ws("_", F.lit("board_DataEngineer_indonesia"), stamp)
    for source in ("board_north", "board_south"):
        part = rows.where(F.col("source") == source).select(*RAW_COLUMNS, run.alias("run"))
        # the lines are dealt out already, and a source has two runs
        raw.write_raw(part, f"{root}/Source_Data_{source}", formats, gather=False)
    return root


def _read_zone(spark: SparkSession, root: str, fmt: str) -> DataFrame:
    return raw.read_raw(spark, [f"{root}/Source_Data_{s}" for s in ("board_north", "board_south")], fmt)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_zone(spark, _raw_zone(spark, sf_dir, "csv"), "CSV")


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_zone(spark, _raw_zone(spark, sf_dir, "json"), "json")


def files_of_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's files by path, put next to the same day out of all files."""
    root = _raw_zone(spark, sf_dir, "csv")
    north = raw.read_raw(spark, f"{root}/Source_Data_board_north", table_date="2025-07-18")
    south = raw.read_raw(spark, f"{root}/Source_Data_board_south")
    return raw.concat_raw(north, raw.files_for_date(south, "2025-07-18"))


def _mixed_headers(spark: SparkSession, sf_dir: str) -> str:
    """Files under three headers: all ten columns, the first six, and another
    order with a column that is not known."""
    folder = scratch_path(spark, "headers") + "/Source_Data_board_north"
    rows = postings(spark, sf_dir)
    # files by size, without a shuffle of the wide rows
    n_files = -(-table(spark, sf_dir, "lineitem").count() // (3 * 500_000))
    headers = {0: RAW_COLUMNS, 1: RAW_COLUMNS[:6], 2: [*reversed(RAW_COLUMNS[1:]), "Extra", "Job_ID"]}
    for i, columns in headers.items():
        part = rows.where(F.abs(F.hash("URL")) % 3 == i).withColumn("Extra", F.lit("x"))
        run = f"run=board_DataEngineer_indonesia_2025071{8 + i // 2}_20102{i}"
        writer = part.select(*columns).coalesce(max(n_files, 1)).write.options(header=True, escape='"', compression="gzip")
        writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/{run}")
    return folder


def csv_columns_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = raw.read_raw(spark, _mixed_headers(spark, sf_dir))
    return found.select("URL", "Job_ID", "Role", "Company", "Location", "Publish_Time")


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files with six columns under new ones with ten."""
    rows = postings(spark, sf_dir)
    old = rows.where("day = '2025-07-18'").select(*reversed(RAW_COLUMNS[:6]))
    return raw.concat_raw(rows.where("day = '2025-07-19'").select(*RAW_COLUMNS), old)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = postings(spark, sf_dir).withColumn("table_date", F.col("day").cast("date"))
    return layers.stage(rows.select(*RAW_COLUMNS, "source", "table_date"))


def staging_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    layers.write_staging(_staged(spark, sf_dir), path)
    return layers.read_staging(spark, path, "board_north", "2025-07-18").drop("copies")


def _two_loads(spark: SparkSession, sf_dir: str, load_type: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    staged = _staged(spark, sf_dir)
    layers.load_bronze(staged.where("table_date = '2025-07-18'"), path, "full")
    second = staged.where("table_date = '2025-07-19'")
    if load_type == "full":
        second = second.where("source = 'board_north'")
    layers.load_bronze(second, path, load_type)
    return spark.read.parquet(path)


def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, full load replaces its one source and leaves the other."""
    return _two_loads(spark, sf_dir, "full")


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir, "incremental")


def _streamed(spark: SparkSession, folders: list[str], times: int = 2, files_per_batch: int = 1000) -> Lake:
    """Raw CSV folders through streams into one bronze table, each started several times."""
    lake = Lake(scratch_path(spark, "lake"))
    for folder in folders:
        checkpoint = scratch_path(spark, "checkpoint")
        for _ in range(times):
            stream_bronze(spark, folder, lake.bronze, checkpoint, files_per_batch=files_per_batch).awaitTermination()
    return lake


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw CSV files through the stream, started twice: no file counts twice."""
    root = _raw_zone(spark, sf_dir, "csv")
    lake = _streamed(spark, [f"{root}/Source_Data_{s}" for s in ("board_north", "board_south")])
    return lake.bronze.read(spark)


def stream_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of ``csv_columns_by_name`` through the stream."""
    lake = _streamed(spark, [_mixed_headers(spark, sf_dir)], 1)
    return lake.bronze.read(spark).select("URL", "Job_ID", "Role", "Company", "Location", "Publish_Time")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file to a micro-batch, then the many small files of bronze made few."""
    lake = _streamed(spark, [_mixed_headers(spark, sf_dir)], 1, files_per_batch=1)
    lake.bronze.compact(spark, least_files=2)
    return lake.bronze.read(spark).select("URL", "Job_ID", "Role", "Company", "Location", "Publish_Time")


def load_day_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both days to bronze, the second one twice: as if once."""
    lake, staged = Lake(scratch_path(spark, "lake")), _staged(spark, sf_dir)
    for day in ("2025-07-18", "2025-07-19", "2025-07-19"):
        lake.bronze.replace(staged.where(F.col("table_date") == day))
    return lake.bronze.read(spark)


def high_water_mark_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark and the rows of each source after two loads, from bronze's log."""
    lake, staged = Lake(scratch_path(spark, "lake")), _staged(spark, sf_dir)
    for day in ("2025-07-18", "2025-07-19"):
        lake.bronze.replace(staged.where(F.col("table_date") == day))
    return lake.bronze.maxima(spark, ["source"])


def _loads(spark: SparkSession, sf_dir: str) -> Lake:
    """Four incremental loads: the second day; the first one, whose postings are often
    earlier; the second one as it was; and the first one with only half of its rows."""
    lake, staged = Lake(scratch_path(spark, "lake")), _staged(spark, sf_dir)
    half = staged.where((F.col("table_date") == "2025-07-19") | (F.length("URL") % 2 == 0))
    for rows, day in ((staged, "2025-07-19"), (staged, "2025-07-18"), (staged, "2025-07-19"), (half, "2025-07-18")):
        load_day(spark, lake, rows.where(F.col("table_date") == day), ["board_north", "board_south"], day, "incremental")
        follow(spark, lake)
    return lake


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _loads(spark, sf_dir))


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gold(spark, _loads(spark, sf_dir))


def last_processed_time_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of each source before the first load, and after it."""
    lake, sources = scratch_path(spark, "lake"), ("board_north", "board_south")
    before = [last_processed_time(spark, lake, s, "incremental") for s in sources]
    Lake(lake).bronze.replace(_staged(spark, sf_dir))
    after = [last_processed_time(spark, lake, s, "incremental") for s in sources]
    return spark.createDataFrame(
        list(zip(sources, before, after, strict=True)), "source string, first_run string, mark string"
    )


def _daily(spark: SparkSession, sf_dir: str):
    """A full load of the first day, then an incremental one of the second."""
    root = _raw_zone(spark, sf_dir, "csv")
    folders = [f"{root}/Source_Data_{s}" for s in ("board_north", "board_south")]
    lake = scratch_path(spark, "lake")
    run_daily(spark, DailyRun(folders, lake, "2025-07-18", "CSV", "full"))
    return run_daily(spark, DailyRun(folders, lake, "2025-07-19", "CSV", "incremental"))


def daily_run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).silver


def daily_run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).gold


# --- reports ----------------------------------------------------------------


def jobs_by_role_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.jobs_by_role_location(clean_postings(postings(spark, sf_dir)))


def jobs_by_role_location_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.jobs_by_role_location_totals(clean_postings(postings(spark, sf_dir)))


def salary_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.salary_percentiles(clean_postings(postings(spark, sf_dir)))


def salary_percentiles_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_postings(postings(spark, sf_dir))
    return reports.salary_percentiles(rows, ["company"], (0.1, 0.5, 0.9))


def keyword_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.keyword_trend(clean_postings(postings(spark, sf_dir)), "month", 10, "raw_id", unique_keys=True)


def newest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.newest_jobs(clean_postings(postings(spark, sf_dir)), 100)
    return rows.select("job_id_platform", "role", "company", "posted_time", "url")


def salary_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.salary_distribution(clean_postings(postings(spark, sf_dir)), 100_000_000)


def postings_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = materialise(clean_postings(postings(spark, sf_dir)), "silver")
    fact = reports.postings_star(silver)["postings"]
    return fact.select("raw_id", "company_key", "location_key", "role_key", "posted_time")


def company_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dimension(clean_postings(postings(spark, sf_dir)), "company")


QUERIES = {
    f.__name__.rstrip("_"): f
    for f in (
        word_frequency, word_frequency_semi_join, word_frequency_repeated_keys,
        word_frequency_stop_table, word_frequency_by_language, job_words,
        silver_postings, silver_by_source, trimmed_text, role_casing_, work_type_normalised_,
        salary_bounds, role_keyword_match, required_fields,
        dedup_ignoring_time, dedup_report, first_per_key, dense_id_, dense_id_by_group,
        quality_nulls, quality_duplicates, quality_report,
        publish_time_from_age, parse_time_lenient_, high_water_mark, high_water_mark_by_group,
        newer_than, newer_than_pushed,
        page_links, page_details, page_cards, page_cards_matching, page_job_details,
        attach_details, collected_postings,
        csv_round_trip, csv_columns_by_name, last_processed_time_, json_round_trip, files_of_one_day, union_by_name, staging_pruned,
        load_full, load_incremental, load_day_twice, high_water_mark_maintained,
        stream_ingest, stream_by_header, stream_compacted, incremental_silver, incremental_gold, daily_run_silver, daily_run_gold,
        jobs_by_role_location, jobs_by_role_location_totals, salary_percentiles,
        salary_percentiles_by_company, keyword_trend, newest_jobs, salary_distribution,
        postings_fact, company_dimension,
    )
}
