"""Bronze to silver."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.functions.money import salary_max, salary_min
from hirelake.functions.text import clean_text, role_casing, work_type_normalised
from hirelake.functions.times import parse_time
from hirelake.operators.dedup import first_per_key, first_placed, placed
from hirelake.operators.keys import dense_id
from hirelake.schema import RAW, REQUIRED_RAW, SILVER


def require_fields(bronze: DataFrame) -> DataFrame:
    """Rows that have everything a posting needs."""
    return bronze.dropna(subset=REQUIRED_RAW)


# What settles which posting of a job is the first.
FIRST_BY = ["Publish_Time", "URL", *[c for c in RAW.fieldNames() if c not in ("Job_ID", "Publish_Time", "URL")]]


def first_postings(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The earliest row of each job that has everything a posting needs, as it is in
    bronze. Jobs are told apart by the text of ``Job_ID``; ids that differ only in
    outer spaces stay two rows, which the quality check reports. Equal times are settled
    by URL and then by all other columns, so a task that runs again picks the same row.
    """
    return first_per_key(require_fields(bronze), [*by, "Job_ID"], FIRST_BY)


def clean_postings(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Silver without its dense key: one cleaned row per job, the earliest. Bronze is
    read once, when this is called."""
    return _cleaned_first(_placed(bronze, by), by)


def _placed(bronze: DataFrame, by: Sequence[str]) -> DataFrame:
    return placed(require_fields(bronze).select(*RAW.fieldNames(), *by))


def _cleaned_first(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of :func:`first_postings` out of written ones, cleaned."""
    return cleaned(first_placed(rows, [*by, "Job_ID"], FIRST_BY), by)


def cleaned(first: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`first_postings` in silver's columns, without its dense key;
    ``raw_id`` holds the untrimmed id."""
    text = {c: clean_text(F.col(c)) for c in RAW.fieldNames()}
    trimmed = first.select(
        *by,
        F.col("Job_ID").alias("raw_id"),
        text["Job_ID"].alias("job_id_platform"),
        text["Role"].alias("role"),
        F.coalesce(text["Company"], F.lit(vocab.NO_COMPANY)).alias("company"),
        text["Location"].alias("location"),
        parse_time(F.col("Publish_Time"), default=vocab.NO_TIME).alias("posted_time"),
        text["URL"].alias("url"),
        text["job_desc"].alias("job_desc"),
        text["salary"].alias("salary"),
        text["work_type"].alias("work_type"),
        text["country"].alias("country"),
    )
    return trimmed.withColumns(
        {
            "role": role_casing(F.col("role")),
            "work_type": work_type_normalised(F.col("work_type")),
            "salary_min_cleaned": salary_min(F.col("salary")),
            "salary_max_cleaned": salary_max(F.col("salary")),
        }
    )


def job_numbers(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``raw_id`` and its ``job_id`` 1..N, by trimmed id as text, descending.

    Only ids are read, made distinct and numbered; job texts take no part.
    """
    ids = require_fields(bronze).select(*by, F.col("Job_ID").alias("raw_id")).distinct()
    numbered = dense_id(
        ids.withColumn("_platform", clean_text(F.col("raw_id"))),
        [F.desc("_platform"), F.asc("raw_id")],
        "job_id",
        by,
    )
    return numbered.drop("_platform")


def build_silver(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The silver table. ``by`` (such as the source) keeps sets of postings
    apart in one table; its columns come last.

    Bronze is written once. Of many rows only the earliest of each job are shuffled as
    a whole, by job; the join with the numbers meets them where they are.
    """
    written = _placed(bronze, by)
    rows = _cleaned_first(written, by).join(job_numbers(written, by), [*by, "raw_id"])
    return rows.select(*SILVER.fieldNames(), *by)
