"""High-water mark and the filter above it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.times import parse_time_lenient, render_time

LOAD_TYPES = ("full", "incremental")


def check_load_type(load_type: str) -> str:
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}, not {load_type!r}")
    return load_type


def high_water_mark(
    bronze: DataFrame, time: str = "Publish_Time", by: Sequence[str] = ()
) -> DataFrame:
    """The latest time in ``time`` as text, in ``max_time``: one row (null when
    there is none), or one per ``by`` group."""
    latest = F.max(parse_time_lenient(F.col(time)))
    return bronze.groupBy(*by).agg(render_time(latest).alias("max_time"))


def newer_than(df: DataFrame, mark: str | Column | None, time: str = "Publish_Time") -> DataFrame:
    """Rows strictly newer than the mark; all rows without one.

    Stored times are ``yyyy-MM-dd HH:mm:ss`` text, whose order is time order, so
    the comparison is a plain one and reaches the file scan.
    """
    if mark is None or (isinstance(mark, str) and not mark):
        return df
    return df.where(F.col(time) > (F.lit(mark) if isinstance(mark, str) else mark))
