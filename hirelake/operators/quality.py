"""Checks on the silver table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.schema import REQUIRED_SILVER


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def quality_nulls(silver: DataFrame, columns: Sequence[str] = REQUIRED_SILVER) -> DataFrame:
    """How many rows lack any of the required columns."""
    return silver.where(_any_null(columns)).agg(F.count(F.lit(1)).alias("null_count"))


def quality_duplicates(silver: DataFrame, key: str = "job_id_platform") -> DataFrame:
    """The keys that occur more than once; the list stays distributed."""
    counts = silver.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where("rows > 1").select(key)


def quality_report(
    silver: DataFrame,
    key: str = "job_id_platform",
    columns: Sequence[str] = REQUIRED_SILVER,
    by: Sequence[str] = (),
) -> DataFrame:
    """Both checks as two numbers, in one pass: counts per key are combined
    before the shuffle, so even a key on a third of all rows is a few rows."""
    per_key = silver.groupBy(*by, key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(_any_null(columns)).alias("_nulls")
    )
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("null_count"),
        F.count_if(F.col("_rows") > 1).alias("dup_count"),
    )
