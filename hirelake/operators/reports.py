"""Reports over silver that the stated use cases call for."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.keys import dense_id
from hirelake.scratch import materialise


FACTS = (
    "job_id", "job_id_platform", "raw_id", "source", "posted_time",
    "salary_min_cleaned", "salary_max_cleaned",
)


def jobs_by_role_location(silver: DataFrame) -> DataFrame:
    """Postings per role and location."""
    return silver.groupBy("role", "location").agg(F.count(F.lit(1)).alias("postings"))


def jobs_by_role_location_totals(silver: DataFrame) -> DataFrame:
    """Postings per role and location, with subtotals per role and the grand total
    (``rollup``). ``level`` tells them from null values: 0 for a pair, 1 for a role over
    all locations, 3 for everything. Rows are combined by pair before the shuffle, so a
    subtotal is a sum of one row per task and pair."""
    return silver.rollup("role", "location").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("postings")
    )


def salary_percentiles(
    silver: DataFrame, by: Sequence[str] = (), shares: Sequence[float] = (0.25, 0.5, 0.75), column: str = "salary_min_cleaned"
) -> DataFrame:
    """``share``, ``value`` and ``postings`` per group: the smallest salary that at least
    that share of the group's salaries does not exceed. Exact at every size.

    Different salaries are counted first, with partial counts before the shuffle. The
    counts are then range-partitioned by group and salary, so a group may be spread over
    any number of tasks; running sums within each slice are shifted by the slices before
    it, and a share's rank picks one row.
    """
    value = F.col(column)
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(f"_{c}") for c in by]
    counted = (
        silver.where(value.isNotNull())
        .groupBy(*by, value.alias("value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("*", *keys)
    )
    names = [f"_{c}" for c in by] or [F.lit(0)]
    slices = materialise(
        counted.repartitionByRange(*([f"_{c}" for c in by]), "value")
        .withColumn("_slice", F.spark_partition_id()),
        "percentiles",
    )
    running = Window.partitionBy(*names, "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*names)
    sizes = slices.groupBy(*[f"_{c}" for c in by], "_slice").agg(F.sum("_n").alias("_rows"))  # one for each task and group
    sizes = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))).withColumn("_all", F.sum("_rows").over(whole))
    sizes = materialise(sizes.drop("_rows"), "percentile-starts")
    ranked = (
        slices.withColumn("_in", F.sum("_n").over(running))
        .join(sizes, [*[f"_{c}" for c in by], "_slice"])
        .withColumn("_upto", F.col("_start") + F.col("_in"))
    )
    asked = F.array(*[F.lit(float(s)) for s in shares])
    # the rank of a share: the first row of 1..n is that of share 0
    rank = lambda s: F.greatest(F.lit(1), F.ceil(s * F.col("_all")))
    hit = F.filter(asked, lambda s: (rank(s) <= F.col("_upto")) & (rank(s) > F.col("_upto") - F.col("_n")))
    return ranked.select(*by, F.explode(hit).alias("share"), "value", F.col("_all").alias("postings"))


def newest_jobs(silver: DataFrame, n: int = 100, key: str = "job_id_platform") -> DataFrame:
    """The ``n`` latest postings: a top-k per task, then over those."""
    return silver.orderBy(F.desc("posted_time"), F.asc(key), F.asc("url")).limit(n)


def salary_distribution(silver: DataFrame, width: int) -> DataFrame:
    """Postings per band of ``width`` of the lower salary bound, with the range of
    bounds seen and the (lower) median of the lower bound; postings without a salary
    form the band null. Different bounds are counted first, so a band's window has
    one row for each of them."""
    low = F.col("salary_min_cleaned")
    band = F.floor(low / F.lit(width).cast("decimal(18,0)")).cast("decimal(38,0)") * width
    counted = silver.groupBy(band.cast("decimal(38,0)").alias("salary_from"), low).agg(
        F.count(F.lit(1)).alias("_n"), F.max("salary_max_cleaned").alias("_highest")
    )
    all_ = Window.partitionBy("salary_from")
    upto = all_.orderBy("salary_min_cleaned").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(all_))
    return ranked.groupBy("salary_from").agg(
        F.sum("_n").alias("postings"),
        F.min("salary_min_cleaned").alias("lowest_min"),
        F.max("_highest").alias("highest_max"),
        F.min(F.when(2 * F.col("_upto") >= F.col("_all"), low)).alias("median_min"),
    )


def dimension(silver: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column with a dense key in value order."""
    values = silver.select(column).where(F.col(column).isNotNull()).distinct()
    return dense_id(values, [F.asc(column)], f"{column}_key")


def postings_star(
    silver: DataFrame,
    columns: tuple[str, ...] = ("company", "location", "role"),
    facts: tuple[str, ...] = FACTS,
) -> dict[str, DataFrame]:
    """A dimension per column and the fact ``postings`` that refers to them, with
    those of the columns ``facts`` that there are: ids, times and measures. Texts
    are left in silver, so the joins move narrow rows.

    Dimensions are built from distinct values and joined by equality; AQE splits
    a value that many postings share. Null values keep a null key.
    """
    star = {c: dimension(silver, c) for c in columns}
    fact = silver.select(*[c for c in silver.columns if c in facts or c in columns])
    for c in columns:
        fact = fact.join(star[c], c, "left").drop(c)
    return star | {"postings": fact}
