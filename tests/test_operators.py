import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelake.operators.dedup import copies_report, dedup_ignoring, dedup_report, first_per_key
from hirelake.operators.incremental import check_load_type, high_water_mark, newer_than
from hirelake.operators.keys import dense_id
from hirelake.operators.quality import quality_duplicates, quality_nulls, quality_report
from hirelake.operators.reports import postings_star, salary_distribution
from hirelake.operators.words import word_frequency, word_frequency_semi_join
from hirelake.plans.silver import build_silver
from hirelake.schema import RAW, SILVER

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
cell = st.one_of(st.none(), st.sampled_from(["a", "b", ""]))


@few
@given(st.lists(st.tuples(cell, cell, cell), max_size=30))
def test_dedup(spark, rows):
    df = spark.createDataFrame(rows, "x string, y string, t string")
    got = dedup_ignoring(df, "T", "copies")
    want = {}
    for x, y, t in rows:
        want.setdefault((x, y), []).append(t)
    assert {tuple(r) for r in got.collect()} == {
        (*k, min((t for t in ts if t is not None), default=None), len(ts)) for k, ts in want.items()
    }
    report = (len(rows), len(want), len(rows) - len(want))
    assert tuple(dedup_report(df, "t").first()) == tuple(copies_report(got, "copies").first()) == report
    again = dedup_ignoring(got.drop("copies"), "t")
    assert sorted(map(str, again.collect())) == sorted(map(str, got.drop("copies").collect()))


@few
@given(st.lists(st.integers(0, 10**6), max_size=60, unique=True), st.integers(1, 3))
def test_dense_id(spark, keys, groups):
    df = spark.createDataFrame([(str(k), f"g{k % groups}") for k in keys], "k string, g string")
    for by in ([], ["g"]):
        window = Window.partitionBy(*by).orderBy(F.desc("k"))
        want = df.withColumn("id", F.row_number().over(window).cast("long"))
        got = dense_id(df, [F.desc("k")], "id", by)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dense_id_with_one_hot_value(spark):
    """A value on most rows is spread by the tie-break."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id"
    )
    got = dense_id(df, [F.asc("k"), F.asc("id")], "n")
    assert got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (20000, 1, 20000)
    slices = df.repartitionByRange(4, "k", "id").groupBy(F.spark_partition_id()).count()
    assert slices.agg(F.max("count")).first()[0] < 10000


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 5, "d"), (None, 1, "e")], "k int, o int, v string")
    assert {r.v for r in first_per_key(df, ["k"], ["o"]).collect()} == {"b", "d", "e"}


def test_words_count_once_per_job(spark):
    df = spark.createDataFrame(
        [(1, "Spark spark the SQL"), (2, "sql, (Kafka)"), (3, None), (None, "spark")], "job_id int, job_desc string"
    )
    want = [("sql", 2), ("kafka", 1), ("spark", 1)]
    assert [tuple(r) for r in word_frequency(df).collect()] == want
    assert [tuple(r) for r in word_frequency_semi_join(df).collect()] == want
    assert [tuple(r) for r in word_frequency(df, top=1).collect()] == want[:1]


def test_words_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, "sql"), (1, "SQL etl"), (2, "sql")], "job_id int, job_desc string")
    got = word_frequency(df).collect()
    assert [tuple(r) for r in got] == [("sql", 2), ("etl", 1)]


def bronze(spark, *rows):
    names = RAW.fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], RAW)


def posting(job, time="2025-07-18 00:00:00", **more):
    return {"Job_ID": job, "Role": "data engineer", "Publish_Time": time, "URL": f"u/{job}"} | more


def test_silver(spark):
    rows = bronze(
        spark,
        posting("9999", Company=" "),
        posting("85000", "2025-07-19 00:00:00", Role="late"),
        posting("85000", "2025-07-18 00:00:00", Role=" DATA ENGINEER "),
        posting(" 85000"),
        posting(None),
        posting("1", None),
        posting("2", URL=None),
    )
    silver = build_silver(rows)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    got = [(r.job_id, r.job_id_platform, r.role, r.company) for r in silver.orderBy("job_id").collect()]
    # By text, descending; ids that differ in outer spaces stay apart.
    assert got == [
        (1, "9999", "Data Engineer", ""),
        (2, "85000", "Data Engineer", "Advertiser didn't show the company"),
        (3, "85000", "Data Engineer", "Advertiser didn't show the company"),
    ]
    assert [r[0] for r in quality_duplicates(silver).collect()] == ["85000"]
    assert quality_nulls(silver).first()[0] == 0
    assert tuple(quality_report(silver).first()) == (0, 1)


def test_silver_of_nothing(spark):
    silver = build_silver(bronze(spark))
    assert silver.count() == 0
    assert tuple(quality_report(silver).first()) == (0, 0)


def test_silver_ties_are_settled(spark):
    rows = [posting("1", Company=c, job_desc=d) for c in "cab" for d in "zx"]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        (row,) = build_silver(bronze(spark, *rows).repartition(seed + 1)).collect()
        seen.add((row.company, row.job_desc))
    assert seen == {("a", "x")}


def test_marks(spark):
    df = spark.createDataFrame([("2025-01-02 00:00:00",), ("2025-01-01 00:00:00",), (None,), ("bad",)], "Publish_Time string")
    assert high_water_mark(df).first()[0] == "2025-01-02 00:00:00"
    assert high_water_mark(df.limit(0)).first()[0] is None
    assert newer_than(df.limit(3), "2025-01-01 00:00:00").count() == 1
    assert newer_than(df, None).count() == newer_than(df, "").count() == 4
    with pytest.raises(ValueError):
        check_load_type("Full")


def test_salary_bands(spark):
    df = spark.createDataFrame([(5, 8), (9, 20), (12, None), (None, 7)], "a int, b int").select(
        F.col("a").cast("decimal(38,9)").alias("salary_min_cleaned"),
        F.col("b").cast("decimal(38,9)").alias("salary_max_cleaned"),
    )
    got = {r[0] if r[0] is None else int(r[0]): r[1] for r in salary_distribution(df, 10).collect()}
    assert got == {0: 2, 10: 1, None: 1}


def test_the_median_is_exact_in_large_bands(spark):
    n = 300_001
    df = spark.range(0, n, 1, 7).select(
        F.expr(f"id * 7919 % {n}").cast("decimal(38,9)").alias("salary_min_cleaned"),
        F.lit(None).cast("decimal(38,9)").alias("salary_max_cleaned"),
    )
    row = salary_distribution(df, 1_000_000).first()
    assert (row.postings, row.lowest_min, row.median_min, row.highest_max) == (n, 0, 150_000, None)


def test_star_keeps_every_posting(spark):
    df = spark.createDataFrame([("a", None, "r"), ("a", "x", "r"), ("b", "x", "s")], "company string, location string, role string")
    star = postings_star(df)
    got = sorted(map(str, star["postings"].select("company_key", "location_key", "role_key").collect()))
    assert len(got) == 3 and "None" in got[0] + got[1] + got[2]
    assert [tuple(r) for r in star["company"].orderBy("company_key").collect()] == [("a", 1), ("b", 2)]
