"""The physical plans that scale depends on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.tables import postings
from hirelake.operators.dedup import dedup_ignoring, first_per_key
from hirelake.operators.incremental import newer_than
from hirelake.operators.pages import attach_details, attach_pages, extract_details, wanted_pages
from hirelake.operators.reports import postings_star
from hirelake.operators.words import keyword_trend, word_frequency, word_frequency_semi_join
from hirelake.plans.silver import build_silver, clean_postings
from hirelake.scratch import materialise, scratch_path
from hirelake.sources import layers


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_word_frequency_is_one_shuffle(spark, sf_dir):
    text = plan(word_frequency(documents(spark, sf_dir), "doc_id", "text", unique_keys=True))
    assert text.count("Exchange") == 1 and "partial_count" in text
    assert "TakeOrderedAndProject" in text and "INSET" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "Python" not in text and "lambda" not in text


def test_semi_join_counts_once(spark, sf_dir):
    top = word_frequency_semi_join(documents(spark, sf_dir), "doc_id", "text", unique_keys=True)
    assert len(top.collect()) == 300
    final = plan(top).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_ranked_counts_are_cut_before_the_shuffle(spark, sf_dir):
    docs = documents(spark, sf_dir)
    by_lang = word_frequency(docs, "doc_id", "text", by=["lang"])
    posted = F.expr("timestamp_ntz'2025-01-01' + make_dt_interval(cast(doc_id % 90 as int))")
    dated = docs.select("doc_id", F.col("text").alias("job_desc"), posted.alias("posted_time"))
    for df in (by_lang, keyword_trend(dated, key="doc_id")):
        assert "Partial" in plan(df) and "WindowGroupLimit" in plan(df)


def test_first_per_key_limits_before_the_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(first_per_key(events, ["user_id"], ["ts", "event_id"]))
    final, partial = text.index(", 1, Final"), text.index(", 1, Partial")
    assert final < text.index("Exchange") < partial


def test_dedup_combines_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedup_ignoring_time"](spark, sf_dir))
    assert "partial_min" in text and "HashAggregate" in text and "SortAggregate" not in text


def test_repeated_keys_are_made_distinct_by_key_and_word(spark, sf_dir):
    text = plan(QUERIES["word_frequency_repeated_keys"](spark, sf_dir))
    assert text.count("Exchange") == 2 and "Exchange hashpartitioning(conv_id" in text


def test_a_stop_table_meets_counts(spark, sf_dir, large_joins):
    text = plan(QUERIES["word_frequency_stop_table"](spark, sf_dir))
    join = text.index("LeftAnti")
    assert "partial_count" not in text[:join] and "partial_count" in text[join:]


def test_only_wanted_pages_are_parsed(spark):
    cards = spark.createDataFrame([("u/1",)], "URL string")
    pages = spark.createDataFrame([(1, "u/1", "<p>"), (2, "u/2", "<p>")], "page_id long, url string, html string")
    text = plan(extract_details(wanted_pages(cards, pages)))
    semi = text.index("LeftSemi")
    assert "jobAdDetails" in text[:semi] and "jobAdDetails" not in text[semi:]
    assert [r.URL for r in attach_pages(cards, pages).collect()] == ["u/1"]


def test_silver_shuffles_wide_rows_once(spark, sf_dir):
    bronze = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        *[F.col("props").alias(c) for c in
          ("Job_ID", "Role", "Company", "Location", "Publish_Time", "URL", "country", "job_desc", "salary", "work_type")]
    )
    assert plan(clean_postings(bronze)).count("Exchange") == 1


@pytest.fixture
def large_joins(spark):
    """No broadcast, and partitions of some hundred KB count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_url_on_a_third_of_the_cards_is_split(spark, large_joins):
    n = F.col("id")
    cards = spark.range(300000).select(
        F.when(n % 3 == 0, F.lit("u0")).otherwise(F.concat(F.lit("u"), n % 5000)).alias("URL"), n
    )
    details = spark.range(6000).select(
        n.alias("page_id"), F.concat(F.lit("u"), n % 5000).alias("URL"),
        *[F.lit("d").alias(c) for c in ("job_desc", "salary", "work_type")],
    )
    joined = attach_details(cards, details)
    assert len(joined.collect()) == 300000
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_a_company_on_a_third_of_the_postings_is_split(spark, large_joins):
    n = F.col("id")
    silver = spark.range(300000).select(
        F.when(n % 3 == 0, F.lit("c0")).otherwise(F.concat(F.lit("c"), n % 5000)).alias("company"), n
    )
    fact = postings_star(silver, ("company",), ("id",))["postings"]
    assert len(fact.collect()) == 300000
    assert "SortMergeJoin(skew=true)" in plan(fact)


def test_numbers_join_adds_no_shuffle_of_wide_rows(spark, sf_dir, large_joins):
    silver = build_silver(materialise(postings(spark, sf_dir), "bronze"))
    # One for the wide rows, three for the numbers and their shifts.
    assert plan(silver).count("Exchange hashpartitioning") == 4


def test_mark_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "ts")
    assert "GreaterThan(event_type,b)" in plan(newer_than(events, "b", "event_type"))


def test_staging_prunes_folders(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "2025-07-18"), ("2", "b", "2025-07-19")], "Job_ID string, source string, d string")
    path = str(tmp_path / "s")
    layers.write_staging(df.select("Job_ID", "source", F.col("d").cast("date").alias("table_date")), path)
    text = plan(layers.read_staging(spark, path, "a", "2025-07-18"))
    assert "(table_date#" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_scratch_needs_a_shared_folder():
    class Conf(dict):
        get = dict.get

    class Session:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    assert scratch_path(Session(**{"spark.checkpoint.dir": "hdfs://x/y/"}), "t").startswith("hdfs://x/y/t-")
    assert scratch_path(Session(**{"spark.master": "local[2]"}), "t")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(**{"spark.master": "yarn"}), "t")
