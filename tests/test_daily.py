import pytest
from pyspark.sql import functions as F

from hirelake.plans.daily import DailyRun, collect_pages, last_processed_time, run_daily
from hirelake.plans.state import Lake, read_silver
from hirelake.schema import RAW
from hirelake.sources.raw import write_raw


@pytest.fixture
def folders(spark, tmp_path):
    """Two sources, two days each; day two repeats a posting of day one."""
    out = []
    for s in ("north", "south"):
        for day, ids in (("18", [1, 2, 2]), ("19", [2, 3])):
            rows = [
                (f"{i}", "data engineer", None, "City", f"2025-07-{day} 0{i}:00:00", f"u/{i}", s, f"SQL word{i}", "", "")
                for i in ids
            ]
            df = spark.createDataFrame(rows, RAW).withColumn("run", F.lit(f"b_T_{s}_202507{day}_100000"))
            write_raw(df, f"{tmp_path}/Source_Data_{s}")
        out.append(f"{tmp_path}/Source_Data_{s}")
    return out


def test_two_days(spark, folders, tmp_path):
    lake = str(tmp_path / "lake")
    first = run_daily(spark, DailyRun(folders, lake, "2025-07-18", "csv", "full"))
    assert tuple(first.dedup.first()) == (6, 4, 2)
    assert last_processed_time(spark, lake, "north", "incremental") == "2025-07-18 02:00:00"
    assert last_processed_time(spark, lake, "north", "full") == ""

    both = run_daily(spark, DailyRun(folders, lake, "2025-07-19", "json"))
    assert both.bronze.count() == 8
    silver = both.silver.orderBy("source", "job_id").collect()
    assert [(r.source, r.job_id, r.job_id_platform) for r in silver] == [
        (s, 4 - i, str(i)) for s in ("north", "south") for i in (3, 2, 1)
    ]
    # The earliest posting of a job wins over its repeat on day two.
    assert str(silver[1].posted_time) == "2025-07-18 02:00:00"
    assert sorted(map(tuple, both.quality.collect())) == [("north", 0, 0), ("south", 0, 0)]
    gold = {(r.source, r.word): r.frequency for r in both.gold.collect()}
    assert gold["north", "sql"] == 3 and gold["south", "word3"] == 1

    # Loading a day again replaces it.
    again = run_daily(spark, DailyRun(folders, lake, "2025-07-19", "json"))
    assert again.bronze.count() == 8
    assert again.silver.orderBy("source", "job_id").collect() == silver

    # A full load of one source leaves the other one as it is.
    run_daily(spark, DailyRun(folders[:1], lake, "2025-07-19", "csv", "full"))
    counts = read_silver(spark, Lake(lake)).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in counts} == {"north": 2, "south": 3}


def test_a_day_without_rows(spark, folders, tmp_path):
    """A file with nothing but a header counts; a full load then empties the
    source everywhere."""
    lake = str(tmp_path / "lake")
    run_daily(spark, DailyRun(folders, lake, "2025-07-18", "csv", "full"))
    with open(f"{folders[0]}/b_T_north_20250720_100000.csv", "w") as f:
        f.write("Job_ID,Role,Company,Location,Publish_Time,URL\n")
    result = run_daily(spark, DailyRun(folders[:1], lake, "2025-07-20", "csv", "full"))
    tables = (result.bronze, result.silver, result.gold)
    assert [t.count() for t in tables] == [0, 0, 0]
    assert tuple(result.dedup.first()) == (0, 0, 0)
    assert read_silver(spark, Lake(lake)).select("source").distinct().collect() == [("south",)]


def test_first_day_without_rows(spark, folders, tmp_path):
    with open(f"{folders[0]}/b_T_north_20250720_100000.csv", "w") as f:
        f.write("Job_ID,Role,Company,Location,Publish_Time,URL\n")
    result = run_daily(spark, DailyRun(folders[:1], str(tmp_path / "lake"), "2025-07-20"))
    assert (result.silver.count(), result.gold.count()) == (0, 0)


def test_missing_day(spark, folders, tmp_path):
    with pytest.raises(ValueError, match="2025-07-20"):
        run_daily(spark, DailyRun(folders, str(tmp_path / "lake"), "2025-07-20"))


def test_load_type_is_checked_first(spark, tmp_path):
    with pytest.raises(ValueError, match="load_type"):
        run_daily(spark, DailyRun([], str(tmp_path), "2025-07-20", "csv", "append"))


def card(job, age):
    return (
        f'<div data-search-sol-meta="{job}"><article data-job-id="{job}"><a data-automation="jobTitle">'
        f'Data Engineer {job}</a><span data-automation="jobListingDate">{age}</span></article></div>'
    )


def test_pages_to_gold_above_the_mark(spark, tmp_path):
    """Two days of pages: on the second, only cards newer than the mark are taken."""
    lake, folder = str(tmp_path / "lake"), str(tmp_path / "Source_Data_board_sg")
    details = spark.createDataFrame(
        [(i, f"https://e/{i}", f'<div data-automation="jobAdDetails"><p>word{i} SQL</p></div>') for i in (1, 2, 3)],
        "page_id long, url string, html string",
    )

    def day(date, load_type, *cards):
        search = spark.createDataFrame(
            [(1, "s", "".join(cards), "Data Engineer"), (2, "s", card(9, "1h ago"), "Gardener")],
            "page_id long, url string, html string, keyword string",
        ).withColumn("scraped_at", F.lit(f"{date} 12:00:00").cast("timestamp_ntz"))
        mark = last_processed_time(spark, lake, "board_sg", load_type)
        stamp = date.replace("-", "") + "_120000"
        collect_pages(search, details, folder, "board", "https://e/", "sg", stamp, mark)
        return run_daily(spark, DailyRun([folder], lake, date, "json", load_type))

    day("2025-07-18", "full", card(1, "3h ago"), card(2, "2h ago"))
    result = day("2025-07-19", "incremental", card(1, "27h ago"), card(2, "26h ago"), card(3, "5m ago"))
    assert result.bronze.count() == 3
    assert [r.job_id_platform for r in result.silver.orderBy("job_id").collect()] == ["3", "2", "1"]
    assert [tuple(r)[:2] for r in result.gold.orderBy(F.desc("frequency"), "word").collect()] == [
        ("sql", 3), ("word1", 1), ("word2", 1), ("word3", 1),
    ]


def test_jobs_do_not_grow_with_the_sources(spark, tmp_path):
    """Jobs of a run over one source and over six."""
    made = {}
    for n in (1, 6):
        root = tmp_path / str(n)
        folders = [f"{root}/Source_Data_s{i}" for i in range(n)]
        for f in folders:
            rows = [("1", "data engineer", None, "City", "2025-07-18 01:00:00", "u/1", "x", "SQL", "", "")]
            write_raw(spark.createDataFrame(rows, RAW).withColumn("run", F.lit("b_T_x_20250718_100000")), f, ("csv",))
        tracker, group = spark.sparkContext.statusTracker(), f"sources-{n}"
        spark.sparkContext.setJobGroup(group, group)
        result = run_daily(spark, DailyRun(folders, f"{root}/lake", "2025-07-18", "csv", "full"))
        made[n] = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert result.silver.count() == n
    assert made[1] == made[6]


def test_first_incremental_run(spark, tmp_path):
    assert last_processed_time(spark, str(tmp_path / "none"), "north", "incremental") == ""
