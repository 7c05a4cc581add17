"""Tables whose live files are named by a log, and the lake kept up to date on them."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.plans import state
from hirelake.plans.silver import build_silver
from hirelake.plans.state import Lake, follow, fold_counts, load_day, read_gold, read_silver
from hirelake.schema import RAW
from hirelake.sources.logged import LoggedTable

SCHEMA = T.StructType().add("k", "string").add("d", "date").add("v", "string")


@pytest.fixture
def table(tmp_path):
    return LoggedTable(str(tmp_path / "t"), SCHEMA, ("k", "d"), "v")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, d string, v string").withColumn("d", F.col("d").cast("date"))


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_replace_append_and_scope(spark, table):
    assert values(table.read(spark)) == [] and table.last_commit(spark) == -1
    table.replace(rows(spark, ("a", "2025-01-01", "1"), ("a", "2025-01-02", "2"), ("b/..", None, "3"), (None, None, "4")))
    table.replace(rows(spark, ("a", "2025-01-01", "5"), ("a", "2025-01-01", "6")))
    assert values(table.read(spark)) == ["2", "3", "4", "5", "6"]
    assert table.append(rows(spark, ("a", "2025-01-02", "7")), "x") == 2
    assert table.append(rows(spark, ("a", "2025-01-02", "7")), "x") is None
    assert table.append(rows(spark).limit(0), "y") == 3 and table.has_tag(spark, "y")
    assert values(table.read(spark, F.col("k") == "a")) == ["2", "5", "6", "7"]
    table.replace(rows(spark, ("a", "2025-01-03", "8")), F.col("k") == "a")
    assert values(table.read(spark)) == ["3", "4", "8"]
    assert values(table.read(spark, upto=1)) == ["2", "3", "4", "5", "6"]
    table.replace(rows(spark).limit(0), F.lit(True))
    assert values(table.read(spark)) == []


def test_a_failing_check_leaves_the_old_rows(spark, table):
    table.replace(rows(spark, ("a", "2025-01-01", "1")))

    def check(written):
        assert values(written) == ["2"]
        raise ValueError("bad rows")

    with pytest.raises(ValueError, match="bad rows"):
        table.replace(rows(spark, ("a", "2025-01-01", "2")), F.lit(True), check)
    assert values(table.read(spark)) == ["1"] and table.last_commit(spark) == 0


def test_two_writers_are_noticed(spark, table, monkeypatch):
    table.replace(rows(spark, ("a", "2025-01-01", "1")))
    monkeypatch.setattr(LoggedTable, "last_commit", lambda self, spark: -1)
    with pytest.raises(RuntimeError, match="two writers"):
        table.replace(rows(spark, ("a", "2025-01-01", "2")))


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_maxima_come_from_the_log(spark, table):
    table.replace(rows(spark, ("a", "2025-01-01", "1"), ("a", "2025-01-02", "3"), ("b", "2025-01-01", "2")))
    table.replace(rows(spark, ("a", "2025-01-02", "0")))
    got = table.maxima(spark, ["k"])
    assert sorted(map(tuple, got.collect())) == [("a", "1", 2), ("b", "2", 1)]
    assert f"{table.path}/log" in plan(got) and f"{table.path}/data" not in plan(got)
    assert tuple(table.maxima(spark, where=F.col("k") == "none").first()) == (None, None)


def test_thirty_appends_become_few_files(spark, table):
    for i in range(30):
        table.append(rows(spark, ("a", "2025-01-01", f"{i:02}"), ("b", f"2025-01-{i % 3 + 1:02}", f"{i:02}b")).coalesce(1), str(i))
    before, files = values(table.read(spark)), table.file_counts(spark)
    assert files.agg(F.sum("files")).first()[0] == 60
    assert table.compact(spark, least_files=12) is not None  # the partition of a alone
    assert values(table.read(spark)) == before
    assert sorted(r["files"] for r in table.file_counts(spark).collect()) == [1, 10, 10, 10]
    table.compact(spark)
    assert sorted(r["files"] for r in table.file_counts(spark).collect()) == [1, 1, 1, 1]
    assert table.compact(spark) is None and values(table.read(spark)) == before
    assert table.append(rows(spark, ("a", "2025-01-01", "x")), "7") is None  # tags outlive their files


# --- the lake ---------------------------------------------------------------


def posting(i, time, desc="SQL", url=None):
    return (f"{i}", "data engineer", None, "City", f"2025-07-{time}", url or f"u/{i}", "x", desc, "", "")


def staged(spark, day, *postings, source="north"):
    df = spark.createDataFrame(list(postings), RAW)
    return df.withColumn("source", F.lit(source)).withColumn("table_date", F.lit(f"2025-07-{day}").cast("date"))


def load(spark, lake, day, *postings, load_type="incremental", **more):
    load_day(spark, lake, staged(spark, day, *postings), ["north"], f"2025-07-{day}", load_type)
    follow(spark, lake, **more)
    same(spark, lake)


def same(spark, lake):
    """Silver and gold equal a rebuild from all bronze."""
    bronze = lake.bronze.read(spark)
    silver = build_silver(bronze, ["source"])
    assert sorted(map(tuple, read_silver(spark, lake).collect()), key=str) == sorted(map(tuple, silver.collect()), key=str)
    want = {}
    for r in silver.collect():
        for w in set((r["job_desc"] or "").lower().split(" ")) - {""}:
            want[w] = want.get(w, 0) + 1
    assert {r["word"]: r["frequency"] for r in read_gold(spark, lake).collect()} == want


def test_loads_equal_a_rebuild(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), 4)
    load(spark, lake, "19", posting(1, "19 01:00:00"), posting(2, "19 02:00:00", "spark SQL"), posting(2, "19 03:00:00"))
    load(spark, lake, "18", posting(1, "18 01:00:00", "kafka"), posting(2, "19 02:00:00", "SQL", "a/2"), posting(3, "18 01:00:00"))
    commits = lake.first.last_commit(spark)
    load(spark, lake, "20", posting(1, "20 01:00:00", "late"), posting(2, "20 01:00:00"))
    assert lake.first.last_commit(spark) == commits  # nothing new, nothing earlier
    load(spark, lake, "18", posting(3, "18 01:00:00"))  # the day again, with less
    load(spark, lake, "21", posting(None, "21 01:00:00"), posting(4, "21 01:00:00", None))
    load(spark, lake, "22", posting(5, "22 01:00:00"), load_type="full")
    assert lake.bronze.read(spark).count() == 1


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), 64)
    load(spark, lake, "18", *[posting(i, "18 01:00:00", f"word{i}") for i in range(200)])
    before = {r["part"]: r["load"] for r in lake.first.live(spark).collect()}
    day = staged(spark, "19", posting(7, "18 00:30:00", "earlier"), posting(9, "19 01:00:00", "later"))
    read = lake.first.read(spark, state._in(state._buckets(day.withColumn("bucket", lake.bucket()))))
    assert len(read.inputFiles()) == 2
    load_day(spark, lake, day, ["north"], "2025-07-19", "incremental")
    after = {r["part"]: r["load"] for r in lake.first.live(spark).collect()}
    assert len(before) > 50 and sum(before[p] != after[p] for p in before) == 1
    follow(spark, lake)
    same(spark, lake)
    assert lake.counts.live(spark).orderBy("seq").collect()[-1]["rows"] == 2  # -word7 +earlier


def test_a_run_that_died_is_caught_up(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), 4)
    load(spark, lake, "18", posting(1, "18 01:00:00", "kafka"), posting(2, "18 01:00:00"))

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(state, "_follow_counts", dies)
    with pytest.raises(KeyboardInterrupt):
        load(spark, lake, "19", posting(1, "17 01:00:00", "spark"))
    monkeypatch.undo()
    load_day(spark, lake, staged(spark, "20", posting(3, "20 01:00:00", "airflow")), ["north"], "2025-07-20", "incremental")
    follow(spark, lake)
    same(spark, lake)


def test_a_failing_quality_check_keeps_silver(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), 4)
    load(spark, lake, "18", posting(1, "18 01:00:00"))

    def check(written):
        if written.where("job_id_platform = '2'").count():
            raise ValueError("quality")

    with pytest.raises(ValueError, match="quality"):
        load(spark, lake, "19", posting(2, "19 01:00:00", "spark"), check=check)
    assert [r["job_id_platform"] for r in read_silver(spark, lake).collect()] == ["1"]
    assert [r["word"] for r in read_gold(spark, lake).collect()] == ["sql"]
    follow(spark, lake)  # let through
    same(spark, lake)


def test_counts_are_folded(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), 2)
    for i in range(4):
        load(spark, lake, f"{18 - i}", posting(1, f"{18 - i} 01:00:00", f"word{i} SQL"))
    assert fold_counts(spark, lake, 5) is None and fold_counts(spark, lake, 4) is not None
    assert lake.counts.live(spark).count() == 1
    same(spark, lake)
    load(spark, lake, "10", posting(2, "10 01:00:00", "SQL"))
