"""What keeps time, spills and shuffles in proportion to the rows."""

from checks.tables import postings, spread
from hirelake.operators import dedup
from hirelake.plans import daily, silver, state
from hirelake.plans.state import Lake
from hirelake.schema import RAW
from hirelake.sources import layers, logged, raw
from hirelake.sources.logged import LoggedTable
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_rows_to_be_widened_are_dealt_out(spark):
    rows = spark.range(0, 1000, 1, 1)
    dealt = spread(rows, "id", rows_per_task=100)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.distinct().count() == 1000
    assert spread(rows, "id", rows_per_task=1000).rdd.getNumPartitions() == 1


def test_no_pattern_runs_over_the_whole_path():
    for column in (raw.run_date(), raw._source_in_path()):
        assert "substring_index" in str(column) and "regexp_extract(_metadata" not in str(column)


def test_commits_of_few_partitions_are_written_where_their_rows_are(spark, tmp_path):
    rows = spark.range(0, 9, 1, 3).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    schema = T.StructType.fromDDL("k string, v long")
    for gather, files in ((True, 1), (False, 3)):
        table = LoggedTable(str(tmp_path / str(gather)), schema, ("k",), gather=gather)
        table.replace(rows)
        assert [r["files"] for r in table.file_counts(spark).collect()] == [files]
        assert sorted(r["v"] for r in table.read(spark).collect()) == list(range(9))
    lake = Lake("x")
    assert not lake.bronze.gather and not lake.silver.gather and lake.first.gather


def _csv(folder, name, *ids):
    folder.mkdir(exist_ok=True)
    lines = ["Job_ID,Role,Company,Location,Publish_Time,URL"]
    lines += [f"{i},Data Engineer,C,L,2025-07-0{i} 00:00:00,u{i}" for i in ids]
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_raw_files_of_a_new_day_are_parsed_once(spark, tmp_path, monkeypatch):
    folder = _csv(tmp_path / "Source_Data_a", "a_20250718_000000.csv", 1, 2)
    asked, compared = [], []
    find, digests = daily.sources_without_rows, state._digests
    monkeypatch.setattr(daily, "sources_without_rows", lambda df, s: asked.append(df.inputFiles()) or find(df, s))
    monkeypatch.setattr(state, "_digests", lambda lake, rows: compared.append(1) or digests(lake, rows))
    run = daily.DailyRun([folder], str(tmp_path / "lake"), "2025-07-18")
    first = daily.run_daily(spark, run)
    assert all(f.endswith(".parquet") for f in asked[0]) and not compared
    assert first.silver.count() == 2
    _csv(tmp_path / "Source_Data_a", "a_20250718_000000.csv", 2)
    again = daily.run_daily(spark, run)  # a job less, and what is staged cannot tell
    assert all(f.endswith(".csv") for f in asked[1]) and len(compared) == 2
    assert [r["job_id_platform"] for r in again.silver.collect()] == ["2"]


def test_wide_rows_that_are_like_no_other_are_not_shuffled(spark):
    rows = spark.createDataFrame(
        [("a", None, 3), ("a", None, 2), ("a", None, None), (None, "a", 1), ("b", "x", None), ("c", "y", 5), ("c", "y", 5)],
        "k string, v string, t int",
    )
    found = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = found(dedup.dedup_ignoring(rows, "t", "copies"))
    assert found(dedup.dedup_wide(rows, "t", "copies")) == want
    assert found(dedup.dedup_wide(rows, "t", "copies", most=0)) == want
    for few, n in ((rows.where("k = 'b'"), 1), (rows.limit(0), 0)):
        once = dedup.dedup_wide(few, "t", "copies")
        assert once.count() == n and "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    # staging, which the loads read
    raw = spark.createDataFrame([("1", "2025-07-18 01:00:00"), ("2", "no time")], "Job_ID string, Publish_Time string")
    staged = layers.stage(raw)
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    assert found(staged) == [("1", "2025-07-18 01:00:00", 1), ("2", None, 1)]


def test_only_first_and_level_rows_are_shuffled_whole(spark):
    times = ["2025-01-02", "2025-01-01", None, "2025-01-01", "2025-01-03"]
    rows = [(f"{i % 3000}" if i % 11 else None, times[i % 7 % 5], f"u{i % 5}", "x" * (i % 3)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, t string, u string, w string").repartition(3)
    written = dedup.placed(df)
    want = sorted(map(tuple, dedup.first_per_key(df, ["k"], ["t", "u", "w"]).collect()), key=str)
    for order in (["t", "u", "w"], [F.asc("t"), F.asc("u"), F.asc("w")]):
        once = dedup.first_placed(written, ["k"], order, least=0)
        text = once._jdf.queryExecution().executedPlan().toString()
        assert once.columns == df.columns and "getbit" in text.lower() and text.count("Exchange hashpartitioning") == 1
        assert sorted(map(tuple, once.collect()), key=str) == want
    for few, most in ((10**6, 10**9), (0, 10)):  # few rows, or too many
        plain = dedup.first_placed(written, ["k"], ["t", "u", "w"], few, most)
        assert "getbit" not in plain._jdf.queryExecution().executedPlan().toString().lower()
        assert sorted(map(tuple, plain.collect()), key=str) == want
    assert dedup.first_placed(dedup.placed(df.limit(0)), ["k"], ["t", "u", "w"], least=0).count() == 0


def test_silver_of_many_rows_is_that_of_few(spark, sf_dir, monkeypatch):
    bronze = postings(spark, sf_dir)
    found = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = [found(silver.clean_postings(bronze)), found(silver.build_silver(bronze, ["source"]))]
    plain, read = dedup.first_placed, []
    monkeypatch.setattr(silver, "first_placed", lambda *a: read.append(1) or plain(*a, least=0))
    assert [found(silver.clean_postings(bronze)), found(silver.build_silver(bronze, ["source"]))] == want and len(read) == 2


def test_a_partition_is_named_once_and_older_commits_are_read(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, d string, v long")
    rows = [("a", None, 1), (None, "a", 2), ("", "a", 3), ("a", "", 4), ("a", None, 5), (None, None, 6)]
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    table = LoggedTable(str(tmp_path / "t"), schema, ("k", "d"))
    assert "sha2" not in str(logged._folder(table.keys)) and "regexp" not in str(logged._folder(table.keys))
    table.replace(frame(*rows))
    parts = {(r["k"], r["d"]): r["part"] for r in table.live(spark).collect()}
    named = frame(*rows).select("k", "d", logged._part_name(table.keys).alias("part")).distinct()
    assert parts == {(r["k"], r["d"]): r["part"] for r in named.collect()} and len(parts) == 5
    found = lambda: sorted(map(tuple, table.read(spark).collect()), key=str)
    assert found() == sorted(rows, key=str)
    # a commit as it was made before folders had names of their own
    old = frame(("a", None, 7), ("z", "z", 8)).withColumn("_part", logged._part_name(table.keys))
    old.write.partitionBy("_part").parquet(f"{table.path}/data/load=old")
    entries = old.groupBy(F.col("_part").alias("part"), "k", "d").agg(F.count(F.lit(1)).alias("rows"))
    facts = {"seq": F.lit(1).cast("long"), "load": F.lit("old"), "kind": F.lit("replace")}
    entries.withColumns(facts).write.mode("append").parquet(f"{table.path}/log")
    assert found() == sorted([*rows[1:4], rows[5], ("a", None, 7), ("z", "z", 8)], key=str)
    table.replace(frame(("z", "z", 9)))
    assert (("z", "z", 9) in found()) and (("z", "z", 8) not in found())
    assert {r["part"]: r["files"] for r in table.file_counts(spark).collect()}.keys() == {r["part"] for r in table.live(spark).collect()}


def test_raw_files_are_compressed_and_written_where_their_rows_are(spark, tmp_path):
    text = 'a "quoted", line\nand another'
    rows = [(f"{i}", "r", None, "l", "t", f"u{i}", "c", text, "", "w", f"b_T_x_2025071{i % 2}_100000") for i in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*RAW.fieldNames(), "run"])).repartition(4, "Job_ID")
    for fmt in ("csv", "json"):
        for gather, files in ((True, 2), (False, 8)):
            folder = tmp_path / f"Source_Data_{fmt}_{gather}"
            raw.write_raw(df, str(folder), [fmt], gather=gather)
            written = [*folder.glob("run=*/part-*")]
            assert len(written) == files and all(f.name.endswith(f".{fmt}.gz") for f in written)
            plain = "Job_ID,Role\n99,p\n" if fmt == "csv" else '{"Job_ID":"99","Role":"p"}\n'
            (folder / f"b_T_x_20250710_090000.{fmt}").write_text(plain)  # plain files beside them
            back = raw.read_raw(spark, str(folder), fmt)
            whole = {r["Job_ID"]: r["job_desc"] for r in back.collect()}
            assert back.count() == 41 and whole.pop("99") is None and set(whole.values()) == {text}
            assert raw.read_raw(spark, str(folder), fmt, table_date="2025-07-10").count() == 21
            assert raw.read_raw(spark, str(folder), fmt, table_date="2025-07-11", any_case=True).count() == 20
