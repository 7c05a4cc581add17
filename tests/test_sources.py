import json
import os

import pytest
from pyspark.sql import functions as F

from hirelake.plans.state import Lake
from hirelake.schema import RAW
from hirelake.sources import layers, raw
from hirelake.streaming.ingest import stream_bronze

OLD = "Job_ID,Role,Company,Location,Publish_Time,URL\n"
NEW = OLD.rstrip() + ",country,job_desc,salary,work_type\n"


@pytest.fixture
def folder(tmp_path):
    """Look-alikes of collected files: old and new columns, both formats, a
    second day, an upper-case extension and a name without a date."""
    d = tmp_path / "Source_Data_Board_X"
    d.mkdir()
    (d / "board_A_x_20250718_201025.csv").write_text(
        OLD + '0085,"Data ""Big"" Engineer",,"City, A",2025-07-18 07:01:56,u/85\n'
    )
    (d / "board_B_x_20250718_201026.csv").write_text(
        NEW + '86,ETL,PT B,City,bad,u/86,x,"line one\nline two",,\n'
        + "0085,ETL,PT B,City,2025-07-18 07:00:00,u/85,x,d,,\n" * 2
        + "0085,ETL,PT B,City,2025-07-18 06:00:00,u/85,x,d,,\n"
    )
    (d / "board_C_x_20250719_201026.csv").write_text(OLD + "87,ETL,NA,City,2025-07-19 07:01:56,u/87\n")
    (d / "board_D_x_20250717_201026.CSV").write_text(OLD + "88,ETL,PT,City,2025-07-17 07:01:56,u/88\n")
    (d / "board_nodate.csv").write_text(OLD + "89,ETL,PT,City,2025-07-17 07:01:56,u/89\n")
    (d / "board_E_x_20250720_201026.csv").write_text(OLD)
    row = {"Job_ID": "0085", "Role": "ETL", "Company": None, "Publish_Time": None, "salary": ""}
    (d / "board_A_x_20250718_201025.json").write_text(json.dumps(row) + "\n")
    return str(d)


def by_id(df):
    return {(r.Job_ID, r.Role): r for r in df.collect()}


def test_csv(spark, folder):
    rows = by_id(raw.read_raw(spark, folder, "CSV"))
    assert len(rows) == 5
    first = rows["0085", 'Data "Big" Engineer']
    assert (first.Company, first.Location, first.country, first.source) == (None, "City, A", None, "board_x")
    assert rows["86", "ETL"].job_desc == "line one\nline two" and rows["86", "ETL"].salary is None
    assert rows["87", "ETL"].Company == "NA"
    assert rows["89", "ETL"].table_date is None


def test_json_keeps_empty_text(spark, folder):
    (row,) = raw.read_raw(spark, folder, "jsonl").collect()
    assert (row.Job_ID, row.Company, row.salary, row.URL) == ("0085", None, "", None)


def test_extension_case(spark, folder):
    assert ("88", "ETL") not in by_id(raw.read_raw(spark, folder))
    assert ("88", "ETL") in by_id(raw.read_raw(spark, folder, any_case=True))


def test_one_day(spark, folder):
    listed = raw.read_raw(spark, folder, table_date="2025-07-18")
    filtered = raw.files_for_date(raw.read_raw(spark, folder), "2025-07-18")
    assert listed.count() == filtered.count() == 5


def test_stamp_of_the_file_goes_before_its_folder(spark, tmp_path):
    """The first stamp in the name counts; its run folder's only if there is none.
    Other folders are not looked into."""
    d = tmp_path / "run=b_20250101_000000"
    for folder in (d, tmp_path / "archive"):
        folder.mkdir()
        (folder / "part-0.csv").write_text(OLD + "part-0,r,,,,\n")
    for name in ("a_20250102_000000_20250103_000000", "b_20259999_000000"):
        (tmp_path / f"{name}.csv").write_text(OLD + f"{name},r,,,,\n")
    days = {r.Job_ID: str(r.table_date) for r in raw.read_raw(spark, str(tmp_path)).collect()}
    assert days == {
        "a_20250102_000000_20250103_000000": "2025-01-02", "part-0": "2025-01-01", "b_20259999_000000": "None",
    }
    for day, n in (("2025-01-01", 1), ("2025-01-02", 1), ("2025-01-03", 0)):
        assert raw.read_raw(spark, str(tmp_path), table_date=day).count() == n


def test_a_day_knows_only_its_files(spark, folder):
    names = [f.split("/")[-1] for f in raw.read_raw(spark, folder, table_date="2025-07-18").inputFiles()]
    assert {n for n in names if n.startswith("board")} == {
        "board_A_x_20250718_201025.csv", "board_B_x_20250718_201026.csv",
    }


def test_columns_far_right_are_read(spark, tmp_path):
    names = [f"x{i}" for i in range(60)]
    (tmp_path / "a_20250718_201025.csv").write_text(",".join([*names, "Role", "Job_ID"]) + "\n" + "v," * 60 + "r,1\n")
    (tmp_path / "b_20250718_201025.csv").write_text("Job_ID,Role\n2,s\n")
    rows = {r.Job_ID: r.Role for r in raw.read_raw(spark, str(tmp_path)).collect()}
    assert rows == {"1": "r", "2": "s"}


def test_columns_go_by_the_files_header(spark, tmp_path):
    (tmp_path / "a_20250718_201025.csv").write_text("URL,Job_ID,Other,Role\nu/1,1,x,r\n")
    (tmp_path / "b_20250718_201025.csv").write_text('"Job_ID",Role\n2,"Job_ID, of all"\n')
    rows = by_id(raw.read_raw(spark, str(tmp_path)))
    assert rows["1", "r"].URL == "u/1" and rows["1", "r"].Company is None
    assert rows["2", "Job_ID, of all"].URL is None
    (tmp_path / "c_20250719_201025.csv").write_text("id,title\n3,r\n")
    with pytest.raises(Exception, match="no header with a field Job_ID"):
        raw.read_raw(spark, str(tmp_path)).collect()


def test_no_files_for_the_day(spark, folder):
    assert raw.read_raw(spark, folder, table_date="2025-07-20").count() == 0  # a header only
    with pytest.raises(ValueError, match="No csv files found for date 2025-07-17"):
        raw.read_raw(spark, folder, table_date="2025-07-17")
    with pytest.raises(ValueError, match="No json files found for date 2025-07-19"):
        raw.read_raw(spark, folder, "json", table_date="2025-07-19")


def test_source_names():
    assert raw.source_name("/a/Source_Data_Board_X/") == "board_x"
    assert [raw.source_type(x) for x in ("CSV", "csv", "json", "x")] == ["csv", "csv", "json", "json"]


def test_concat_by_name(spark):
    a = spark.createDataFrame([("1", "r")], "Job_ID string, Role string")
    b = spark.createDataFrame([("u", "2")], "URL string, Job_ID string")
    assert sorted(tuple(r) for r in raw.concat_raw(a, b).collect()) == [("1", "r", None), ("2", None, "u")]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_round_trip(spark, tmp_path, fmt):
    values = [(" a ", 'q"x', "l1\nl2", "c,d", "2025-07-18 00:00:00", "u\\", None, "é–", " ", "w")]
    df = spark.createDataFrame(values, RAW).withColumn("run", F.lit("b_T_x_20250718_000000"))
    raw.write_raw(df, str(tmp_path), [fmt])
    assert [tuple(r) for r in raw.read_raw(spark, str(tmp_path), fmt).select(RAW.fieldNames()).collect()] == values


def test_staging(spark, folder, tmp_path):
    """Repeats go, the earliest time stays, text that is no time becomes null;
    staging a day again replaces that day alone."""
    path = str(tmp_path / "staging")
    for day in ("2025-07-18", "2025-07-19", "2025-07-18"):
        layers.write_staging(layers.stage(raw.read_raw(spark, folder, table_date=day)), path)
    rows = by_id(layers.read_staging(spark, path, "board_x", "2025-07-18"))
    assert len(rows) == 3
    assert (rows["0085", "ETL"].Publish_Time, rows["0085", "ETL"].copies) == ("2025-07-18 06:00:00", 3)
    assert rows["86", "ETL"].Publish_Time is None
    assert layers.read_staging(spark, path).count() == 4


def test_load_type_is_checked(spark, folder, tmp_path):
    with pytest.raises(ValueError):
        layers.load_bronze(raw.read_raw(spark, folder), str(tmp_path), "replace")


@pytest.fixture
def bronze(tmp_path):
    return Lake(str(tmp_path / "lake")).bronze


def test_stream_takes_each_file_once(spark, folder, bronze, tmp_path):
    checkpoint = str(tmp_path / "c")

    def run():
        stream_bronze(spark, folder, bronze, checkpoint).awaitTermination()
        return bronze.read(spark).count()

    assert run() == run() == 7
    with open(f"{folder}/board_F_x_20250721_201026.csv", "w") as f:
        f.write("URL,Extra,Job_ID,Role\nu/90,x,90,ETL\n")
    assert run() == 8
    row = bronze.read(spark).where("Job_ID = '90'").first()
    assert (row.URL, row.Role, row.Company, str(row.table_date), row.source) == ("u/90", "ETL", None, "2025-07-21", "board_x")


def test_stream_above_a_mark(spark, folder, bronze, tmp_path):
    stream_bronze(spark, folder, bronze, str(tmp_path / "c"), mark="2025-07-18 07:01:56").awaitTermination()
    assert [r.Job_ID for r in bronze.read(spark).collect()] == ["87"]


def test_stream_of_json_and_odd_names(spark, folder, bronze, tmp_path):
    with open(f"{folder}/board [1]{{x}} é_20250722_201026.json", "w") as f:
        f.write(json.dumps({"URL": "u", "Job_ID": "91"}) + "\n")
    stream_bronze(spark, folder, bronze, str(tmp_path / "c"), "json").awaitTermination()
    assert sorted(r.Job_ID for r in bronze.read(spark).collect()) == ["0085", "91"]


def test_archive_folders_are_not_streamed(spark, folder, bronze, tmp_path):
    for name in ("archive", "run=b_20250723_201026"):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/part-0.csv", "w") as f:
            f.write(OLD + f"{name},ETL,PT,City,2025-07-21 07:01:56,u\n")
    stream_bronze(spark, folder, bronze, str(tmp_path / "c")).awaitTermination()
    found = {r.Job_ID for r in bronze.read(spark).collect()}
    assert "run=b_20250723_201026" in found and "archive" not in found


def test_a_batch_that_runs_again_adds_nothing(spark, folder, bronze, tmp_path):
    """The checkpoint's last commit is lost, so the stream runs its batch again."""
    checkpoint = tmp_path / "c"
    stream_bronze(spark, folder, bronze, str(checkpoint)).awaitTermination()
    for f in (checkpoint / "commits").iterdir():
        f.unlink()
    stream_bronze(spark, folder, bronze, str(checkpoint)).awaitTermination()
    assert bronze.read(spark).count() == 7
    stream_bronze(spark, folder, bronze, str(tmp_path / "other")).awaitTermination()
    assert bronze.read(spark).count() == 14  # another checkpoint is another stream
