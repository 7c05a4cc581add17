"""Raw files: CSV and JSON lines, one set per search term, country and run."""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.scratch import materialise
from hirelake.schema import RAW

# How a raw folder's name begins; the run's date and time in a raw
# file's name.
FOLDER_PREFIX = "Source_Data_"
RUN_STAMP = r"_(\d{8})_\d{6}"

_OPTIONS = {
    "csv": {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    },
    "json": {"ignoreNullFields": False},
}
_ANY_CASE = {"csv": "*.[cC][sS][vV]", "json": "*.[jJ][sS][oO][nN]"}
# Written with gzip at its fastest: a tenth of the bytes or less. A file is read by one
# task either way when its fields may hold line breaks.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _file_globs(kind: str, any_case: bool) -> list[str]:
    """The names of raw files, plain and compressed."""
    plain = _ANY_CASE[kind] if any_case else f"*.{kind}"
    return [plain, f"{plain}.gz"]


def source_type(name: str) -> str:
    """``csv`` in any case is CSV, anything else JSON lines."""
    return "csv" if name.lower() == "csv" else "json"


def source_name(folder: str) -> str:
    """Folder ``Source_Data_X`` holds source ``x``."""
    return folder.rstrip("/").split("/")[-1].replace(FOLDER_PREFIX, "").lower()


def reader_options(fmt: str, multi_line: bool = True, any_case: bool = False) -> dict:
    """Options to read raw files, for batch and stream alike.

    ``multi_line`` lets quoted CSV fields hold newlines, at the price of one task
    per file; switch it off for large files without them. JSON lines split
    anyway. File extensions are matched in lower case unless ``any_case``; files may be
    compressed (``.csv.gz``).
    """
    kind = source_type(fmt)
    options = {"pathGlobFilter": f"{{{','.join(_file_globs(kind, any_case))}}}"}
    if kind == "csv":
        options |= _OPTIONS["csv"] | {"multiLine": multi_line}
    return options


def raw_paths(folder: str, fmt: str, table_date: str | None = None, any_case: bool = False) -> str:
    """Glob of the raw files in a folder and of its ``run=`` folders (no other
    folders are looked into); with a day only those whose name has that day, so
    history is not listed."""
    files = _file_globs(source_type(fmt), any_case)
    if table_date is None:
        return f"{folder.rstrip('/')}/{{{','.join(files)},run=*}}"
    stamp = f"*_{table_date.replace('-', '')}_[0-9]"
    named = [f"{stamp}{f}" for f in files] + [f"run={stamp}*/{f}" for f in files]
    return f"{folder.rstrip('/')}/{{{','.join(named)}}}"


def _in_path(place: int) -> Column:
    """The current file's name (-1), its folder's (-2) and so on. Patterns over the whole
    path, tried at each of its places for every row, cost more than reading the row."""
    return F.substring_index(F.substring_index("_metadata.file_path", "/", place), "/", 1)


def _stamp() -> Column:
    """The first stamp of the file's name or, when it has none because Spark named the
    file, of its folder's."""
    own, folders = (F.regexp_extract(_in_path(i), RUN_STAMP, 1) for i in (-1, -2))
    return F.when(own != "", own).otherwise(folders)


def run_date() -> Column:
    """The date in the current file's name or folder, null when there is none."""
    day = _stamp()
    return F.concat_ws("-", day.substr(1, 4), day.substr(5, 2), day.substr(7, 2)).try_cast("date")


def _source_in_path() -> Column:
    """By the file's folder, its run's folder left out."""
    folder = F.when(_in_path(-2).startswith("run="), _in_path(-3)).otherwise(_in_path(-2))
    return F.lower(F.replace(folder, F.lit(FOLDER_PREFIX), F.lit("")))


def _headers(spark: SparkSession, paths: list[str], options: dict) -> DataFrame:
    """(``_file``, ``_names``, ``_at``) of every CSV file: the line of its first block
    that has a field ``Job_ID`` and the most of the ten names, and the places of the
    ten (0: none). One row per file, written, so that Catalyst knows its size."""
    keep = {k: v for k, v in options.items() if k == "pathGlobFilter"}
    lines = spark.read.options(**keep).text(paths).where(F.col("value").contains("Job_ID"))
    plain = F.regexp_replace("value", "[\"\uFEFF]", "")
    named = lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.transform(F.split(plain, ","), lambda n: F.trim(n)).alias("_names"),
    ).where(F.array_contains("_names", "Job_ID"))
    known = -F.size(F.array_intersect("_names", F.lit(RAW.fieldNames())))
    first = named.groupBy("_file").agg(F.min(F.struct("_block", known.alias("_known"), "_names")).alias("_h"))
    at = F.array(*[F.array_position("_h._names", c).cast("int") for c in RAW.fieldNames()])
    return materialise(first.select("_file", F.col("_h._names").alias("_names"), at.alias("_at")), "headers")


def _by_header(headers: DataFrame, n_files: int) -> T.StructType | None:
    """The columns in file order if all files have one and the same header: columns
    that are not known, or named again, under a name of their place."""
    found = headers.agg(F.count_distinct("_names"), F.count(F.lit(1)), F.first("_names")).first()
    if found[0] != 1 or found[1] != n_files:
        return None
    names = list(found[2])
    plain = [n if n in RAW.fieldNames() and names.index(n) == i else f"_{i}" for i, n in enumerate(names)]
    return T.StructType([T.StructField(n, T.StringType()) for n in plain])


def _named(files: DataFrame, headers: DataFrame, n_places: int) -> DataFrame:
    """The ten raw columns of CSV rows read by place."""
    missing = F.raise_error(F.concat(F.lit("no header with a field Job_ID in "), F.col("_path")))
    joined = (
        files.withColumn("_places", F.array(*[f"_{i}" for i in range(n_places)]))
        .join(headers.select("_file", "_at"), F.col("_path") == F.col("_file"), "left")
        .where(F.when(F.col("_at").isNull(), missing.cast("boolean")).otherwise(True))
    )
    columns = [F.get("_places", F.get("_at", F.lit(i)) - 1).alias(c) for i, c in enumerate(RAW.fieldNames())]
    return joined.select(*columns, "source", "table_date")


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    source: str | None = None,
    table_date: str | None = None,
    multi_line: bool = True,
    any_case: bool = False,
) -> DataFrame:
    """Raw files in one folder or several, with the ten raw columns, ``source``
    (from the folder's name) and ``table_date``; only the files of one day when
    ``table_date`` is given, an error when a folder has none.

    Columns are matched by name: in CSV by each file's own header, whatever its
    order. Columns that a file lacks are null, unknown ones are left out, a file
    without a header is an error. Nothing is inferred, so ids keep their leading
    zeros. All folders are one scan.
    """
    folders = [path] if isinstance(path, str) else list(path)
    paths = [raw_paths(f, fmt, table_date, any_case) for f in folders]
    try:
        return read_files(spark, paths, fmt, source, table_date, multi_line, any_case)
    except AnalysisException as e:
        if table_date is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"No {source_type(fmt)} files found for date {table_date}") from None


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "csv",
    source: str | None = None,
    table_date: str | None = None,
    multi_line: bool = True,
    any_case: bool = False,
) -> DataFrame:
    """As :func:`read_raw`, from the files that globs name."""
    kind, paths = source_type(fmt), list(paths)
    options = reader_options(fmt, multi_line, any_case)

    def scan(schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).options(**options).format(kind).load(paths)

    def placed(files: DataFrame, columns: Sequence[str]) -> DataFrame:
        if table_date is not None:
            files = files.where(_stamp() == table_date.replace("-", ""))
        day = run_date() if table_date is None else F.lit(table_date).cast("date")
        return files.select(
            *columns,
            F.col("_metadata.file_path").alias("_path"),
            (F.lit(source) if source else _source_in_path()).alias("source"),
            day.alias("table_date"),
        )

    if kind == "json":
        return placed(scan(RAW), RAW.fieldNames()).drop("_path")
    headers = _headers(spark, paths, options)
    same = _by_header(headers, len(scan(RAW).inputFiles()))
    if same is not None:
        columns = [F.col(c) if c in same.fieldNames() else F.lit(None).cast("string").alias(c) for c in RAW.fieldNames()]
        return placed(scan(same), columns).drop("_path")
    # Read by place: Spark keeps only as many fields of a line as it is told of.
    n_places = headers.agg(F.max(F.size("_names"))).first()[0] or 1
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(n_places)])
    return _named(placed(scan(schema), schema.fieldNames()), headers, n_places)


def files_for_date(df: DataFrame, table_date: str) -> DataFrame:
    """Only the rows from files of one day, out of a frame of many; files without
    a date in their name are left out."""
    return df.where(F.col("table_date") == F.lit(table_date).cast("date"))


def concat_raw(*frames: DataFrame) -> DataFrame:
    """All rows, matched by column name; a column that a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_name(site: str, term: Column, country: Column, stamp: str) -> Column:
    """``<site>_<TermWithoutSpaces>_<country>_<yyyyMMdd_HHmmss>``."""
    return F.concat_ws("_", F.lit(site), F.replace(term, F.lit(" "), F.lit("")), country, F.lit(stamp))


def write_raw(
    df: DataFrame,
    path: str,
    formats: Sequence[str] = ("csv", "json"),
    run: str = "run",
    gather: bool = True,
) -> None:
    """Add postings to the raw zone in each format, as compressed files in one folder per
    ``run`` value (see :func:`run_name`); a run without rows leaves no file.

    The rebalance gives each run few files and splits a run that holds most
    rows. Without ``gather`` rows are written where they are, in a file for each task and
    run: for rows of few runs that lie in tasks of a file's size, it spares the shuffle
    of all of them. With several formats the rows are computed once.
    """
    balanced = df.hint("rebalance", run) if gather else df
    if len(formats) > 1:
        balanced = materialise(balanced, "raw")
    for fmt in formats:
        kind = source_type(fmt)
        writer = balanced.write.mode("append").partitionBy(run).options(**_OPTIONS[kind], **_PACKED)
        writer.format(kind).save(path)
