"""Raw files to bronze as a stream."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelake.functions.times import parse_time_lenient, render_time
from hirelake.operators.incremental import newer_than
from hirelake.sources.logged import LoggedTable
from hirelake.sources.raw import raw_paths, read_files, reader_options, source_name

_FILE = "path string, modificationTime timestamp, length long, content binary"


def _literal(path: str) -> str:
    """A path as a glob that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def stream_bronze(
    spark: SparkSession,
    folder: str,
    table: LoggedTable,
    checkpoint: str,
    fmt: str = "csv",
    source: str | None = None,
    mark: str | None = None,
    files_per_batch: int = 1000,
    multi_line: bool = True,
    any_case: bool = False,
) -> StreamingQuery:
    """Add every raw file of the folder (and its ``run=`` folders) that has not been seen
    before to bronze, then stop.

    The stream is one of file names; their contents are not read for it. Each
    micro-batch reads its files as :func:`read_files` does, so CSV columns go by each
    file's own header. It is appended under a tag of stream and batch: a batch that
    runs again after a crash finds its tag and adds nothing, so each file's rows are
    there exactly once. A stream with a new checkpoint is a new one and starts over.

    The table may have other writers before and after, such as daily loads, but not
    during the stream. ``mark`` drops postings not newer than it.
    """
    files = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", files_per_batch)
    files = files.option("pathGlobFilter", reader_options(fmt, multi_line, any_case)["pathGlobFilter"])
    names = files.load(raw_paths(folder, fmt, any_case=any_case)).select("path")
    of = source or source_name(folder)

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.read.json(f"{checkpoint}/metadata").first()["id"]  # stays the same when restarted
        tag = f"{stream}/{number}"
        # files_per_batch at most; Spark lists a file twice next to names that look like globs
        paths = [_literal(p) for p in sorted({r["path"] for r in batch.collect()})]
        if not paths or table.has_tag(session, tag):
            return
        rows = read_files(session, paths, fmt, of, None, multi_line, any_case)
        timed = rows.withColumn("Publish_Time", render_time(parse_time_lenient(F.col("Publish_Time"))))
        table.append(newer_than(timed, mark), tag)

    return names.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
