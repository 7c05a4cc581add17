"""The lake's tables, kept up to date load by load instead of rebuilt from history.

Bronze has a partition for each source and day. Of every job the first posting is
kept in ``first``, in buckets by a hash of the job's id; a load compares its own
jobs with those of the same buckets, and rewrites only buckets in which a job is new or
has got an earlier posting. Silver's cleaned rows lie in the same buckets and follow.
Gold's word counts are sums of signed changes: a changed job takes back the words of
its old description and brings those of the new one.

``first`` decides: every other table's commit is tagged with the commit of ``first`` it
follows. A run that died between two of them is noticed by the missing tag, and what
lacks it is made anew from ``first``.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import vocab
from hirelake.functions.text import clean_text
from hirelake.operators.incremental import check_load_type
from hirelake.operators.keys import dense_id
from hirelake.operators.words import job_words, top_rows, without_stop_words
from hirelake.plans.silver import FIRST_BY, cleaned, first_postings, require_fields
from hirelake.schema import BRONZE, RAW, SILVER
from hirelake.scratch import materialise
from hirelake.sources.logged import Check, LoggedTable

_SOURCE = T.StructField("source", T.StringType())
_BUCKET = T.StructField("bucket", T.IntegerType())
_RAW_ID = T.StructField("raw_id", T.StringType())
_NO_ID = [f for f in SILVER.fields if f.name != "job_id"]


@dataclass(frozen=True)
class Lake:
    """The tables below ``root``. ``buckets`` is fixed once there is data: choose it so
    that a bucket of a source's jobs is a few hundred megabytes."""

    root: str
    buckets: int = 16

    def _table(
        self, name: str, fields: Sequence[T.StructField], keys: tuple[str, ...], mark: str | None = None, gather: bool = True
    ) -> LoggedTable:
        return LoggedTable(f"{self.root}/{name}", T.StructType(list(fields)), keys, mark, gather)

    @property
    def bronze(self) -> LoggedTable:
        """A load brings one day or a few files: few partitions."""
        return self._table("bronze", BRONZE.fields, ("source", "table_date"), "Publish_Time", gather=False)

    @property
    def first(self) -> LoggedTable:
        return self._table("first", [*RAW.fields, _SOURCE, _BUCKET], ("source", "bucket"))

    @property
    def silver(self) -> LoggedTable:
        """Made from files of ``first``, which hold one bucket each."""
        return self._table("silver", [*_NO_ID, _RAW_ID, _SOURCE, _BUCKET], ("source", "bucket"), gather=False)

    @property
    def numbers(self) -> LoggedTable:
        return self._table("numbers", [_RAW_ID, T.StructField("job_id", T.LongType()), _SOURCE], ("source",))

    @property
    def counts(self) -> LoggedTable:
        word, n = T.StructField("word", T.StringType()), T.StructField("n", T.LongType())
        return self._table("counts", [word, n, _SOURCE], ("source",))

    def bucket(self, job: str = "Job_ID") -> Column:
        return F.pmod(F.xxhash64(job), F.lit(self.buckets)).cast("int")


def _of(sources: Sequence[str] | None) -> Column | None:
    return None if sources is None else F.col("source").isin(list(sources))


def _in(buckets: Sequence[tuple[str, int]]) -> Column:
    """Whether a row's source and bucket are among these."""
    return F.concat_ws("/", F.col("bucket").cast("string"), "source").isin([f"{b}/{s}" for s, b in buckets])


def _buckets(rows: DataFrame) -> list[tuple[str, int]]:
    """The different sources and buckets: as many rows as the lake has partitions at most."""
    return sorted((r["source"], r["bucket"]) for r in rows.select("source", "bucket").distinct().collect())


def load_day(spark: SparkSession, lake: Lake, staged: DataFrame, sources: Sequence[str], table_date: str, load_type: str) -> int | None:
    """Staged rows of a day to bronze, then to ``first``. A day loaded again replaces
    itself; a full load replaces all days of the sources. ``first``'s commit, None if
    nothing in it has changed."""
    rows = staged.select(*BRONZE.fieldNames())
    if check_load_type(load_type) == "full":
        lake.bronze.replace(rows, _of(sources))
        firsts = first_postings(lake.bronze.read(spark, _of(sources)), ["source"]).withColumn("bucket", lake.bucket())
        return lake.first.replace(firsts, _of(sources))
    today = _of(sources) & (F.col("table_date") == F.lit(table_date).cast("date"))
    before = lake.bronze.last_commit(spark)
    lake.bronze.replace(rows, today)
    day = lake.bronze.read(spark, today)
    if not lake.bronze.live(spark, today, before).isEmpty():  # the day has been loaded before
        earlier = lake.bronze.read(spark, today, before)
        lost = _buckets(_digests(lake, earlier).exceptAll(_digests(lake, day)))
        if lost:  # with rows that it does not have now
            return _rebuild(spark, lake, lost, day)
    return _merge(spark, lake, day)


def _digests(lake: Lake, rows: DataFrame) -> DataFrame:
    """A digest of each row next to its source and bucket: what tells rows apart is
    shuffled, not their texts. Every value goes with its length, so none runs into the next."""
    values = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in RAW.fieldNames()]
    return rows.select("source", lake.bucket().alias("bucket"), F.unhex(F.sha2(F.concat(*values), 256)).alias("_digest"))


def _merge(spark: SparkSession, lake: Lake, day: DataFrame) -> int | None:
    """A load's jobs into ``first``: only buckets of the load are read, only those with
    a new or an earlier posting are written."""
    mine = first_postings(day.drop("table_date"), ["source"]).withColumn("bucket", lake.bucket())
    ids = require_fields(day).select("source", lake.bucket().alias("bucket"))
    known = lake.first.read(spark, _in(_buckets(ids)))
    old = known.select("source", "Job_ID", F.struct(*FIRST_BY).alias("_old"))
    earlier = F.col("_old").isNull() | (F.struct(*FIRST_BY) < F.col("_old"))
    changed = mine.join(old, ["source", "Job_ID"], "left").where(earlier).select(*mine.columns)
    changed = materialise(changed, "changed")
    touched = _buckets(changed)
    if not touched:
        return None
    stay = lake.first.read(spark, _in(touched)).join(changed.select("source", "Job_ID"), ["source", "Job_ID"], "left_anti")
    return lake.first.replace(stay.unionByName(changed))


def _rebuild(spark: SparkSession, lake: Lake, buckets: Sequence[tuple[str, int]], day: DataFrame) -> int:
    """Buckets that lost postings, and those of a load, from all bronze of their sources."""
    mine = day.select("source", lake.bucket().alias("bucket"))
    wanted = sorted({*buckets, *_buckets(mine)})
    rows = lake.bronze.read(spark, _of(sorted({s for s, _ in wanted}))).withColumn("bucket", lake.bucket()).where(_in(wanted))
    return lake.first.replace(first_postings(rows, ["source", "bucket"]), _in(wanted))


def _tag(commit: int) -> str:
    return f"first-{commit}"


def _behind(spark: SparkSession, lake: Lake, table: LoggedTable) -> list[int]:
    """``first``'s commits that the table has not followed yet, in order."""
    commits = lake.first.log(spark).select("seq").distinct()
    done = table.log(spark).where(F.col("tag").isNotNull()).select(F.substring("tag", 7, 20).cast("long").alias("seq"))
    upto = done.agg(F.max("seq")).first()[0]
    return sorted(r["seq"] for r in commits.where(F.col("seq") > (-1 if upto is None else upto)).collect())


def follow(spark: SparkSession, lake: Lake, check: Check | None = None) -> None:
    """Bring silver, its numbers and the word counts up to ``first``. ``check`` sees
    silver's new rows before they are published; if it raises, all three stay."""
    _follow_silver(spark, lake, check)
    _follow_numbers(spark, lake)
    _follow_counts(spark, lake)


def _follow_silver(spark: SparkSession, lake: Lake, check: Check | None) -> None:
    commits = _behind(spark, lake, lake.silver)
    if not commits:
        return
    touched = _buckets(lake.first.log(spark).where(F.col("seq") >= commits[0]))
    rows = cleaned(lake.first.read(spark, _in(touched)), ["source", "bucket"])
    lake.silver.replace(rows, _in(touched), check, _tag(commits[-1]))


def _follow_numbers(spark: SparkSession, lake: Lake) -> None:
    """``job_id`` 1..N by source, by trimmed id as text, descending. Any new id shifts the
    numbers below it, so a changed source is numbered anew: its ids, nothing else."""
    commits = _behind(spark, lake, lake.numbers)
    if not commits:
        return
    sources = [r["source"] for r in lake.first.log(spark).where(F.col("seq") >= commits[0]).select("source").distinct().collect()]
    ids = lake.first.read(spark, _of(sources)).select("source", F.col("Job_ID").alias("raw_id"))
    order = [F.desc("_platform"), F.asc("raw_id")]
    numbered = dense_id(ids.withColumn("_platform", clean_text(F.col("raw_id"))), order, "job_id", ["source"])
    lake.numbers.replace(numbered, _of(sources), tag=_tag(commits[-1]))


def _word_counts(rows: DataFrame, sign: Column) -> DataFrame:
    words = job_words(rows.withColumn("_sign", sign), "Job_ID", "job_desc", ["source", "_sign"], unique_keys=True)
    return words.groupBy("source", "word").agg(F.sum("_sign").cast("long").alias("n")).where("n <> 0")


def _follow_counts(spark: SparkSession, lake: Lake) -> None:
    """Append the changes of each commit of ``first``: of the buckets it touched, jobs
    are compared by id and a hash of the description before and after it, and only the
    words of those that differ are counted."""
    for commit in _behind(spark, lake, lake.counts):
        touched = _in(_buckets(lake.first.log(spark).where(F.col("seq") == commit)))
        before, after = (lake.first.read(spark, touched, upto) for upto in (commit - 1, commit))

        def signed(rows: DataFrame, sign: int) -> DataFrame:
            return rows.select("source", "Job_ID", F.xxhash64("job_desc").alias("_desc"), F.lit(sign).alias("_sign"))

        moved = signed(after, 1).unionByName(signed(before, -1)).groupBy("source", "Job_ID", "_desc").agg(F.sum("_sign").alias("_sign"))
        moved = materialise(moved.where("_sign <> 0"), "moved")
        texts = []
        for rows, sign in ((after, 1), (before, -1)):
            own = moved.where(F.col("_sign") == sign).select("source", "Job_ID")
            texts.append(rows.join(own, ["source", "Job_ID"], "left_semi").select("source", "Job_ID", "job_desc", F.lit(sign).alias("_s")))
        changes = _word_counts(texts[0].unionByName(texts[1]), F.col("_s"))
        lake.counts.append(changes, _tag(commit))


def fold_counts(spark: SparkSession, lake: Lake, least_commits: int = 32) -> int | None:
    """Sum up the changes of sources that have ``least_commits`` or more of them."""
    many = lake.counts.live(spark).groupBy("source").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least_commits)
    sources = [r["source"] for r in many.select("source").collect()]
    if not sources:
        return None
    return lake.counts.replace(_summed(lake.counts.read(spark, _of(sources))), _of(sources))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source", "word").agg(F.sum("n").alias("n")).where("n <> 0")


def read_silver(spark: SparkSession, lake: Lake, sources: Sequence[str] | None = None) -> DataFrame:
    """The silver table with its dense keys; texts are not shuffled for them if the
    numbers are small enough to be broadcast."""
    rows = lake.silver.read(spark, _of(sources))
    return rows.join(lake.numbers.read(spark, _of(sources)), ["source", "raw_id"]).select(*SILVER.fieldNames(), "source")


def read_gold(spark: SparkSession, lake: Lake, sources: Sequence[str] | None = None, top: int = vocab.TOP_WORDS) -> DataFrame:
    """The ``top`` words of each source by number of jobs, from the maintained counts."""
    counts = without_stop_words(_summed(lake.counts.read(spark, _of(sources))), vocab.STOP_WORDS)
    ranked = top_rows(counts.withColumnRenamed("n", "frequency"), top, [F.desc("frequency"), F.asc("word")], ["source"])
    return ranked.select("word", "frequency", "source")
