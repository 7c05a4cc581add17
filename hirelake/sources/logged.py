"""Tables whose live files are named by a log.

A commit writes its rows to a folder of its own, looks at what it has written, and
only then adds one file to the log, which has a row for every partition it touches.
That file is the commit: before it readers see the table as it was, a job that dies
leaves rows that nobody reads, and a check that fails keeps the old table. Nothing is
overwritten in place.

A partition is one combination of the key columns' values. A ``replace`` commit puts
its rows in the place of all that its partitions held, an ``append`` commit adds to
them, once for each tag. So a load that runs again replaces itself, and a micro-batch
that runs again is known by its tag. The log also keeps each partition's number of
rows and largest value of one column, so these are read without the rows.

A table has one writer at a time. Readers choose folders by the log alone; what
reaches the driver is a row for each live partition asked for.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "_part"

#: Looks at a commit's rows as they were written; what it raises stops the commit.
Check = Callable[[DataFrame], None]


def _part_name(keys: Sequence[str]) -> Column:
    """A folder name of letters, digits and hyphens for a partition."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    whole = F.concat_ws("/", *text) if text else F.lit("all")
    shown = F.substring(F.regexp_replace(whole, "[^A-Za-z0-9]+", "-"), 1, 60)
    return F.concat(shown, F.lit("-"), F.substring(F.sha2(whole.cast("binary"), 256), 1, 16))


def _folder(keys: Sequence[str]) -> Column:
    """A folder name for a partition within its commit: two hashes of the keys. It is made
    for every row; :func:`_part_name`, whose digest takes longer than writing the row, for
    every partition."""
    values = [v for k in keys for v in (F.col(k).isNull(), F.col(k))]
    return F.concat(*[F.hex(F.xxhash64(F.lit(seed), *values)) for seed in (0, 1)])


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


@dataclass(frozen=True)
class LoggedTable:
    """A table at ``path`` with partitions by ``keys`` (columns of ``schema``, may be
    none); the log keeps the largest value of the text column ``mark``, if given.
    ``gather`` shuffles a commit's rows to their partitions before they are written; a
    table whose commits come in few partitions, or in files of one each, does without."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    mark: str | None = None
    gather: bool = True

    @property
    def _log_schema(self) -> T.StructType:
        # older commits have no folder: theirs is named as the partition
        plain = "seq long, load string, kind string, tag string, part string, folder string, rows long, mark string"
        named = T.StructType([f for f in self.schema if f.name in self.keys])
        return T.StructType([*T.StructType.fromDDL(plain).fields, *named.fields])

    def log(self, spark: SparkSession) -> DataFrame:
        """All commits, a row for each partition of each."""
        try:
            return spark.read.schema(self._log_schema).parquet(f"{self.path}/log")
        except AnalysisException as e:  # no commit yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return _empty(spark, self._log_schema)

    def live(self, spark: SparkSession, where: Column | None = None, upto: int | None = None) -> DataFrame:
        """The log's rows that make up the table now, or after commit ``upto``; ``where``
        is about the keys."""
        log = self.log(spark).where(F.col("part").isNotNull())
        log = log if upto is None else log.where(F.col("seq") <= upto)
        log = log if where is None else log.where(where)
        newest = F.max(F.when(F.col("kind") == "replace", F.col("seq"))).over(Window.partitionBy("part"))
        last = log.withColumn("_newest", F.coalesce(newest, F.lit(-1)))
        return last.where((F.col("seq") >= F.col("_newest")) & (F.col("rows") > 0)).drop("_newest")

    def read(self, spark: SparkSession, where: Column | None = None, upto: int | None = None) -> DataFrame:
        """The table as it is, or as it was after commit ``upto``; of its partitions those
        that ``where`` (about the keys) asks for: only their folders are read."""
        return self._folders(spark, [r["_at"] for r in self._placed(spark, where, upto).collect()])

    def _placed(self, spark: SparkSession, where: Column | None = None, upto: int | None = None) -> DataFrame:
        """The live partitions' names and folders (``part``, ``_at``)."""
        name = F.concat(F.lit(f"{_PART}="), F.coalesce("folder", "part"))
        at = F.concat_ws("/", F.lit(f"{self.path}/data"), F.concat(F.lit("load="), "load"), name)
        return self.live(spark, where, upto).select("part", at.alias("_at"))

    def _folders(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return _empty(spark, self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def maxima(self, spark: SparkSession, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """The largest ``mark`` (``max_mark``), overall or for groups of key columns, and
        the number of ``rows``: read from the log, never from the rows."""
        return self.live(spark, where).groupBy(*by).agg(F.max("mark").alias("max_mark"), F.sum("rows").alias("rows"))

    def last_commit(self, spark: SparkSession) -> int:
        """The newest commit's number, -1 without any."""
        return self.log(spark).agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0]

    def has_tag(self, spark: SparkSession, tag: str) -> bool:
        return not self.log(spark).where(F.col("tag") == tag).isEmpty()

    def replace(self, df: DataFrame, scope: Column | None = None, check: Check | None = None, tag: str | None = None) -> int:
        """Put ``df`` in the place of what its partitions hold, and of all other
        partitions that ``scope`` (about the keys) names. The commit's number."""
        return self._commit(df, "replace", tag, scope, check)

    def append(self, df: DataFrame, tag: str, check: Check | None = None) -> int | None:
        """Add ``df``, unless a commit with the same tag has done so: then None."""
        return None if self.has_tag(df.sparkSession, tag) else self._commit(df, "append", tag, None, check)

    def _commit(self, df: DataFrame, kind: str, tag: str | None, scope: Column | None, check: Check | None) -> int:
        spark, load = df.sparkSession, uuid4().hex
        target = f"{self.path}/data/load={load}"
        rows = df.select(*self.schema.fieldNames()).withColumn(_PART, _folder(self.keys))
        if self.gather:  # a partition's rows come together, in as many files as their size asks for
            rows = rows.hint("rebalance", _PART)
        rows.write.partitionBy(_PART).parquet(target)
        stored = T.StructType([*self.schema.fields, T.StructField(_PART, T.StringType())])
        written = spark.read.schema(stored).parquet(target)
        if check is not None:
            check(written.drop(_PART))
        largest = F.max(self.mark) if self.mark else F.lit(None).cast("string")
        entries = written.groupBy(F.col(_PART).alias("folder"), *self.keys).agg(F.count(F.lit(1)).alias("rows"), largest.alias("mark"))
        entries = entries.withColumn("part", _part_name(self.keys))
        if scope is not None:
            gone = self.live(spark, scope).select("part", *self.keys).distinct()
            gone = gone.join(entries.select("part"), "part", "left_anti")
            entries = entries.unionByName(gone.select("part", *self.keys, F.lit(0).cast("long").alias("rows"), F.lit(None).cast("string").alias("mark")), allowMissingColumns=True)
        seq = self.last_commit(spark) + 1
        if tag is not None:  # also where there are no rows
            entries = entries.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("rows")), allowMissingColumns=True)
        facts = {"seq": F.lit(seq).cast("long"), "load": F.lit(load), "kind": F.lit(kind), "tag": F.lit(tag).cast("string")}
        entries = entries.withColumns(facts).select(*self._log_schema.fieldNames())
        # one file, so the commit is there as a whole or not at all
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        if self.log(spark).where((F.col("seq") == seq) & (F.col("load") != load)).isEmpty():
            return seq
        raise RuntimeError(f"two writers have made commit {seq} of {self.path}")

    def file_counts(self, spark: SparkSession) -> DataFrame:
        """For each live partition its ``files`` and ``bytes``, from the files' own
        metadata: no column is read."""
        parts = {r["_at"]: r["part"] for r in self._placed(spark).collect()}
        if not parts:
            return _empty(spark, T.StructType.fromDDL("part string, files long, bytes long"))
        # a folder is told by its commit and its name, however its path is spelled
        named = [("/".join(at.split("/")[-2:]), part) for at, part in parts.items()]
        names = spark.createDataFrame(named, "_in string, part string")
        path = F.col("_metadata.file_path")
        files = spark.read.schema(self.schema).parquet(*parts).select(
            F.substring_index(F.substring_index(path, "/", -3), "/", 2).alias("_in"),
            path.alias("file"), F.col("_metadata.file_size").alias("size"),
        )
        found = files.distinct().groupBy("_in").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
        return found.join(names, "_in").groupBy("part").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))

    def compact(self, spark: SparkSession, least_files: int = 8, file_bytes: int = 128 << 20) -> int | None:
        """Rewrite the partitions that have ``least_files`` files or more, and more than
        twice the files that ``file_bytes`` each would make, as few files. Their rows stay
        the same. The commit's number, None if there is nothing to do."""
        counts = self.file_counts(spark)
        wanted = F.ceil(F.col("bytes") / file_bytes)
        many = counts.where((F.col("files") >= least_files) & (F.col("files") > 2 * wanted))
        names = [r["part"] for r in many.select("part").collect()]
        return replace(self, gather=True).replace(self.read(spark, F.col("part").isin(names))) if names else None
