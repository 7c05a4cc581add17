"""Word counts over job descriptions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.functions.text import distinct_words


def job_words(
    df: DataFrame, key: str, text: str, keep: Sequence[str] = (), unique_keys: bool = False
) -> DataFrame:
    """One row per job and distinct word: ``keep`` columns, ``key``, ``word``.

    The words of one text are made distinct in the row, before they are
    exploded. ``unique_keys=True`` says that no two texts share a key; otherwise a
    shuffle makes (key, word) distinct.
    """
    rows = (
        df.where(F.col(key).isNotNull())
        .select(*keep, key, F.explode(distinct_words(F.col(text))).alias("word"))
        .where("word <> ''")
    )
    return rows if unique_keys else rows.distinct()


def without_stop_words(words: DataFrame, stop_words: Sequence[str] | DataFrame) -> DataFrame:
    """Drop stop words: a list becomes one hash lookup per row, a table (column
    ``word``) an anti join."""
    if isinstance(stop_words, DataFrame):
        return words.join(stop_words, "word", "left_anti")
    return words.where(~F.col("word").isin(sorted(set(stop_words))))


def top_rows(df: DataFrame, n: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in ``order``, per ``by`` group when given."""
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def word_frequency(
    df: DataFrame,
    key: str = "job_id",
    text: str = "job_desc",
    stop_words: Sequence[str] | DataFrame = vocab.STOP_WORDS,
    top: int = vocab.TOP_WORDS,
    by: Sequence[str] = (),
    unique_keys: bool = False,
) -> DataFrame:
    """The ``top`` words by number of jobs that use them, ties in word order.

    With unique keys this is one shuffle of partial counts. A list of stop words
    is looked up before counting, a table joined after it, when there is one row
    for each word.
    """
    words = job_words(df, key, text, by, unique_keys)
    listed = not isinstance(stop_words, DataFrame)
    counted = without_stop_words(words, stop_words) if listed else words
    counts = counted.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("frequency"))
    counts = counts if listed else without_stop_words(counts, stop_words)
    return top_rows(counts, top, [F.desc("frequency"), F.asc("word")], by)


def word_frequency_semi_join(
    df: DataFrame,
    key: str = "job_id",
    text: str = "job_desc",
    stop_words: Sequence[str] | DataFrame = vocab.STOP_WORDS,
    top: int = vocab.TOP_WORDS,
    unique_keys: bool = False,
) -> DataFrame:
    """The same table with the kept words as a semi join.

    Counting comes before the join: it then meets one row per word instead of one
    per job and word, so no word is hot. Both sides are the same counts, joined
    on all their columns, so Spark reads and counts the texts once and reuses the
    exchange.
    """
    words = job_words(df, key, text, (), unique_keys)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    kept = counts.join(without_stop_words(counts, stop_words), counts.columns, "left_semi")
    return top_rows(kept, top, [F.desc("frequency"), F.asc("word")])


def keyword_trend(
    silver: DataFrame,
    unit: str = "month",
    top: int = 10,
    key: str = "job_id_platform",
    stop_words: Sequence[str] | DataFrame = vocab.STOP_WORDS,
    unique_keys: bool = False,
) -> DataFrame:
    """The ``top`` words of each period: ``period``, ``word``, ``frequency``,
    ``place``. Only the counts are ranked, never the postings."""
    dated = silver.withColumn("period", F.date_trunc(unit, "posted_time").cast("timestamp_ntz"))
    words = without_stop_words(job_words(dated, key, "job_desc", ["period"], unique_keys), stop_words)
    counts = words.groupBy("period", "word").agg(F.count(F.lit(1)).alias("frequency"))
    order = Window.partitionBy("period").orderBy(F.desc("frequency"), F.asc("word"))
    ranked = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    return ranked.withColumn("place", F.col("place").cast("long"))
