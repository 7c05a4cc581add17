"""Duplicate removal."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.scratch import materialise


def _others(df: DataFrame, ignore: Sequence[str]) -> list[str]:
    skip = {c.lower() for c in ignore}
    return [c for c in df.columns if c.lower() not in skip]


def dedup_ignoring(df: DataFrame, ignore: str, copies: str | None = None) -> DataFrame:
    """One row per combination of all columns but ``ignore``; nulls are equal.

    The smallest non-null ``ignore`` value of the group is kept, so the survivor
    does not depend on file order. As a plain aggregation, copies collapse
    before the shuffle: a row copied a billion times sends one row per task.
    ``copies`` names an optional column with the number of rows folded into one.
    """
    keys = _others(df, [ignore])
    out = [F.min(ignore).alias(ignore)]
    if copies:
        out.append(F.count(F.lit(1)).alias(copies))
    return df.groupBy(*keys).agg(*out).select(*df.columns, *([copies] if copies else []))


def dedup_wide(df: DataFrame, ignore: str, copies: str, most: int = 1_000_000) -> DataFrame:
    """:func:`dedup_ignoring` for wide rows of which few are alike.

    The rows are written once with a hash of all columns but ``ignore``. Only hashes are
    shuffled to find those on several rows; a row alone with its hash is like no other and
    stays where it is, the others are compared by their values (different rows of
    one hash stay apart). With more than ``most`` such hashes, too many to be sent to
    all tasks, all rows are compared, where copies collapse before the shuffle.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*_others(df, [ignore])))
    rows = materialise(hashed, "rows", "zstd")
    per_hash = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    several = materialise(per_hash.where("_rows > 1").select("_hash"), "alike")
    found = several.count()  # from the files' footers
    if found > most:
        return dedup_ignoring(rows.drop("_hash"), ignore, copies)
    alone = rows if not found else rows.join(several, "_hash", "left_anti")
    alone = alone.select(*df.columns, F.lit(1).cast("long").alias(copies))
    if not found:
        return alone
    alike = rows.join(several, "_hash", "left_semi").drop("_hash")
    return alone.unionByName(dedup_ignoring(alike, ignore, copies))


def dedup_report(df: DataFrame, ignore: str) -> DataFrame:
    """Rows before, after and removed by :func:`dedup_ignoring`, as one row."""
    groups = df.groupBy(*_others(df, [ignore])).agg(F.count(F.lit(1)).alias("_copies"))
    return copies_report(groups, "_copies")


def copies_report(deduped: DataFrame, copies: str) -> DataFrame:
    """The same report out of the ``copies`` column of a deduplicated table.

    It reads one narrow column, and unlike counters updated inside tasks it
    stays exact when lost executors make Spark run tasks again.
    """
    before, after = F.coalesce(F.sum(copies), F.lit(0)), F.count(F.lit(1))
    return deduped.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in the given order; make the order total.

    Catalyst turns the rank filter into a group limit on both sides of the
    shuffle, so a hot key sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


_PLACE = "_place"
_BLOCK_BITS = 12  # places of a block, 64 words of 64 bits


def placed(df: DataFrame) -> DataFrame:
    """The rows written once, each with its place in what was written."""
    return materialise(df.withColumn(_PLACE, F.monotonically_increasing_id()), "rows", "zstd")


def first_placed(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], least: int = 1_000_000, most: int = 1 << 31
) -> DataFrame:
    """:func:`first_per_key` for wide rows written by :func:`placed`.

    Only keys, places and the first column of the order are shuffled to find the rows
    that come first or are level with it. A bit for each place, sent to all tasks, says
    which these are; they alone are shuffled whole, to be told apart by the rest of the
    order. Fewer than ``least`` rows are shuffled whole at once, and more than ``most``,
    whose bits would be too many for every task.
    """
    n = rows.count()  # from the files' footers
    if not least <= n <= most:
        return first_per_key(rows.drop(_PLACE), keys, order)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(order[0]))
    block, word = F.shiftright(_PLACE, _BLOCK_BITS), F.shiftright(_PLACE, 6).bitwiseAND(63)
    bit = F.col(_PLACE).bitwiseAND(63).cast("int")
    level = rows.withColumn("_rank", rank).where("_rank = 1").select(_PLACE, block.alias("_block"))
    words = (
        level.repartition("_block")
        .groupBy("_block", word.cast("int").alias("_word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({_PLACE} & 63 AS int))")).alias("_bits"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    )
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("long")))
    bits = materialise(words.select("_block", filled.alias("_words")), "places")
    asked = rows.withColumn("_block", block).join(F.broadcast(bits), "_block")
    found = asked.where(F.getbit(F.get("_words", word.cast("int")), bit) == 1)
    return first_per_key(found.select(*[c for c in rows.columns if c != _PLACE]), keys, order)
