"""Mixing sources to target weights: random keys, range sort, prefix sums, cut.

Each document gets a hash-random key. The rows are range-partitioned and sorted
by source and key, so a hot source spreads over many partitions; prefix sums of
sizes are taken within each slice and shifted by one row per slice and source.
A source's budget is then cut exactly: whole epochs, then documents in key order
up to the remainder. Only Spark expressions are used.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.keys import dense_id
from hirelake.scratch import materialise

_ROW_BITS = 33


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most_epochs: float
) -> DataFrame:
    """From (``source``, ``source_size``): ``target`` of each source.

    Sources in code point order (null last) weigh ``weights``, repeating, and
    share ``share`` times all sizes. What exceeds ``most_epochs`` times a source's
    size is shared anew by weight until none is above. Each round is an
    aggregation over one row per source; rounds end when no source is added to
    the full ones.
    """
    numbered = dense_id(sizes, [F.asc_nulls_last("source")], "_nth")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_nth") - 1) % len(weights)).cast("int"))
    table = materialise(
        numbered.select(
            "source", "source_size", weight.alias("weight"),
            (F.col("source_size") * float(most_epochs)).alias("most"),
        ),
        "sources",
    )
    total = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # words per unit of weight; sources above it are full
        is_full = F.col("most") <= F.lit(level) * F.col("weight") if full >= 0 else F.lit(False)
        n, open_weight, taken = table.agg(
            F.count_if(is_full),
            F.sum(F.when(~is_full, F.col("weight"))),
            F.sum(F.when(is_full, F.col("most"))),
        ).first()
        if n == full or not open_weight:
            break
        full, level = n, (total - (taken or 0.0)) / open_weight
    return table.select(
        "source", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most_epochs: float = 2,
    seed: int = 17,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``epochs``,
    ``cut``, ``taken``) for every row of ``docs``, and its columns ``keep``.

    ``epochs`` is the number of whole uses, ``cut`` the words of one more, partial
    use of the document at the budget's edge; ``taken = epochs * size + cut``, so
    a source's taken words are its target rounded down. The key is a hash of
    (seed, doc_id, size); equal keys are ordered by id, then size: repeated rows
    are interchangeable, and reruns agree. A null text has size 0, a null source
    is a source of its own (last in order), documents of size 0 are taken 0 words.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *keep)
    order = [F.asc_nulls_last("source"), "_key", F.asc_nulls_first("doc_id"), "size"]
    slices = materialise(
        rows.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "size"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_slot", _ROW_BITS)),
        "mix",
    )
    parts = slices.groupBy("source", "_slice").agg(F.sum("size").alias("_part"))
    targets = source_targets(
        parts.groupBy("source").agg(F.sum("_part").alias("source_size")), weights, share, most_epochs
    )
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("source").alias("_s"), F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_part").over(ahead), F.lit(0)).alias("_start"),
    ).join(targets.withColumnRenamed("source", "_of"), F.col("_s").eqNullSafe(F.col("_of"))).drop("_of")
    starts = materialise(starts, "mix-starts")
    inside = (
        Window.partitionBy("source", "_slice").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        slices.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, (F.col("_slice") == F.col("_at")) & F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_before", F.col("_start") + F.col("_inside"))
    )
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - whole * F.col("source_size") - F.col("_before")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    done = F.col("size") > 0
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        (whole + F.when(done & (last == F.col("size")), 1).otherwise(0)).alias("epochs"),
        F.when(done & (last < F.col("size")), last).otherwise(F.lit(0).cast("long")).alias("cut"),
        (whole * F.col("size") + last).alias("taken"), *keep,
    )
