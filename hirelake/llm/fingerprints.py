"""Document fingerprints: threshold-scaled sketches of word shingles.

The sketch of a text keeps every shingle hash below a fixed fraction of the hash
range. Sketches therefore grow with their texts, the union's sketch is the union
of sketches, and the share of a short text's hashes found in a long one estimates
containment however unequal the two are. Texts with fewer than ``least`` hashes
below the fraction keep their ``least`` smallest hashes, so short texts are
compared exactly; such a sketch is whole up to its own largest hash.

Only Spark expressions are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.keys import dense_id

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
_RANGE = 2.0**64
_LEAST_LONG = -(2**63)


def shingle_hashes(text: Column, k: int = 5) -> Column:
    """64-bit hashes of the k-word shingles of a text (null: empty), words
    lower-cased; a shorter text counts as one shingle, an empty one has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(
        F.array(hashed),
        lambda h: F.when(
            F.size(h) >= k,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]),
            ),
        )
        .when(F.size(h) > 0, F.array(F.xxhash64(h)))
        .otherwise(F.array().cast("array<bigint>")),
    )[0]


def sketch(text: Column, k: int = 5, fraction: float = 1 / 16, least: int = 64) -> Column:
    """Sorted distinct hashes below the fraction, or the ``least`` smallest."""
    limit = F.lit(int(_LEAST_LONG + fraction * _RANGE))
    return F.transform(
        F.array(shingle_hashes(text, k)),
        lambda all_: F.transform(
            F.array(F.array_distinct(F.filter(all_, lambda x: x < limit))),
            lambda low: F.when(F.size(low) >= least, F.sort_array(low)).otherwise(
                F.slice(F.sort_array(F.array_distinct(all_)), 1, least)
            ),
        )[0],
    )[0]


def whole_below(s: Column, fraction: float = 1 / 16, least: int = 64) -> Column:
    """The bound below which a sketch holds every hash of its text."""
    limit = F.lit(int(_LEAST_LONG + fraction * _RANGE))
    return F.when(F.size(s) < least, F.lit(2**63 - 1)).otherwise(
        F.greatest(limit, F.element_at(s, -1))
    )


def merge(a: Column, b: Column, fraction: float = 1 / 16, least: int = 64) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    limit = F.lit(int(_LEAST_LONG + fraction * _RANGE))
    both = F.sort_array(F.array_union(a, b))
    return F.filter(both, lambda x, i: (x < limit) | (i < least))


def _shared(a: Column, b: Column, fraction: float, least: int) -> tuple[Column, Column, Column]:
    """Sizes of a, b and both below the bound to which both are whole."""
    bound = F.least(whole_below(a, fraction, least), whole_below(b, fraction, least))
    below = lambda s: F.size(F.filter(s, lambda x: x <= bound))
    return below(a), below(b), below(F.array_intersect(a, b))


def likeness(a: Column, b: Column, fraction: float = 1 / 16, least: int = 64) -> Column:
    """Estimated Jaccard similarity; 1 for two texts without words."""
    na, nb, both = _shared(a, b, fraction, least)
    union = na + nb - both
    return F.when(union == 0, (F.size(a) == F.size(b)).cast("double")).otherwise(both / union)


def containment(a: Column, b: Column, fraction: float = 1 / 16, least: int = 64) -> Column:
    """Estimated share of a's shingles that b has; 1 for an a without words."""
    na, _, both = _shared(a, b, fraction, least)
    return F.when(na == 0, (F.size(a) == 0).cast("double")).otherwise(both / na)


def as_text(s: Column) -> Column:
    """Sixteen hexadecimal digits for each hash, ascending as signed numbers."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_next(df: DataFrame, id_: str, text: str, block_bits: int = 7) -> DataFrame:
    """Each row with ``_next``, the text of the next row by descending id; after
    the smallest id comes the largest. Rows of equal id follow each other by
    text, rows without an id have no next row (null).

    Texts are shuffled once, by blocks of neighbouring ids. The last row of a
    block takes the head of the next block, which is joined to the block: one row
    per block moves for that.
    """
    known = df.where(F.col(id_).isNotNull()).withColumn("_block", F.shiftright(id_, block_bits))
    within = Window.partitionBy("_block").orderBy(F.desc(id_), F.asc_nulls_first(text))
    blocks = dense_id(known.select("_block").distinct(), [F.desc("_block")], "_nth")
    count = blocks.agg(F.max("_nth")).first()[0] or 1
    follows = blocks.select(
        F.col("_block").alias("_to"),
        F.when(F.col("_nth") == 1, F.lit(count)).otherwise(F.col("_nth") - 1).alias("_nth"),
    ).join(blocks, "_nth")
    heads = (
        known.withColumn("_place", F.row_number().over(within))
        .where(F.col("_place") == 1)
        .select(F.col("_block").alias("_to"), F.col(text).alias("_head"))
    )
    heads = follows.join(heads, "_to").select("_block", "_head")
    linked = (
        known.withColumns({"_next": F.lead(text).over(within), "_more": F.lead(F.lit(True)).over(within)})
        .join(heads, "_block", "left")
        .withColumn("_next", F.when(F.col("_more"), F.col("_next")).otherwise(F.col("_head")))
    )
    alone = df.where(F.col(id_).isNull()).withColumn("_next", F.lit(None).cast("string"))
    return linked.select(*df.columns, "_next").unionByName(alone)


def fingerprint_documents(
    docs: DataFrame, k: int = 5, fraction: float = 1 / 16, least: int = 64
) -> DataFrame:
    """Fingerprints of every text and of its edited text, in which the last half
    of the code points gives way to the beginning of the next document.

    Null texts count as empty. A row without ``doc_id`` has no neighbour: its
    edited text loses its last half and ``near_next`` is null. Equal texts have
    equal fingerprints. Other columns of ``docs`` are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
        F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half),
    )
    sketched = with_next(rows, "doc_id", "text").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("text"), k, fraction, least).alias("_own"),
        sketch(edited, k, fraction, least).alias("_edited"),
        F.when(F.col("_next").isNotNull(), sketch(F.col("_next"), k, fraction, least)).alias("_after"),
    )
    own, other, after = F.col("_own"), F.col("_edited"), F.col("_after")
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(other).alias("edited_fingerprint"),
        likeness(own, other, fraction, least).alias("near_edited"),
        F.when(after.isNotNull(), likeness(own, after, fraction, least)).alias("near_next"),
        containment(own, other, fraction, least).alias("contained_in_edited"),
    )
