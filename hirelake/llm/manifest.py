"""Merkle manifest of a dataset, its leaves placed by ranks in bitmaps.

A row's leaf is a hash of its columns. Leaves stand in groups (such as the
language), in each by ascending id; runs of eight nodes become one node until a
group has one, its subroot, and the subroots become the root in the same way.

Where a leaf stands is its id's rank among the ids of its group. The ids are bits of
64-bit words, OR-ed together by partial aggregation; empty words are not stored.
Words lie in containers of 64 (4,096 ids). The containers' popcounts are added up to
a directory, and a join with it gives every leaf its rank without sorting leaves.

A leaf of rank r goes to slot r % 512 of the array keyed r // 512. An array is three
levels of the tree, so a shuffle reduces nodes to one in 512. Going back down, each
array hands its slots the siblings above them, which gives every leaf its proof.
Only Spark expressions are used.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.keys import dense_id
from hirelake.scratch import materialise

FANOUT = 8
_LEVELS = 3  # of the tree in an array
_SLOTS = FANOUT**_LEVELS
_WORD, _CONTAINER = 6, 12  # bits of an id below its word's number, below its container's
_NO_ID = -(1 << 52)  # the container of null ids, before all others
_ROW_BITS = 33
_PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def tree_height(n: Column) -> Column:
    """Levels above ``n`` nodes until one is left."""
    return F.size(F.filter(F.array(*[F.lit(FANOUT**i).cast("long") for i in range(21)]), lambda p: p < n))


# --- ranks in bitmaps -------------------------------------------------------


def _container(id_: Column) -> Column:
    return F.coalesce(F.shiftright(id_, _CONTAINER), F.lit(_NO_ID))


def _word(id_: Column) -> Column:
    return F.coalesce(F.shiftright(id_, _WORD).bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


_BIT = "coalesce(_id & 63, 0)"


def id_bitmaps(rows: DataFrame) -> DataFrame:
    """From (``_group``, ``_id``): one row per group and container with its ``words``
    (by number: bits, rows, rows of the container before it; at most 64), and the
    rows of the group in containers before it (``before``). Written tables."""
    words = rows.groupBy("_group", _container(F.col("_id")).alias("container"), _word(F.col("_id")).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({_BIT} as int))")).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    containers = words.groupBy("_group", "container").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits", "n"))).alias("_words"), F.sum("n").alias("rows")
    )
    slices = materialise(
        containers.repartitionByRange("_group", "container")
        .sortWithinPartitions("_group", "container")
        .withColumn("_slice", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)),
        "bitmaps",
    )
    inside = Window.partitionBy("_group", "_slice").orderBy("container").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.groupBy("_group", "_slice").agg(F.sum("rows").alias("_rows"))  # a row for each task and group
    starts = starts.select("_group", "_slice", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_start"))

    def entry(w: Column, i: Column) -> Column:
        ahead = F.aggregate(F.slice("_words", F.lit(1), i), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        return F.struct(w["word"], F.struct(w["bits"].alias("bits"), w["n"].alias("n"), ahead.alias("before")))

    directory = (
        slices.withColumn("_in", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .join(materialise(starts, "bitmap-starts"), ["_group", "_slice"])
        .select(
            "_group", "container", F.map_from_entries(F.transform("_words", entry)).alias("words"), "rows",
            (F.col("_start") + F.col("_in")).alias("before"),
        )
    )
    return materialise(directory, "directory")


def with_ranks(rows: DataFrame, directory: DataFrame, ties: Sequence[str]) -> DataFrame:
    """``rows`` with ``_rank``, 0 upwards in each ``_group`` by ascending ``_id``, null
    first; rows that repeat an id by ``ties``, which must tell rows apart.

    A word whose rows are more than its bits holds repeated ids. Its rows are numbered
    by a range sort; where ids are unique there are none.
    """
    found = rows.withColumn("container", _container(F.col("_id"))).withColumn("_word", _word(F.col("_id")))
    found = found.join(directory, ["_group", "container"]).withColumn("_w", F.try_element_at("words", F.col("_word")))
    found = found.withColumn("_before", F.col("before") + F.col("_w.before"))
    below = F.expr(f"_w.bits & ~shiftleft(-1L, cast({_BIT} as int))")
    alone = found.where("bit_count(_w.bits) = _w.n").select(*rows.columns, (F.col("_before") + F.bit_count(below)).alias("_rank"))
    crowded = directory.where(F.exists(F.map_values("words"), lambda w: F.bit_count(w["bits"]) != w["n"]))
    if crowded.isEmpty():
        return alone
    again = found.where("bit_count(_w.bits) <> _w.n").select(*rows.columns, "container", "_word", "_before")
    order = [F.asc_nulls_first("_id"), *[F.asc_nulls_first(c) for c in ties]]
    numbered = dense_id(again, order, "_nth", ["_group", "container", "_word"])
    return alone.unionByName(numbered.select(*rows.columns, (F.col("_before") + F.col("_nth") - 1).alias("_rank")))


# --- levels of the tree -----------------------------------------------------


def _up(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "")))


def _arrays(nodes: DataFrame, items: Sequence[str], step: int) -> DataFrame:
    """From (``_group``, ``_height``, ``_rank``, ``node`` and ``items``): one row per array
    with its ``slots``, the nodes of its levels ``l0`` to ``l2``, the number ``levels`` of
    those that the group still has, and the ``top`` above them."""
    slots = F.sort_array(F.collect_list(F.struct((F.col("_rank") % _SLOTS).cast("int").alias("slot"), "node", *items)))
    arrays = nodes.groupBy("_group", "_height", F.shiftright("_rank", 3 * _LEVELS).alias("_array")).agg(slots.alias("slots"))
    levels = F.greatest(F.lit(0), F.least(F.lit(_LEVELS), F.col("_height") - step * _LEVELS))
    arrays = arrays.withColumn("levels", levels).withColumn("l0", F.transform("slots", lambda s: s["node"]))
    one = arrays.withColumn("l1", F.when(F.col("levels") > 0, _up(F.col("l0"))))
    two = one.withColumn("l2", F.when(F.col("levels") > 1, _up(F.col("l1"))))
    three = F.when(F.col("levels") > 2, F.get(_up(F.col("l2")), F.lit(0)))
    lower = [F.get(F.col(c), F.lit(0)) for c in ("l2", "l1", "l0")]
    return materialise(two.withColumn("top", F.coalesce(three, *lower)), "levels")


def _climb(nodes: DataFrame, items: Sequence[str], highest: int) -> list[DataFrame]:
    """The arrays of all levels, from the nodes up to each group's last one."""
    steps = [_arrays(nodes, items, 0)]
    while len(steps) * _LEVELS < highest:
        above = steps[-1].select("_group", "_height", F.col("_array").alias("_rank"), F.col("top").alias("node"))
        steps.append(_arrays(above, [], len(steps)))
    return steps


def _siblings(j: Column) -> Column:
    """For slot ``j`` the nodes beside it in its run, left and right, level by level."""

    def at(level: str, up: int) -> Column:
        here = F.shiftright(j, 3 * up)
        inside = here % FANOUT
        left = F.slice(F.col(level), here - inside + 1, inside)
        right = F.slice(F.col(level), here + 2, FANOUT - 1 - inside)
        return F.struct(F.array_join(left, "").alias("l"), F.array_join(right, "").alias("r"))

    none = F.array().cast(_PATH)
    levels = [F.when(F.col("levels") > k, F.array(at(f"l{k}", k))).otherwise(none) for k in range(_LEVELS)]
    return F.concat(*levels)


def _descend(steps: list[DataFrame], above: DataFrame, make: Callable[[Column, Column], Column]) -> DataFrame:
    """From the ``path`` above each group's last node and further columns of ``above``
    (keyed ``_group``): the rows ``make(slot, path)`` of the lowest arrays, with them."""
    extra = [c for c in above.columns if c not in ("_group", "path")]
    paths = above.withColumn("_array", F.lit(0).cast("long"))
    for step in reversed(steps):
        lowest = step is steps[0]
        rows = step.join(paths, ["_group", "_array"])

        def ranked(s: Column, path: Column) -> Column:
            return F.struct((F.col("_array") * _SLOTS + s["slot"]).alias("_array"), path.alias("path"))

        out = make if lowest else ranked
        slots = F.transform("slots", lambda s: out(s, F.concat(_siblings(s["slot"]), F.col("path"))))  # noqa: B023
        paths = rows.select("_group", *extra, F.inline(slots))
        if not lowest:
            paths = materialise(paths, "paths")
    return paths


def _folded(node: Column, path: Column) -> Column:
    return F.aggregate(path, node, lambda acc, p: digest(p["l"], acc, p["r"]))


def _proof(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""))


def merkle_manifest(
    docs: DataFrame,
    leaf: Column,
    shown: Column | None = None,
    key: str = "doc_id",
    group: str = "lang",
) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and
    ``verified`` of every row.

    ``leaf`` is the row's digest (see :func:`leaf_digest`). ``shown``, where it is not
    null, is the digest of the row as someone shows it: ``folded_root`` is computed
    from that and the original siblings, and ``verified`` says whether it is the root.
    ``proof_sha256`` is the digest of all siblings from the leaf to the root.

    Null groups are a group of their own, before all others, which are ordered by
    their UTF-8 bytes. Null keys come first in their group; rows that repeat a key
    are ordered by leaf, so equal rows are interchangeable. Other columns are
    ignored, an empty table has an empty manifest.
    """
    rows = materialise(
        docs.select(
            F.col(key).cast("long").alias("_id"),
            F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("_group"),
            leaf.alias("node"),
            (F.lit(None).cast("string") if shown is None else shown).alias("shown"),
        ).withColumn("_row", F.monotonically_increasing_id()),
        "leaves",
    )
    directory = id_bitmaps(rows.select("_group", "_id"))
    sizes = directory.groupBy("_group").agg(F.sum("rows").alias("_rows"))
    sizes = materialise(sizes.select("_group", tree_height(F.col("_rows")).alias("_height")), "heights")  # a row for each group
    ranked = with_ranks(rows, directory, ["node", "_row"]).join(sizes, "_group")
    highest, n_groups = sizes.agg(F.max("_height"), F.count(F.lit(1))).first()
    steps = _climb(ranked, ["_id", "shown"], highest or 0)

    subroots = steps[-1].select("_group", F.col("top").alias("node"))
    placed = dense_id(subroots, [F.asc("_group")], "_nth")
    top_height = tree_height(F.lit(n_groups).cast("long"))
    tops = placed.select(
        F.lit("").alias("_group"), top_height.alias("_height"), (F.col("_nth") - 1).alias("_rank"),
        "node", F.col("_group").alias("of"),
    )
    height = next(i for i in range(22) if FANOUT**i >= n_groups)
    top_steps = _climb(tops, ["of"], height)
    root = top_steps[-1].select("_group", F.col("top").alias("root"), F.array().cast(_PATH).alias("path"))

    above = _descend(
        top_steps, root, lambda s, path: F.struct(s["of"].alias("_of"), s["node"].alias("subroot"), path.alias("path"))
    )
    above = materialise(above.select(F.col("_of").alias("_group"), "subroot", "root", "path"), "tops")

    def row(s: Column, path: Column) -> Column:
        return F.struct(s["_id"].alias(key), s["node"].alias("leaf"), s["shown"].alias("shown"), path.alias("path"))

    leaves = _descend(steps, above, row)
    folded = leaves.select(
        key, "leaf", "subroot", "root", _proof(F.col("path")).alias("proof_sha256"),
        _folded(F.coalesce("shown", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
