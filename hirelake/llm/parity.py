"""N-gram Jaccard join by parity sketches.

A text's set of word shingles is XOR-hashed into a bit sketch: a shingle flips one
bit, so the sketches of two sets differ in at most as many bits as the sets differ
in shingles. Sets that reach the similarity differ in at most ``D`` shingles, with
``D`` given by their sizes. Per band of sizes the sketch is cut into more than
``D`` pieces: two such sketches then agree in a whole piece, and only texts that
share a piece are compared, first by the distance of their sketches, then exactly.
Of a set's non-empty pieces a linked set shares all but ``D``; a set that shares fewer
with all others together takes no part.

Why no link is lost. Of ``D + 1 + E`` pieces, at least ``E + 1`` agree. If one of
the two sketches has at most ``E`` empty pieces, a non-empty piece agrees, and
every text offers all its non-empty pieces. A text with more empty pieces offers
those of a second sketch under another seed as well, and so on; after the last
seed it offers its empty pieces, too. If both texts have too many under a seed,
both go on to the next one.

Passages that many texts share would fill whole pieces. So shingles in the most
crowded of 2**20 counters are left out, if enough others remain: without them two
sets differ by no more than before, so their numbers of remaining shingles differ
by ``D`` at most. Texts with ``M`` or more of them offer pieces of these, texts with
``1.5 D`` to ``M + D`` smaller pieces of these, texts with less than ``2.5 D`` pieces of
all. The ranges overlap by ``D``, so two linked texts meet in one. ``M`` lies between
``2 D`` and ``3 D``, so that the smallest sets of a band are in one range alone if no
shingle of theirs is crowded.

Linear in the text: a set of n shingles offers about 0.36 n pieces at 0.85.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import hashing as H
from hirelake.llm.components import components
from hirelake.scratch import materialise

# Sketch bits in a piece. Nothing is stored a bit; so many that two shingles rarely share
# one: a piece often holds a single shingle, and among 2**12 bits texts without a common
# shingle would share pieces, the more of them the more texts there are.
_BITS = 1 << 32
_SEEDS = 6
_RATIO = 1.3  # from one band of sizes to the next


@dataclass(frozen=True)
class SizeBand:
    """Pairs whose smaller set has ``low`` to ``high`` shingles; linked ones differ
    in ``differ`` shingles at most."""

    number: int
    low: int
    high: int
    differ: int


def largest_partner(n: int, percent: int) -> int:
    return n * 100 // percent


def _spare(pieces: int, tokens: int) -> int:
    """Empty pieces that few sketches of so many tokens exceed."""
    spare = 0
    for _ in range(20):  # the spare pieces make all of them smaller
        empty = (pieces + spare) * np.exp(-tokens / (pieces + spare))
        spare = int(empty + 3 * np.sqrt(empty))
    return spare


def size_bands(most: int, percent: int) -> list[SizeBand]:
    """Bands for sets of up to ``most`` shingles."""
    bands, low = [], 1
    while low <= most:
        high = max(low, int(low * _RATIO) - 1)
        # |A and B| * 100 >= p |A or B| allows (100 - p) / (100 + p) of |A| + |B| to differ
        d = (100 - percent) * (high + largest_partner(high, percent)) // (100 + percent)
        bands.append(SizeBand(len(bands), low, high, d))
        low = high + 1
    return bands


def _offer(sets: np.ndarray, begin: np.ndarray, member: np.ndarray, d: int, tokens: int, salt: int) -> tuple[list, list, list]:
    """(keys, rows, needs) of the pieces of the member rows' sets; ``tokens`` is the
    least number that most of them have, ``salt`` tells bands and kinds apart. Needs are
    the ``salt`` and seed (11 bits) and above them how many of the row's non-empty pieces
    under that seed a linked set must share with it: all but ``d``, one at least."""
    keys, rows, needs = [], [], []
    spare = _spare(d + 1, tokens) if d else 0
    pieces = d + 1 + spare
    sizes = np.diff(begin)
    for seed in range(_SEEDS):
        at = np.flatnonzero(member)
        if not len(at):
            break
        n = sizes[at]
        local = np.repeat(np.arange(len(at)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        token = H.mix(sets[begin[at][local] + inside] + H.U64(seed + 1))
        width = H.U64(pieces * _BITS)
        place = local.astype(H.U64) * width + token % width
        place.sort()
        piece = place // H.U64(_BITS)
        first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1]))) if len(place) else np.zeros(0, np.int64)
        # equal bits cancel: what is left is a hash of the piece's parities
        sketch = np.bitwise_xor.reduceat(H.mix(place % width + H.U64(1)), first) if len(first) else place
        piece = piece[first]
        piece, sketch = piece[sketch != 0], sketch[sketch != 0]
        row, number = (piece // H.U64(pieces)).astype(np.int64), piece % H.U64(pieces)
        base = H.U64((salt * _SEEDS + seed + 1) << 32)
        keys.append(H.mix(sketch ^ H.mix(number + base)))
        rows.append(at[row])
        filled = np.bincount(row, minlength=len(at))
        need = np.clip(filled - d, 1, _MOST_NEEDED) << _TAG_BITS | (salt * _SEEDS + seed) % (1 << _TAG_BITS)
        needs.append(need[row])
        over = pieces - filled > spare
        if seed == _SEEDS - 1 and over.any():
            has = np.zeros((len(at), pieces), bool)
            has[row, number.astype(np.int64)] = True
            which, gap = np.nonzero(~has & over[:, None])
            keys.append(H.mix(H.mix(gap.astype(H.U64) + base)))
            rows.append(at[which])
            needs.append(need[which])
        member = np.zeros(len(sizes), bool)
        member[at[over]] = True
    return keys, rows, needs


def offers(
    sets: np.ndarray, begin: np.ndarray, percent: int, crowded: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, need) of all pieces that the rows offer; ``crowded`` marks counters."""
    sizes = np.diff(begin)
    keys, rows, needs = [], [], []
    rare = ~crowded[_counter(sets)]
    kept = np.concatenate(([0], np.cumsum(rare)))[begin]
    rest, n_rest = sets[rare], np.diff(kept)
    for band in size_bands(int(sizes.max(initial=0)), percent):
        member = (sizes >= band.low) & (sizes * percent <= band.high * 100)
        d = band.differ
        enough = min(3 * d, max(2 * d, band.low - d))
        many, some, few = n_rest >= enough, (2 * n_rest >= 3 * d) & (n_rest < enough + d), 2 * n_rest < 5 * d
        if not d:
            many, some, few = few, few, ~few
        for found in (
            _offer(rest, kept, member & many, d, enough, 3 * band.number),
            _offer(rest, kept, member & some, d, 3 * d // 2, 3 * band.number + 1),
            _offer(sets, begin, member & few, d, band.low, 3 * band.number + 2),
        ):
            keys += found[0]
            rows += found[1]
            needs += found[2]
    if not keys:
        return np.zeros(0, H.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(needs)


# Above the 40 bits of a set's id: 11 of band, kind and seed, 12 of the pieces needed.
_TAG_BITS, _MOST_NEEDED = 11, (1 << 12) - 1
_COUNTERS = 1 << 20
_CHUNK = 1 << 14


def _counter(sets: np.ndarray) -> np.ndarray:
    return (sets >> H.U64(64 - 20)).astype(np.int64)


def _sketch_bits(n: int) -> int:
    """Width of a whole sketch: a power of two, about two bits a shingle."""
    return 1 << min(13, max(8, int(2 * n - 1).bit_length()))


def _whole_sketches(sets: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """Parity of the shingles by their lowest bits, 64 to a number."""
    out = []
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        bits = np.bincount((sets[a:b] & H.U64(_sketch_bits(b - a) - 1)).astype(np.int64), minlength=_sketch_bits(b - a))
        out.append(np.packbits((bits & 1).astype(np.uint8), bitorder="little").view(np.int64))
    return out


ROWS = "doc_id long, n long, set_a long, set_b long, sketch array<long>, chunk int, counts binary"
_ID_MASK, _KEY_MASK = (1 << 40) - 1, (1 << 48) - 1


def _set_rows(docs: DataFrame, k: int) -> DataFrame:
    """For every document its set's size, 128-bit signature and whole sketch; and
    for every task its counters of shingles, in chunks (``chunk`` not null)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        longs = pa.list_(pa.int64())
        counts = np.zeros(_COUNTERS, np.int32)
        for batch in batches:
            for row, data, offsets in H.slices(batch.column("text")):
                sets, begin = H.shingle_sets(data, offsets, k)
                counts += np.bincount(_counter(sets), minlength=_COUNTERS).astype(np.int32)
                n = len(begin) - 1
                sketches = _whole_sketches(sets, begin)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sketches])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, n),
                        pa.array(np.diff(begin)),
                        pa.array(H.signed(H.row_sums(H.mix(sets ^ H.U64(0xA5A5A5A5)), begin))),
                        pa.array(H.signed(H.row_sums(H.mix(sets + H.U64(0x5A5A5A5A)), begin))),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sketches))),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names,
                )
        if counts.any():
            chunks = counts.reshape(-1, _CHUNK)
            none = [pa.nulls(len(chunks), pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [*none, pa.nulls(len(chunks), longs), pa.array(range(len(chunks)), pa.int32()), pa.array([c.tobytes() for c in chunks])],
                names,
            )

    return docs.select("doc_id", "text").mapInArrow(rows, ROWS)


def _crowded(rows: DataFrame) -> np.ndarray:
    """Marks of the counters far above the mean. The driver gets 2**20 bits."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(c, np.int32).astype(np.int64)
                totals[i] = totals[i] + part if i in totals else part
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()])], ["chunk", "counts"]
            )

    sums = materialise(
        rows.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary"),
        "counters",
    )  # one row for each of 64 chunks

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(np.frombuffer(c, np.int64).sum()) for c in batch.column("counts").to_pylist()], pa.int64())], ["n"]
            )

    mean = (sums.mapInArrow(total, "n long").agg(F.sum("n")).first()[0] or 0) / _COUNTERS
    limit = max(64, 16 * mean)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(c, np.int64) > limit).tobytes() for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(bits, pa.binary())], ["chunk", "bits"])

    marks = np.zeros((_COUNTERS // _CHUNK, _CHUNK), bool)
    for chunk, bits in sums.mapInArrow(mark, "chunk int, bits binary").collect():
        marks[chunk] = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)
    return marks.reshape(-1)


def _offered(docs: DataFrame, k: int, percent: int, crowded: np.ndarray) -> DataFrame:
    """(``key``, ``sid``): each piece with the low bits of its set's signature, and
    above them its need (see :func:`_offer`)."""
    packed = np.packbits(crowded)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(packed).view(bool)
        for batch in batches:
            for _, data, offsets in H.slices(batch.column("text")):  # all pieces of a slice are held at once
                sets, begin = H.shingle_sets(data, offsets, k)
                sid = H.row_sums(H.mix(sets ^ H.U64(0xA5A5A5A5)), begin) & H.U64(_ID_MASK)
                keys, row, need = offers(sets, begin, percent, marks)
                sid = sid[row] | need.astype(H.U64) << H.U64(40)
                for a in range(0, len(keys), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(H.signed(keys[a : a + 100_000] & H.U64(_KEY_MASK))),
                            pa.array(H.signed(sid[a : a + 100_000])),
                        ],
                        ["key", "sid"],
                    )

    return docs.select("text").mapInArrow(pieces, "key long, sid long")


def shingle_arrays(docs: DataFrame, k: int) -> DataFrame:
    """(``node``, ``shingles``): the sorted distinct shingle hashes of the texts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in H.slices(batch.column("text")):
                sets, begin = H.shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(row, len(begin) - 1),
                        pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(H.signed(sets))),
                    ],
                    ["node", "shingles"],
                )

    return docs.select("node", "text").mapInArrow(hashed, "node long, shingles array<long>")


def _fold(sketch: Column, size: Column) -> Column:
    """A sketch at a smaller width (a power of two): numbers that fall together
    are XORed, as the shingles' parities are."""
    return F.when(F.size(sketch) <= size, sketch).otherwise(
        F.transform(
            F.sequence(F.lit(0), size - 1),
            lambda i: F.aggregate(
                F.sequence(F.lit(0), F.floor(F.size(sketch) / size).cast("int") - 1),
                F.lit(0).cast("long"),
                lambda acc, j: acc.bitwiseXOR(F.get(sketch, i + j * size)),
            ),
        )
    )


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches differ in no more bits than linked sets may."""
    a = sketches.select(F.col("node").alias("u"), F.col("n").alias("_na"), F.col("sketch").alias("_a"))
    b = sketches.select(F.col("node").alias("v"), F.col("n").alias("_nb"), F.col("sketch").alias("_b"))
    size = F.least(F.size("_a"), F.size("_b"))
    differ = F.aggregate(
        F.zip_with(_fold(F.col("_a"), size), _fold(F.col("_b"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    both = pairs.join(a, "u").join(b, "v")
    return both.where(differ * (100 + percent) <= (F.col("_na") + F.col("_nb")) * (100 - percent)).select("u", "v").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(``u``, ``v``, ``linked``) of the candidate pairs, by their whole sets."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - both
    return pairs.join(a, "u").join(b, "v").select("u", "v", (both * 100 >= union * percent).alias("linked"))


def _possible(n_a: str, n_b: str, percent: int) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


_SMALL, _TILE = 16, 2048


def _across(
    groups: DataFrame, parts: DataFrame, sketches: DataFrame, percent: int
) -> DataFrame:
    """Pairs of a group that lie in different components and are near by sketch.

    Groups of up to 16 texts are joined with themselves, at most 15 pairs a text.
    Larger ones are compared inside a task, as blocks of sketches, and only near
    pairs leave it; a group of more than 2048 texts is cut into parts, which meet
    each other in turn.
    """
    placed = groups.join(parts, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("_a"), F.max("component").alias("_b"), F.count(F.lit(1)).alias("size"))
        .where(F.col("_a") != F.col("_b"))
        .select("key", "size")
    )
    placed = materialise(placed.join(mixed, "key"), "mixed")
    small = placed.where(F.col("size") <= _SMALL)
    other = small.select("key", F.col("node").alias("v"), F.col("n").alias("_n"), F.col("component").alias("_c"))
    few = (
        small.withColumnRenamed("node", "u")
        .join(other, "key")
        .where((F.col("u") < F.col("v")) & (F.col("component") != F.col("_c")) & _possible("n", "_n", percent))
        .select("u", "v")
        .distinct()
    )
    cut = F.ceil(F.col("size") / _TILE).cast("int")
    home = F.pmod(F.xxhash64("node"), cut).cast("int")
    large = (
        placed.where(F.col("size") > _SMALL)
        .withColumn("home", home)
        .withColumn("part", F.explode(F.sequence(F.col("home"), cut - 1)))
        .join(sketches.select("node", "sketch"), "node")
        .select("key", "part", (F.col("part") != F.col("home")).alias("visits"), "node", "n", "component", "sketch")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, same in _meetings(batches):
            u, v = _near_in_blocks(a, b, same, percent)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    many = (
        large.repartition("key", "part")
        .sortWithinPartitions("key", "part", "visits")
        .mapInArrow(compare, "u long, v long")
    )
    return _near(few, sketches, percent).union(many).distinct()


Members = tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]  # node, n, component, sketch


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Members, Members, bool]]:
    """From rows sorted by group, part and visit: the texts at home in a part with
    themselves, then with those that visit them, some at a time."""

    def joined(held: list[Members]) -> Members:
        return (*(np.concatenate([h[i] for h in held]) for i in range(3)), [s for h in held for s in h[3]])

    place, held, home = None, [], None
    for batch in batches:
        key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
        visits = batch.column("visits").to_numpy(zero_copy_only=False)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (visits[1:] != visits[:-1])
        cuts = np.append(np.flatnonzero(new), len(key))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = batch.slice(a, b - a)
            members = (
                *(rows.column(c).to_numpy() for c in ("node", "n", "component")),
                [np.array(s, np.int64) for s in rows.column("sketch").to_pylist()],
            )
            if (key[a], part[a]) != place:
                if held:
                    home = joined(held)
                    yield home, home, True
                place, held, home = (key[a], part[a]), [], None
            if not visits[a]:
                held.append(members)
                continue
            if held:
                home, held = joined(held), []
                yield home, home, True
            if home:
                yield home, members, False
    if held:
        home = joined(held)
        yield home, home, True


def _near_in_blocks(a: Members, b: Members, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components whose sketches, at their smallest common
    width, differ in no more bits than linked sets may."""
    width = min(len(s) for m in (a, b) for s in m[3])
    x, y = (
        np.stack([np.bitwise_xor.reduce(s.reshape(-1, width), axis=0) for s in m[3]]).view(np.uint64) for m in (a, b)
    )
    us, vs = [], []
    rows = max(1, (1 << 21) // (len(y) * width))
    for i in range(0, len(x), rows):
        differ = np.bitwise_count(x[i : i + rows, None] ^ y[None]).sum(2, dtype=np.int64)
        na, nb = a[1][i : i + rows, None], b[1][None]
        near = differ * (100 + percent) <= (na + nb) * (100 - percent)
        near &= np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
        near &= a[2][i : i + rows, None] != b[2][None]
        if same:
            near &= a[0][i : i + rows, None] < b[0][None]
        p, q = np.nonzero(near)
        us.append(a[0][i + p])
        vs.append(b[0][q])
    return np.concatenate(us), np.concatenate(vs)


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) of every document.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|`` for
    their sets of ``k``-word shingles; the component is the smallest ``doc_id``
    reachable. Documents of fewer than ``k`` words have their whole sequence as
    the one shingle; without words they are linked with nothing. Rows without a
    ``doc_id`` are linked with nothing and have no component. Documents with the
    same set count as one node from here on, whatever their number; rows that
    repeat an id must repeat its text.

    In each group of texts with the same piece, all are compared by sketch with
    the text that shares the most pieces, which settles almost every group; then
    those pairs of a group that still lie in different components. What passes is
    verified by the whole sets. If that splits components, pairs across the parts
    are compared once more. Pairs within a component are never enumerated.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    rows = materialise(_set_rows(named, k), "sets")
    crowded = _crowded(rows)
    known_rows = rows.where("chunk is null")
    filled = known_rows.where("n > 0")
    nodes = materialise(
        filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"))
        .withColumn("sid", F.col("set_a").bitwiseAND(F.lit(_ID_MASK))),
        "nodes",
    )
    # groups of different sets that offer the same piece
    piece, id_ = Window.partitionBy("key"), F.col("sid").bitwiseAND(F.lit(_ID_MASK))
    found = materialise(
        _offered(named, k, percent, crowded)
        .withColumns({"_low": F.min(id_).over(piece), "_high": F.max(id_).over(piece)})
        .where(F.col("_low") != F.col("_high"))
        .select("key", "sid")
        .distinct(),
        "found",
    )
    # a set that shares fewer pieces than a linked one would has no link there
    enough = found.groupBy("sid").agg(F.count(F.lit(1)).alias("_k")).where(
        F.col("_k") >= F.shiftrightunsigned("sid", 40 + _TAG_BITS)
    )
    shared = materialise(found.join(enough.select("sid"), "sid", "left_semi").select("key", id_.alias("sid")), "shared")
    sizes = shared.groupBy("key").agg(F.count(F.lit(1)).alias("_w"))
    popular = shared.join(sizes, "key").groupBy("sid").agg(F.sum("_w").alias("weight"))
    known = materialise(nodes.join(popular, "sid").select("sid", "node", "n", "weight"), "popular")
    groups = materialise(shared.join(known, "sid").select("key", "node", "n", "weight"), "groups")
    sketches = materialise(
        filled.select(F.col("doc_id").alias("node"), "n", "sketch").join(known.select("node").distinct(), "node", "left_semi"),
        "sketches",
    )

    centre = groups.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("_c"))
    stars = (
        groups.join(centre, "key")
        .where((F.col("node") != F.col("_c.node")) & _possible("n", "_c.n", percent))
        .select(F.least("_c.node", "node").alias("u"), F.greatest("_c.node", "node").alias("v"))
        .distinct()
    )
    likely = materialise(_near(stars, sketches, percent), "likely")
    across = _across(groups, materialise(components(likely), "parts"), sketches, percent)
    pairs = materialise(likely.union(across).distinct(), "pairs")

    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    texts = named.select(F.col("doc_id").alias("node"), "text").join(wanted, "node", "left_semi")
    sets = materialise(shingle_arrays(texts, k), "shingles")
    links = materialise(_verified(pairs, sets, percent).where("linked").select("u", "v").distinct(), "linked")
    parts = materialise(components(links), "parts")

    left = _across(groups, parts, sketches, percent).join(pairs, ["u", "v"], "left_anti")
    left = materialise(left, "left")
    if not left.isEmpty():
        more = _verified(left, sets, percent).where("linked").select("u", "v")
        parts = materialise(components(links.union(more)), "parts")

    labelled = nodes.join(parts, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("component_id")
    )
    linked = known_rows.select("doc_id", F.col("n").alias("n_shingles"), "set_a", "set_b").join(
        labelled, ["set_a", "set_b"], "left"
    )
    answer = linked.select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return answer.unionByName(_unnamed(docs, k))


def _unnamed(docs: DataFrame, k: int) -> DataFrame:
    """Rows without a ``doc_id``: their set sizes, no component."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in H.slices(batch.column("text")):
                n = np.diff(H.shingle_sets(data, offsets, k)[1])
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(n), none], ["doc_id", "n_shingles", "component_id"])

    return docs.where(F.col("doc_id").isNull()).select("text").mapInArrow(
        count, "doc_id long, n_shingles long, component_id long"
    )
