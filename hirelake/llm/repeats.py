"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A string of ``length`` bytes that starts twice is found in three steps.

1. Every window of that length has an anchor, its gram of smallest hash. Windows
   that follow each other with the same anchor form a run; equal windows lie in
   runs of equal anchors. Runs that are equal as a whole need no comparison: all
   but the first are repeats. Anchors of one run, most of a corpus, end here.
2. Different runs of one anchor are cut from the texts and brought together by
   anchor. A task takes whole groups, deals the runs out to shards, sorts each
   shard's suffixes and merges the shards' transforms by interleave refinement.
   The blocks of a common prefix of ``length`` bytes are the repeated windows.
3. Of each block all windows but the first in (doc_id, start) are removed.

Anchors with more runs than a task should hold are compared window by window
instead, by 128-bit hashes of whole windows that Spark groups with partial sums.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import hashing as H
from hirelake.llm.bwt import collect, merge
from hirelake.scratch import materialise

_PLACE_BITS = 24  # of a slice position, in the low bits of an anchor's rank


def _prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = H.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, H.U64)
    np.cumsum((data.astype(H.U64) + H.U64(1)) * up[:-1], out=total[1:])
    return total, down


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        more = min(done, width - done)
        x = np.minimum(x[: len(x) - more], x[more:])
        done += more
    return x


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows of the same anchor in the rows of a slice: ``row``, start
    ``a`` in the row, number ``n`` of windows, anchor hash ``g``, hash ``h`` of the
    run's bytes and of the anchor's place in them."""
    size = np.diff(offsets)
    if len(data) < length:
        return {k: np.zeros(0, np.int64) for k in ("row", "a", "n", "g", "h")}
    total, down = _prefix_hashes(data)
    hashed = H.mix((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    low = H.U64((1 << _PLACE_BITS) - 1)
    rank = (hashed & ~low) | np.arange(len(hashed), dtype=H.U64)
    best = _smallest(rank, length - gram + 1) & low
    has = np.flatnonzero(size >= length)
    n_windows = size[has] - length + 1
    window = np.arange(n_windows.sum()) + np.repeat(offsets[has] - np.concatenate(([0], np.cumsum(n_windows)[:-1])), n_windows)
    row = np.repeat(has, n_windows)
    anchor = best[window].astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(window)))
    at, place = window[first], anchor[first]
    whole = H.mix((total[at + n - 1 + length] - total[at]) * down[at])
    return {
        "row": row[first],
        "a": at - offsets[row[first]],
        "n": n,
        "g": H.signed(hashed[place]),
        "h": H.signed(H.mix(whole + (place - at).astype(H.U64) * H.U64(0x9E3779B97F4A7C15) + n.astype(H.U64))),
    }


def _sections(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before) of parts that fit an anchor's place: the slice,
    or overlapping pieces of one very long text."""
    most = 1 << (_PLACE_BITS - 1)
    if len(data) <= most:
        yield 0, 0, data, offsets
        return
    for row in range(len(offsets) - 1):
        text = data[offsets[row] : offsets[row + 1]]
        for a in range(0, max(1, len(text) - length + 1), most):
            part = text[a : a + most + length - 1]
            yield row, a, part, np.array([0, len(part)])


def _find_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, data, offsets in H.slices(batch.column("text"), 2 << 20):
                for more, skipped, part, ends in _sections(data, offsets, length):
                    r = runs(part, ends, length, gram)
                    doc, a = ids[row + more + r["row"]].astype(np.int64), r["a"] + skipped
                    g, again = _spread_repeats(r["g"], r["h"], doc, a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(g), pa.array(r["h"]), pa.array(doc), pa.array(a),
                            pa.array(r["n"], pa.int32()), pa.array(again),
                        ],
                        ["g", "h", "doc_id", "a", "n", "again"],
                    )

    return docs.select("doc_id", "text").mapInArrow(
        find, "g long, h long, doc_id long, a long, n int, again boolean"
    )


def _spread_repeats(
    g: np.ndarray, h: np.ndarray, doc: np.ndarray, a: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the runs of a slice that are equal to an earlier run of it. They
    are repeats whatever else there is, so their anchor gives way to a hash of
    their place: a run that occurs very often is sent on once a slice, and the
    rest spreads over all tasks."""
    order = np.lexsort((a, doc, h, g))
    first = np.ones(len(g), bool)
    first[1:] = (g[order][1:] != g[order][:-1]) | (h[order][1:] != h[order][:-1])
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))] if len(g) else order
    again = np.zeros(len(g), bool)
    again[order] = (doc[order] != doc[lead]) | (a[order] != a[lead])
    place = H.signed(H.mix(doc.astype(H.U64) * H.U64(0x9E3779B97F4A7C15) + a.astype(H.U64)))
    return np.where(again, place, g), again


def repeated_windows(
    strings: list[np.ndarray], doc: np.ndarray, start: np.ndarray, windows: np.ndarray, length: int, shards: int = 4
) -> list[tuple[int, int, int]]:
    """Spans (doc, from, to) of windows that start earlier as well, among the first
    ``windows[i]`` windows of each string; string i begins at ``start[i]`` of
    document ``doc[i]``."""
    c = collect(strings, shards, length)
    suffix, block = merge(c, length, windows)
    string, inside = c.strings[c.string[suffix]], c.inside[suffix]
    d, s = doc[string], start[string] + inside
    order = np.lexsort((s, d, block))
    string, inside, block, d, s = string[order], inside[order], block[order], d[order], s[order]
    first = np.ones(len(block), bool)
    first[1:] = block[1:] != block[:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(block)), 0))
    again = (d != d[lead]) | (s != s[lead])
    string, inside = string[again], inside[again]
    order = np.lexsort((inside, string))
    string, inside = string[order], inside[order]
    new = np.ones(len(string), bool)
    new[1:] = (string[1:] != string[:-1]) | (inside[1:] != inside[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(string)) - 1
    own = string[begin]
    return list(
        zip(
            doc[own].tolist(),
            (start[own] + inside[begin]).tolist(),
            (start[own] + inside[last] + length).tolist(),
            strict=True,
        )
    ) if len(begin) else []


def _spans_batch(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = zip(*spans, strict=True) if spans else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "s", "e"])


_PIECES = "g long, doc_id long, a long, n int, piece binary, w1 long, w2 long"


def repeated_spans(
    docs: DataFrame, length: int = 100, gram: int = 40, most_runs: int = 20_000, batch_bytes: int = 1 << 20
) -> DataFrame:
    """(``doc_id``, ``s``, ``e``): byte spans covered by repeats; they may overlap."""
    by_anchor, by_run = Window.partitionBy("g"), Window.partitionBy("g", "h").orderBy("doc_id", "a")
    seen = materialise(
        _find_runs(docs, length, gram)
        .withColumns(
            {"_low": F.min("h").over(by_anchor), "_high": F.max("h").over(by_anchor), "_nth": F.rank().over(by_run)}
        )
        .withColumn("differ", F.col("_low") != F.col("_high"))
        .where(F.col("again") | F.col("differ") | (F.col("_nth") > 1))
        .select("g", "doc_id", "a", "n", "differ", (~F.col("again") & (F.col("_nth") == 1)).alias("first")),
        "runs",
    )
    copies = seen.where(~F.col("first")).select("doc_id", F.col("a").alias("s"), (F.col("a") + F.col("n") - 1 + length).alias("e"))
    open_ = seen.where("first and differ").select("g", "doc_id", "a", "n")
    crowded = open_.groupBy("g").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > most_runs)
    marked = open_.join(crowded.select("g", F.lit(True).alias("crowded")), "g", "left")
    wanted = (
        marked.distinct()
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("g", "a", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("cuts"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows: list[tuple] = []
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for i in range(batch.num_rows):
                text, doc = texts[i].as_py() or b"", batch.column("doc_id")[i].as_py()
                for c in batch.column("cuts")[i].as_py():
                    g, a, n = c["g"], c["a"], c["n"]
                    if not c["crowded"]:
                        rows.append((g, doc, a, n, text[a : a + n - 1 + length], None, None))
                        continue
                    for s in range(a, a + n):
                        w = np.frombuffer(hashlib.blake2b(text[s : s + length], digest_size=16).digest(), np.int64)
                        rows.append((g, doc, s, 1, None, int(w[0]), int(w[1])))
                if len(rows) >= 5000:
                    yield out(rows)
                    rows = []
        if rows:
            yield out(rows)

    pieces = materialise(
        docs.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "text", "cuts").mapInArrow(cut, _PIECES), "pieces"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def solve() -> pa.RecordBatch:
            docs_, starts, windows = (np.array([h[k] for h in held], np.int64) for k in (0, 1, 2))
            strings = [np.frombuffer(h[3], np.uint8) for h in held]
            return _spans_batch(repeated_windows(strings, docs_, starts, windows, length))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("g", "doc_id", "a", "n", "piece")]
            for g, doc, a, n, piece in zip(*columns, strict=True):
                if size >= batch_bytes and g != last:
                    yield solve()
                    held, size = [], 0
                held.append((doc, a, n, piece))
                size, last = size + len(piece), g
        if held:
            yield solve()

    merged = (
        pieces.where(F.col("piece").isNotNull())
        .select("g", "doc_id", "a", "n", "piece")
        .repartition("g")
        .sortWithinPartitions("g", "doc_id", "a")
        .mapInArrow(compare, "doc_id long, s long, e long")
    )
    single = pieces.where(F.col("piece").isNull()).select("w1", "w2", "doc_id", "a").distinct()
    earliest = single.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "a")).alias("_first"))
    later = (
        single.join(earliest, ["w1", "w2"])
        .where(F.struct("doc_id", "a") != F.col("_first"))
        .select("doc_id", F.col("a").alias("s"), (F.col("a") + length).alias("e"))
    )
    return copies.unionByName(merged).unionByName(later)


def remove_repeats(docs: DataFrame, length: int = 100, **options: int) -> DataFrame:
    """(``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``) of
    every row after removing each byte covered by a string of ``length`` bytes that
    also starts earlier: in a smaller ``doc_id``, or before in the same document.

    Null texts are empty; texts shorter than ``length`` stay. Rows without a
    ``doc_id`` stay whole and remove nothing. Rows that repeat an id must repeat
    its text; they stand for one document and have equal results.
    """
    named = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    spans = repeated_spans(named, length, **options)
    by_doc = spans.groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, rows = batch.column("text").cast(pa.large_binary()), batch.column("doc_id"), []
            for i in range(batch.num_rows):
                text, cuts = texts[i].as_py() or b"", batch.column("spans")[i].as_py() or []
                end, removed, n, kept = 0, 0, 0, hashlib.sha256()
                last = -1  # end of the removed run before
                for c in sorted((c["s"], c["e"]) for c in cuts):
                    s, e = max(c[0], end), c[1]
                    if e <= end:
                        continue
                    if s > last:
                        n += 1
                    kept.update(text[end:s])
                    removed, end, last = removed + e - s, e, e
                kept.update(text[end:])
                rows.append((ids[i].as_py(), len(text), removed, n, kept.hexdigest()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return (
        docs.select("doc_id", "text")
        .join(by_doc, "doc_id", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
