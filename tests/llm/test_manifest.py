"""Merkle manifests against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hirelake.llm.manifest import id_bitmaps, leaf_digest, merkle_manifest, with_ranks

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    return sha("".join(map(field, row)))


def tree(leaves):
    """Levels of a tree, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 8
        out.append((level[run:at], level[at + 1 : run + 8]))
        at //= 8
    return out


def expected(rows, shown):
    """Rows (leaf, subroot, root, proof, folded, verified) from (id, source, lang, n, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups, out = [], []
    for lang in langs:
        own = [r for r in rows if r[2] == lang]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        groups.append((own, tree([leaf_of(r) for r in own])))
    top = tree([levels[-1][0] for _, levels in groups])
    for g, (own, levels) in enumerate(groups):
        for i, r in enumerate(own):
            path = siblings(levels, i) + siblings(top, g)
            node = shown(r) or leaf_of(r)
            for left, right in path:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(a + b) for a, b in path))
            out.append((r[0], leaf_of(r), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def tampered(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3:
        return None
    lower = r[4] if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
    return leaf_of((*r[:4], lower))


def manifest(spark, rows):
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int",
    )
    columns = [F.col(c) for c in COLUMNS]
    changed = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_digest([*columns[:4], changed]))
    return [tuple(r) for r in merkle_manifest(docs, leaf_digest(columns), shown).collect()]


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (8, 9), (1, 8, 64, 65, 513)])
def test_sizes_of_groups(spark, sizes):
    rows, rng = [], random.Random(1)
    for g, n in enumerate(sizes):
        for i in rng.sample(range(-50, 10_000), n):
            rows.append((i, f"s{i % 3}", f"l{g}", i, f"Text {i} of {g}"))
    rng.shuffle(rows)
    assert sorted(manifest(spark, rows), key=key) == sorted(expected(rows, tampered), key=key)


def test_more_groups_than_a_run(spark):
    rows = [(i, "s", None if i % 70 == 0 else chr(40 + i % 70 * 3), i, "A" * (i % 5)) for i in range(600)]
    assert sorted(manifest(spark, rows), key=key) == sorted(expected(rows, tampered), key=key)


def test_nulls_repeats_and_wide_ids(spark, awkward):
    rows = [(i, "s", "en", None, t) for i, t in enumerate(awkward)]
    rows += [(None, None, None, None, None), (None, "a", "en", 1, "B"), (None, "a", "en", 1, "A")]
    rows += [(5, "s", "en", 1, "C")] * 9 + [(5, "s", "en", 1, "D")] * 2 + [(4, "s", "", 1, "")]
    rows += [(-(1 << 63), "s", "en", 1, "E"), ((1 << 63) - 1, "s", "en", 1, "F"), (-1, "s", "en", 1, "G"), (63, "s", "en", 1, "H")]
    assert sorted(manifest(spark, rows), key=key) == sorted(expected(rows, tampered), key=key)


def test_empty_table(spark):
    assert manifest(spark, []) == []


def test_ranks(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-(1 << 62), -1) for _ in range(300)] + rng.sample(range(20_000), 3000)
    rows = spark.createDataFrame([(f"={i % 2}", v) for i, v in enumerate(ids)], "_group string, _id long")
    directory = id_bitmaps(rows)
    assert directory.agg(F.max(F.size("words"))).first()[0] <= 64
    got = {(r["_group"], r["_id"]): r["_rank"] for r in with_ranks(rows, directory, []).collect()}
    for g in (0, 1):
        own = sorted(v for i, v in enumerate(ids) if i % 2 == g)
        assert [got[f"={g}", v] for v in own] == list(range(len(own)))


def test_leaf_tells_fields_apart(spark):
    row = spark.createDataFrame([("1", "2:3"), ("1:2", "3"), (None, "-"), ("-", None)], "a string, b string")
    assert row.select(leaf_digest([F.col("a"), F.col("b")]).alias("d")).distinct().count() == 4
