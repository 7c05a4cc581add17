"""The Jaccard join and the embedding join against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from hirelake.llm import hashing as H
from hirelake.llm.components import components
from hirelake.llm.parity import jaccard_components, offers, size_bands
from hirelake.llm.subspace import near_components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def expected(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = defaultdict(int)
    for ids in where.values():
        for a in ids:
            for b in ids:
                if a < b:
                    shared[a, b] += 1
    links = [
        (a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    parts = smallest_reachable(sets, links)
    return {i: (len(s), parts[i]) for i, s in sets.items()}


def joined(df, k, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k, percent).collect()}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_given_documents(given, k, percent):
    df, rows = given("documents")
    assert joined(df, k, percent) == expected([r[:2] for r in rows], k, percent)


def edits(seed):
    """Chains of texts of 1 to 300 words, each an edit of one before."""
    rnd = random.Random(seed)
    texts = []
    for size in (1, 2, 3, 5, 7, 9, 12, 15, 20, 30, 45, 70, 120, 300):
        words = [f"w{rnd.randrange(4000)}" for _ in range(size)]
        for _ in range(8):
            words = list(words)
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(words) + 1)
                words[at : at + rnd.randrange(2)] = [f"w{rnd.randrange(4000)}"] * rnd.randrange(2) or words[at : at + 1]
            texts.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(60))  # shared by many texts
    texts += [passage + " " + " ".join(f"w{rnd.randrange(4000)}" for _ in range(40)) for _ in range(30)]
    return texts


def test_edited_texts(documents):
    texts = edits(1)
    assert joined(documents(texts), 3, 80) == expected(list(enumerate(texts)), 3, 80)


def test_awkward_texts(documents, awkward):
    rows = list(enumerate(awkward))
    got = joined(documents(awkward), 4, 85)
    assert got == expected(rows, 4, 85)
    assert got[0] == (0, 0) and got[7][1] == 6


def test_repeated_rows_null_ids_and_empty_table(documents):
    df = documents(["a b c d e", "a b c d e", "a b c d e", "x"], [3, 3, None, None])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, 4, 85).collect()), key=str)
    assert got == [(3, 2, 3), (3, 2, 3), (None, 1, None), (None, 2, None)]
    assert jaccard_components(documents([]), 4, 85).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_every_linked_pair_shares_a_piece(percent):
    """Random pairs at the very limit, with and without crowded shingles."""
    rnd = np.random.default_rng(percent)
    for n in (1, 2, 5, 6, 9, 13, 20, 40, 100, 400):
        for share in (0.0, 0.5, 0.95):
            both = rnd.integers(0, 2**63, n, dtype=np.uint64)
            crowded = np.zeros(1 << 20, bool)
            crowded[(both[: int(share * n)] >> np.uint64(44)).astype(np.int64)] = True
            extra = [0, 0]
            while 100 * n >= percent * (n + sum(extra) + 1):
                extra[rnd.integers(2)] += 1
            sets = [np.unique(np.concatenate((both, rnd.integers(0, 2**63, e, dtype=np.uint64)))) for e in extra]
            begin = np.cumsum([0, *map(len, sets)])
            keys, row, need = offers(np.concatenate(sets), begin, percent, crowded)
            one, other = (dict(zip(keys[row == r].tolist(), need[row == r].tolist(), strict=True)) for r in (0, 1))
            common = one.keys() & other.keys()
            # under some seed they share as many pieces as either must
            kinds = {x & 2047 for x in (one[c] for c in common)}
            enough = [
                min(sum(of[c] & 2047 == kind for c in common) - max(of[c] >> 11 for c in common if of[c] & 2047 == kind) for of in (one, other))
                for kind in kinds
            ]
            assert enough and min(enough) >= 0, (n, share)


def test_sets_without_a_common_shingle_share_no_piece():
    """However many there are: chance must not make candidates."""
    rnd = np.random.default_rng(9)
    sets = [np.unique(rnd.integers(0, 2**63, 90, dtype=np.uint64)) for _ in range(600)]
    keys, row, _ = offers(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 80, np.zeros(1 << 20, bool))
    assert len(np.unique(keys)) == len(keys) and len(np.unique(row)) == 600


def test_a_slice_is_hashed_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["some words of a text " * 50] * 6000)
    tracemalloc.start()
    for _, data, offsets in H.slices(texts):
        H.shingle_sets(data, offsets, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


def test_bands_cover_all_sizes():
    bands = size_bands(10_000, 85)
    assert bands[0].low == 1 and all(a.high + 1 == b.low for a, b in zip(bands[:-1], bands[1:], strict=True))
    assert bands[-1].high >= 10_000


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    for _, data, offsets in H.slices(pa.array(["Ab  c", None, "c\tAB", ""])):
        words, first = H.words(data, offsets)
        assert first.tolist() == [0, 2, 2, 4, 4]
        assert words[0] == words[3] and words[1] == words[2]


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5, 5), (7, 9), (7, 9)]
    df = spark.createDataFrame(links, "u long, v long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = smallest_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, node long"


def cosine_links(rows, cosine):
    fine = [
        (i, np.array(v, np.float64)) for i, v in rows
        if v and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)
    ]
    links = []
    for k, (i, a) in enumerate(fine):
        for j, b in fine[:k]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links.append((i, j))
    return links


def check_vectors(spark, rows, cosine=0.9, **options):
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_components(df, cosine, **options).collect()}
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    links = cosine_links(rows, cosine)
    parts = smallest_reachable([i for i, _ in rows], links)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert got == {i: (count[i], parts[i], parts[i] == i) for i, _ in rows}
    return len(links)


def clusters(seed, n, dims):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dims))
    x = centres[rnd.integers(12, size=n)] + rnd.normal(size=(n, dims)) * rnd.choice([0.05, 0.3, 1.0], size=(n, 1))
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("options", [{}, {"tile": 20}, {"block": 4, "grid": 1}])
def test_clustered_vectors(spark, options):
    rows = clusters(3, 300, 16)
    rows += [(1000 + i, rows[5][1]) for i in range(4)]  # copies
    assert check_vectors(spark, rows, **options) > 500


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    check_vectors(
        spark,
        [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
         (8, [3.0, 0.0]), (9, [1.0]), (10, [2.0]), (11, [-1.0, 0.0]), (12, [1.0, 0.1])],
    )


def test_empty_vectors_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 1, 0), (None, [1.0, 2.0], 1, 0), (3, [1.0, 2.0], 1, 0)], VECTORS)
    got = sorted((tuple(r) for r in near_components(df).collect()), key=str)
    assert got == [(3, 0, 3, True), (None, 0, None, False), (None, 0, None, False)]
    assert near_components(df.limit(0)).count() == 0


def test_given_vectors(given):
    df, rows = given("embeddings")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_components(df, 0.5).collect()}
    links = cosine_links([r[:2] for r in rows], 0.5)
    parts = smallest_reachable([r[0] for r in rows], links)
    assert {i: c for i, (_, c) in got.items()} == parts
    assert sum(n for n, _ in got.values()) == 2 * len(links)


def test_groups_cut_into_parts(documents, monkeypatch):
    """Groups of more than two texts in blocks, in parts of three at home."""
    monkeypatch.setattr("hirelake.llm.parity._SMALL", 2)
    monkeypatch.setattr("hirelake.llm.parity._TILE", 3)
    texts = edits(7)
    assert joined(documents(texts), 3, 80) == expected(list(enumerate(texts)), 3, 80)
