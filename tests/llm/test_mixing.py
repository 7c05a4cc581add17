"""Mixing against its contract."""

import re
from collections import defaultdict

import pytest

from hirelake.llm.mixing import mix_sources


def targets(sizes, weights, share, most):
    """Water filling in Python."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: most * sizes[s] for s in full}
        left, open_ = left - sum(most * sizes[s] for s in full), open_ - full
    return out


def check(df, rows):
    got = mix_sources(df, (5, 2, 1), 1.5, 2).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for n, (_, _, s) in zip(size, rows, strict=True):
        sizes[s] += n
    want = targets(sizes, (5, 2, 1), 1.5, 2)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.epochs * r.size + r.cut
        taken[r.source] += r.taken
    assert sorted(r.size for r in got) == sorted(size)
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-6) or abs(taken[s] - want[s]) <= 1
    assert sum(want.values()) == pytest.approx(1.5 * sum(size))
    return got


def test_given_documents(given):
    df, rows = given("documents", "sf0.01")
    rows = [(r[0], r[1], r[3]) for r in rows]
    assert sorted(check(df, rows)) == sorted(check(df.repartition(7), rows))  # reruns agree


def test_hot_and_null_sources(documents, awkward):
    texts = awkward + ["some more words here"] * 30
    sources = [None, "b", "a"] * 4 + ["hot"] * 32
    check(documents(texts, sources=sources), list(zip(range(len(texts)), texts, sources, strict=True)))


def test_repeated_rows_and_empty_tables(documents):
    got = check(documents(["a b", "a b", "c"], [1, 1, None]), [(1, "a b", "a"), (1, "a b", "a"), (None, "c", "a")])
    assert len(got) == 3
    assert mix_sources(documents([])).count() == 0
    assert mix_sources(documents([None, ""])).agg({"taken": "sum"}).first()[0] == 0
