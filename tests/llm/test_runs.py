"""Periodic runs against every period and every stretch."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given as hypothesis_given
from hypothesis import settings
from hypothesis import strategies as st

from hirelake.llm.queries import QUERIES, planted_period
from hirelake.llm.runs import BlockIndex, RangeSuccessor, collapsed, find_runs, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            whole = words[s:e]
            if e - s >= max(least, exponent * q) and not any(whole[d:] == whole[:-d] for d in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def row(doc_id, text, edit=False):
    words = WORD.findall(text or "")
    if edit and words and (at := planted_period(doc_id, len(words))) is not None:
        words = [words[i] for i in at]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


def test_random_sequences():
    rng = random.Random(5)
    for _ in range(1200):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 4, 30])
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.7 and n > 5:
            a, p = rng.randrange(n), rng.randint(1, 9)
            for i in range(a, min(n, a + rng.randint(1, 60))):
                w[i] = w[a + (i - a) % p]
        for least, exponent in ((6, 4), (1, 4), (20, 4), (6, 5)):
            assert find_runs(np.array(w, np.int64), least, exponent) == brute(w, least, exponent)


@settings(max_examples=200, deadline=None)
@hypothesis_given(st.lists(st.integers(0, 3), max_size=12), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=12))
def test_powers(before, times, word):
    w = before + word * times + before
    assert find_runs(np.array(w, np.int64)) == brute(w)


def test_long_runs_of_long_periods():
    rng = np.random.default_rng(3)
    period = rng.integers(0, 50, 700)
    w = np.concatenate((rng.integers(0, 50, 333), np.tile(period, 5)[:-100], rng.integers(0, 50, 200)))
    assert any(q == 700 and m >= 3400 for _, m, q in find_runs(w))
    assert find_runs(np.zeros(5000, np.int64)) == [(0, 5000, 1)]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), 6, 3)


def test_range_successor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = RangeSuccessor(values)
        lo, hi, bound = rng.integers(0, n + 1, 200), rng.integers(0, n + 1, 200), rng.integers(0, n + 2, 200)
        lo, hi = np.minimum(lo, hi), np.maximum(lo, hi)
        want = [min([v for v in values[a:b] if v >= x], default=-1) for a, b, x in zip(lo, hi, bound, strict=True)]
        assert tree.successor(lo, hi, bound).tolist() == want


def test_next_occurrences_and_extensions():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 3, 120)
    index, text = BlockIndex(w), w.tolist()
    for k in range(4):
        at = np.arange(len(w) - (1 << k) + 1)
        block = [text[i : i + (1 << k)] for i in at]
        want = [next((j for j in at[i + 1 :] if block[j] == block[i]), -1) for i in at]
        assert index.next_occurrence(at, k).tolist() == want
    a, b = np.array([0, 3, 10, 50]), np.array([7, 119, 90, 51])
    after, before = index.common_after(a, b), index.common_before(a, b)
    for i, j, x, y in zip(a, b, after, before, strict=True):
        assert text[i : i + x] == text[j : j + x] and (j + x == len(w) or text[i + x] != text[j + x])
        assert text[i - y : i] == text[j - y : j] and (i - y == 0 or text[i - y - 1] != text[j - y - 1])


def test_collapsed():
    assert collapsed(8, [(1, 6, 1)]).tolist() == [True, True, *[False] * 5, True]
    assert collapsed(0, []).tolist() == []


def test_awkward_documents(documents, awkward):
    texts = [*awkward, "a b " * 9, "x a b c a b c a b c a b c y", "A a A a A a A a", "w x " * 7]
    docs = documents(texts, [None, *range(1, len(texts))])
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=str)
    assert [r[:8] for r in got] == sorted((row(i or None, t) for i, t in enumerate(texts)), key=str)
    assert all(hashlib.sha256(r[9].encode()).hexdigest() == r[7] and len(r[8]) == r[1] for r in got)
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query(spark, given):
    _, rows = given("documents")
    got = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [r for r in rows if len(r[1]) < 6000]
    want = {r[0]: row(r[0], r[1], edit=True) for r in small}
    found = {r[0]: tuple(r) for r in got.collect()}
    assert len(found) == len(rows) and all(found[k] == v for k, v in want.items())
    assert any(r[1] for r in want.values())
