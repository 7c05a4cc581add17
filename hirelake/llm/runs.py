"""Periodic runs in the words of a text, by internal pattern matching.

A run is a maximal stretch of words with smallest period q that is at least
``exponent`` periods long. Dyadic blocks of b = 1, 2, 4, ... words, one at every b/2
words, ask where they occur again in the window of b words after their start. In a
run of four periods or more with b/2 < q <= b lies a whole block whose next occurrence
is exactly q words on: occurrences of a block in its own neighbourhood form a
progression, and its step is the candidate period. Candidates are extended both ways
by longest common extensions, so every run is found once or more, and exactly.

Blocks are looked up by names: prefix doubling names all stretches of 2**k words in
their order, which also gives the suffix array. A block's occurrences are a range of
the suffix array, and the first one after a place is a range successor query of a
wavelet tree over it.

In a run every word but the last q occurs again within q words. So only stretches
of words that recur soon enough, as long as a run must be, are indexed at all.
"""

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Start, length and period in words.
Run = tuple[int, int, int]


class RangeSuccessor:
    """A wavelet tree (levels as one matrix) over numbers below ``n``."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for shift in range(self.bits - 1, -1, -1):
            one = (values >> shift & 1).astype(bool)
            ones = np.zeros(self.size + 1, np.int64)
            np.cumsum(one, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.size - int(ones[-1]))
            values = np.concatenate((values[~one], values[one]))

    def _levels(self) -> Iterator[tuple[int, np.ndarray, int]]:
        return zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True)

    def count_below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values lo to hi are below the bound (at most 2**bits)."""
        out = np.zeros(len(lo), np.int64)
        over = bound >> self.bits > 0
        full = hi - lo
        for shift, ones, zeros in self._levels():
            low, high = ones[lo], ones[hi]
            go = (bound >> shift & 1).astype(bool)
            out += np.where(go, (hi - high) - (lo - low), 0)
            lo, hi = np.where(go, zeros + low, lo - low), np.where(go, zeros + high, hi - high)
        return np.where(over, full, out)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values lo to hi."""
        out = np.zeros(len(lo), np.int64)
        for shift, ones, zeros in self._levels():
            low, high = ones[lo], ones[hi]
            left = (hi - high) - (lo - low)
            go = k >= left
            k = np.where(go, k - left, k)
            out |= go.astype(np.int64) << shift
            lo, hi = np.where(go, zeros + low, lo - low), np.where(go, zeros + high, hi - high)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest of the values lo to hi that is ``bound`` or more, -1 if none is."""
        below = self.count_below(lo, hi, bound)
        there = below < hi - lo
        out = np.full(len(lo), -1, np.int64)
        out[there] = self.smallest(lo[there], hi[there], below[there])
        return out


class BlockIndex:
    """Names of all stretches of 2**k words, the suffix array and its wavelet tree."""

    def __init__(self, ids: np.ndarray):
        self.n = n = len(ids)
        name = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
        self.names = [np.append(name, 0)]  # 0: the end of the text
        while int(name.max()) < n:
            step = 1 << (len(self.names) - 1)
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = name[step:]
            name = np.unique(name * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
            self.names.append(np.append(name, 0))
        suffixes = np.empty(n, np.int64)
        suffixes[name - 1] = np.arange(n)
        self.suffixes, self.tree = suffixes, RangeSuccessor(suffixes)

    def name(self, k: int) -> np.ndarray:
        return self.names[min(k, len(self.names) - 1)]

    def next_occurrence(self, at: np.ndarray, k: int) -> np.ndarray:
        """Where the 2**k words at each place occur next, -1 if nowhere."""
        ordered = self.name(k)[self.suffixes]
        mine = self.name(k)[at]
        return self.tree.successor(np.searchsorted(ordered, mine, "left"), np.searchsorted(ordered, mine, "right"), at + 1)

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch from a and from b on (a < b)."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            same = self.names[k][a] == self.names[k][b]
            step = same.astype(np.int64) << k
            a, b, out = a + step, b + step, out + step
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same up to a and up to b, both left out."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            may = a >= 1 << k
            same = may & (self.names[k][np.where(may, a - (1 << k), 0)] == self.names[k][np.where(may, b - (1 << k), 0)])
            step = same.astype(np.int64) << k
            a, b, out = a - step, b - step, out + step
        return out


def _gaps(ids: np.ndarray) -> np.ndarray:
    """Words until each word occurs again; the text's length and more if never."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), len(ids) + 1, np.int64)
    again = ids[order][1:] == ids[order][:-1]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def _stretches(marks: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(from, to) of the stretches of marks that are ``least`` long or longer."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


def find_runs(ids: np.ndarray, least: int = 6, exponent: int = 4) -> list[Run]:
    """All runs of a sequence of numbers, by start, then period: maximal stretches
    with smallest period q of ``max(least, exponent * q)`` words or more. ``exponent``
    is 4 or more."""
    if exponent < 4:
        raise ValueError("the blocks of a run of fewer than four periods may all miss its period")
    n, found = len(ids), set()
    if n < least:
        return []
    gaps = _gaps(ids)
    active: list[tuple[int, int, list]] = []  # (from, to, blocks) of what is indexed
    k = 0
    while exponent * ((1 << k) // 2 + 1) <= n:
        b = 1 << k
        q = b // 2 + 1  # the smallest period of this level
        near = _stretches(gaps <= b, max(least - b, (exponent - 1) * q))
        active += [(a, min(n, e + b), [(k, a, e)]) for a, e in near]
        k += 1
    active.sort(key=lambda x: x[:2])
    merged: list[tuple[int, int, list]] = []
    for a, e, blocks in active:
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]), merged[-1][2] + blocks)
        else:
            merged.append((a, e, blocks))
    for begin, end, blocks in merged:
        index = BlockIndex(ids[begin:end])
        for k, a, e in blocks:
            b, grid = 1 << k, max(1, (1 << k) // 2)
            at = np.arange(-(-(a - begin) // grid) * grid, min(e, end - b + 1) - begin, grid)
            nearest = index.next_occurrence(at, k)
            step = nearest - at
            good = (nearest >= 0) & (step <= b) & (step > b // 2)
            x, y, step = at[good], nearest[good], step[good]
            left = x - index.common_before(x, y)
            length = y + index.common_after(x, y) - left
            long = length >= np.maximum(least, exponent * step)
            found |= {(begin + s, m, p) for s, m, p in zip(left[long].tolist(), length[long].tolist(), step[long].tolist(), strict=True)}
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(n: int, runs: list[Run]) -> np.ndarray:
    """Marks of the words that stay: all but those of a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string"
)

#: From a document's id and its number of words: which words, by number, it consists
#: of; None for all of them in order.
Edit = Callable[[int | None, int], np.ndarray | None]


def periodic_runs(
    docs: DataFrame, edit: Edit | None = None, least: int = 6, exponent: int = 4, texts: bool = True
) -> DataFrame:
    """For every row its ``runs``, the strongest one (nulls without runs), the text
    ``collapsed`` to each run's first period with one space between words, and digests
    of both. ``texts=False`` leaves out the lists and texts (null).

    Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have none, nor do empty ones; rows
    stand for themselves, whatever their ids; other columns are ignored. Every text is
    looked at whole, in the task that reads it: nothing is shuffled.
    """
    names = [c.split()[0] for c in RUNS.split(", ")]
    kinds = [*[pa.int64()] * 6, pa.string(), pa.string(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string()]

    def row(doc_id: int | None, text: bytes) -> tuple:
        words = text.split()
        if edit and words and (chosen := edit(doc_id, len(words))) is not None:
            words = [words[i] for i in chosen.tolist()]
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        runs = find_runs(ids, least, exponent)
        best = strongest(runs)
        start, length, period = best or (None, None, None)
        milli = 1000 * length // period if best else None
        listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        if runs:
            words = [words[i] for i in np.flatnonzero(collapsed(len(words), runs)).tolist()]
        short = b" ".join(words)
        shown = ([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], short.decode()) if texts else (None, None)
        return (
            doc_id, len(runs), start, length, period, milli,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(short).hexdigest(), *shown,
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text").cast(pa.large_binary())
            for a in range(0, batch.num_rows, 256):
                rows = [row(ids[i].as_py(), column[i].as_py() or b"") for i in range(a, min(a + 256, batch.num_rows))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(find, RUNS)
