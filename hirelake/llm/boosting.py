"""Quality rules: gradient-boosted trees over statistics of documents.

Two fixed rules fail a document outright. A model of boosted regression trees,
fitted on a bounded sample of labelled documents, judges the others by counts and
shares that say how a text is made. Chosen statistics may only push the score one
way: more repeated words, repeated lines or symbols never make a document better.

Trees are grown level by level on binned statistics, by second-order gains. A split
on a constrained statistic counts only if its two values stand in the right order,
and the middle between them bounds all values below. The fitted trees are flattened
into arrays of nodes, all trees behind one another; a leaf leads to itself, so scoring
is as many gathers as the trees are deep, for all rows and trees at once.
"""

import math
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.scratch import materialise

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WINDOW = 3

#: Counts of a document, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that the trees see, and which way each may push the score (0: any).
STATISTICS = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "letter_share": 0, "upper_share": 0, "digit_share": 0, "mark_share": 0,
    "words_a_line": 0, "longest_word": 0, "repeated_next": -1, "no_ascii_share": 0,
}


def repeated_words(ids: np.ndarray, window: int = _WINDOW) -> int:
    """Words that lie in a window found twice or more in the sequence."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n].copy()
    for j in range(1, window):  # names of ever longer windows stay below n
        key = np.unique(key * (len(ids) + 1) + ids[j : n + j], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += again
    edges[window : n + window] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """Counts and statistics of a text in UTF-8."""
    data = np.frombuffer(text, np.uint8)
    starts = (data & 0xC0) != 0x80  # a byte for each code point
    words = text.split()
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    chars = int((starts & ~_SPACE[data]).sum())
    symbols = int(_SYMBOL[data].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    n = len(words)
    repeated = repeated_words(ids)
    kinds = np.bincount(data, minlength=256)
    upper, lower, digits = int(kinds[65:91].sum()), int(kinds[97:123].sum()), int(kinds[48:58].sum())
    marks = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
    some, many = max(chars, 1), max(n, 1)
    following = int((ids[1:] == ids[:-1]).sum())
    statistics = [
        math.log1p(n), chars / many, symbols / some, dup_lines / max(len(lines), 1), repeated / many,
        len(known) / many, (upper + lower) / some, upper / max(upper + lower, 1), digits / some, marks / some,
        n / max(len(lines), 1), max(map(len, words), default=0), following / many, int(kinds[192:].sum()) / some,
    ]
    return [n, chars, symbols, dup_lines, repeated], statistics


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


# --- trees ------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees. A leaf's children are itself."""

    feature: np.ndarray
    limit: np.ndarray  # rows up to it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row; missing statistics count as the largest."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go = x[rows, self.feature[node]] <= self.limit[node]
            node = np.where(go, self.left[node], self.right[node])
        return self.bias + self.value[node].sum(1)


class _Grower:
    """Grows one tree after another over the same binned rows."""

    def __init__(self, x: np.ndarray, monotonic: Sequence[int], bins: int, depth: int, rate: float, ridge: float, least: float):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
        self.bins = max(len(e) for e in self.edges) + 1
        self.binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)
        self.monotonic, self.depth, self.rate, self.ridge, self.least = monotonic, depth, rate, ridge, least
        self.nodes: list[list] = []  # feature, limit, left, right, value
        self.roots: list[int] = []

    def _value(self, g: np.ndarray, h: np.ndarray, low: float, high: float) -> np.ndarray:
        return np.clip(-g / (h + self.ridge), low, high)

    def _best(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float) -> tuple | None:
        """(gain, feature, bin, left value, right value) of the best split."""
        n_features = self.binned.shape[1]
        place = self.binned[rows] + np.arange(n_features) * self.bins
        size = n_features * self.bins
        gs, hs = (
            np.cumsum(np.bincount(place.ravel(), np.repeat(w[rows], n_features), size).reshape(n_features, -1), axis=1)
            for w in (g, h)
        )
        g_all, h_all = g[rows].sum(), h[rows].sum()
        gl, hl = gs[:, :-1], hs[:, :-1]
        gr, hr = g_all - gl, h_all - hl
        vl, vr = self._value(gl, hl, low, high), self._value(gr, hr, low, high)
        lost = lambda gg, hh, v: gg * v + 0.5 * (hh + self.ridge) * v**2
        own = self._value(g_all, h_all, low, high)
        gain = lost(g_all, h_all, own) - lost(gl, hl, vl) - lost(gr, hr, vr)
        way = np.asarray(self.monotonic)[:, None]
        ok = (hl >= self.least) & (hr >= self.least) & (way * (vr - vl) >= 0)
        gain = np.where(ok, gain, -np.inf)
        f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        return (float(gain[f, b]), int(f), int(b), float(vl[f, b]), float(vr[f, b])) if gain[f, b] > 1e-9 else None

    def add(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One more tree for gradients and curvatures; its value for each row."""
        out = np.zeros(len(g))

        def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
            me = len(self.nodes)
            value = float(self._value(g[rows].sum(), h[rows].sum(), low, high)) * self.rate
            self.nodes.append([0, 0.0, me, me, value])
            split = self._best(rows, g, h, low, high) if depth < self.depth else None
            if split is None:
                out[rows] = value
                return me
            _, f, b, vl, vr = split
            middle, way = (vl + vr) / 2, self.monotonic[f]
            left_high, right_low = (middle, middle) if way > 0 else (high, low)
            left_low, right_high = (middle, middle) if way < 0 else (low, high)
            go = self.binned[rows, f] <= b
            left = grow(rows[go], depth + 1, left_low, left_high)
            right = grow(rows[~go], depth + 1, right_low, right_high)
            self.nodes[me] = [f, float(self.edges[f][b]), left, right, 0.0]
            return me

        self.roots.append(grow(np.arange(len(g)), 0, -np.inf, np.inf))
        return out

    def forest(self, bias: float) -> Forest:
        columns = list(zip(*self.nodes, strict=True))
        kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
        return Forest(*[np.array(c, k) for c, k in zip(columns, kinds, strict=True)], np.array(self.roots), self.depth, bias)


def fit_forest(
    x: np.ndarray, y: np.ndarray, monotonic: Sequence[int], trees: int = 80, depth: int = 3,
    bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 2.0,
) -> Forest:
    """Boosted trees for labels 0 and 1. Both classes weigh the same. The score
    never falls with a statistic marked 1 and never rises with one marked -1."""
    good = y > 0.5
    weight = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1)) * len(y)
    grower, z = _Grower(x, monotonic, bins, depth, rate, ridge, least), np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        z += grower.add(weight * (p - good), np.maximum(weight * p * (1 - p), 1e-12))
    return grower.forest(0.0)


@dataclass(frozen=True)
class Rules:
    """The trees, the score from which documents are kept, and their accuracy on
    documents that no tree has seen."""

    forest: Forest
    threshold: float
    accuracy: float


def fit_rules(x: np.ndarray, y: np.ndarray, most_lost: float = 0.002, **options: float) -> Rules:
    """Fit on rows in a random order. One row in four of each class is held out for
    the threshold: it lets through all but ``most_lost`` of the held-out good rows and
    is a log odds of 0 at most. A class of one row is both trained on and held out."""
    classes = [np.flatnonzero(y == k) for k in (0, 1)]
    held = np.sort(np.concatenate([c[::4] for c in classes]))
    train = np.sort(np.concatenate([np.setdiff1d(c, c[::4]) if len(c) > 1 else c for c in classes]))
    forest = fit_forest(x[train], y[train], list(STATISTICS.values()), **options)
    z = forest.score(x[held])
    good = np.sort(z[y[held] == 1])
    return Rules(forest, float(min(0.0, good[int(most_lost * len(good))])), float(((z >= 0) == (y[held] == 1)).mean()))


# --- in Spark ---------------------------------------------------------------

_MEASURES = ", ".join([f"{c} long" for c in COUNTS] + ["x binary"])


def _measured(docs: DataFrame, keep: str) -> DataFrame:
    """``keep`` (name and type), the counts, and the statistics as numbers of 64 bits."""
    name = keep.split()[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name, *COUNTS, "x"]
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for a in range(0, batch.num_rows, 256):
                part = texts.slice(a, 256)
                found = [measure(t.as_py() or b"") for t in part]
                counts = [pa.array(c, pa.int64()) for c in zip(*[f[0] for f in found], strict=True)]
                x = pa.array([np.array(f[1]).tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(name).slice(a, len(found)), *counts, x], names)

    return docs.select(name, "text").mapInArrow(rows, f"{keep}, {_MEASURES}")


def train_rules(
    docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = 6000, seed: int = 13, **options: float
) -> Rules | None:
    """Fit on ``labelled`` labelled documents at most that pass the fixed rules: of each
    class those with the smallest hashes of their ids, half of them from each class,
    more from one if the other has fewer. Null labels are no labels, a document with
    several labels counts as the worst; of rows that repeat an id the first by text
    counts. None, with a warning, if a class has no such document."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("_y"))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    known = materialise(ids.join(marks, "doc_id"), "labelled")
    key = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    sizes = [min(labelled, known.where(F.col("_y") == y).count()) for y in (0, 1)]
    parts = [
        known.where(F.col("_y") == y).orderBy(*key).limit(min(sizes[y], max(labelled // 2, labelled - sizes[1 - y])))
        for y in (0, 1)
    ]
    chosen = materialise(parts[0].unionByName(parts[1]), "rules-sample").select(F.col("doc_id").alias("_id"), "_y")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # labelled rows at most
    rows = rows.groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
    rows = rows.select(F.struct("doc_id", "_y").alias("_of"), "text")
    got = _measured(rows, "_of struct<doc_id:bigint,_y:int>").orderBy("_of.doc_id").toArrow()
    passed = [i for i, r in enumerate(zip(got["n_words"].to_pylist(), got["n_repeat_words"].to_pylist(), strict=True)) if not base_failed(*r)]
    y = np.array([r["_y"] for r in got["_of"].to_pylist()], np.int64)[passed]
    if len(set(y.tolist())) < 2:
        warnings.warn("no quality rules: the labels of the documents lack a class", stacklevel=2)
        return None
    x = np.stack([np.frombuffer(b, np.float64) for b in got["x"].to_pylist()])[passed]
    order = np.random.default_rng(seed).permutation(len(y))
    return fit_rules(x[order], y[order], **options)


def judge_documents(docs: DataFrame, rules: Rules | None) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``score`` (log odds, null for
    documents that fail the fixed rules) of every row. A null text counts as empty,
    which fails; without a model all that passes the fixed rules is kept. Every row
    stands for itself, other columns are ignored."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *COUNTS, "base_failed", "kept", "score"]
        for batch in batches:
            counts = [batch.column(c) for c in COUNTS]
            n, repeated = counts[0].to_numpy(), counts[4].to_numpy()
            failed = (n < 50) | (100 * repeated > 50 * n)
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(-1, len(STATISTICS))
            z = rules.forest.score(x) if rules else np.zeros(len(n))
            kept = ~failed & (z >= (rules.threshold if rules else 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(failed), pa.array(kept), pa.array(z, mask=failed)], names
            )

    counted = ", ".join(f"{c} long" for c in COUNTS)
    return _measured(docs, "doc_id long").mapInArrow(
        judge, f"doc_id long, {counted}, base_failed boolean, kept boolean, score double"
    )
