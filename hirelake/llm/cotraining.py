"""Quality classifier by co-training of two views.

One logistic model sees a document's text, the other its metadata (source,
language, length). Both start from a bounded sample of labelled documents, drawn by
class. In each round either model scores all unlabelled documents, and hands those
of which its calibrated probability is the most confident to the other model as
training rows. In the end both are calibrated on held-out labels and combined by a third
logistic model; a threshold that loses few good held-out documents decides.

The sample and what is handed over have fixed sizes, so the driver trains on as much
whatever the corpus; a round and the final scoring are one pass over the documents each.
"""

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import hashing as H
from hirelake.scratch import materialise

_WORDS, _META = 512, 128
_SHAPE = 8


def content_features(texts: pa.Array) -> np.ndarray:
    """A row for each text (null: empty): shares of bytes and of hashed words, and
    of repeated, long, upper-case, marked words."""
    rows = []
    for _, data, offsets in H.slices(texts):
        n = len(offsets) - 1
        row_of = np.repeat(np.arange(n), np.diff(offsets))
        size = np.maximum(np.diff(offsets), 1)[:, None]
        chars = np.bincount(row_of * 256 + data, minlength=n * 256).reshape(n, 256) / size
        words, first = H.words(data, offsets)
        count = np.diff(first)
        word_row = np.repeat(np.arange(n), count)
        some = np.maximum(count, 1)
        hashed = np.bincount(
            word_row * _WORDS + (words % H.U64(_WORDS)).astype(np.int64), minlength=n * _WORDS
        ).reshape(n, _WORDS) / some[:, None]
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
        different = np.diff(H.distinct(words, first)[1])
        upper = chars[:, 65:91].sum(1)
        lower = chars[:, 97:123].sum(1)
        shape = np.stack(
            [
                np.bincount(word_row[same], minlength=n) / some,
                different / some,
                np.log1p(count) / 10,
                size[:, 0] / some / 20,
                upper / np.maximum(upper + lower, 1e-9),
                lower,
                chars[:, 33:48].sum(1) + chars[:, 58:65].sum(1) + chars[:, 91:97].sum(1) + chars[:, 123:127].sum(1),
                chars[:, 48:58].sum(1),
            ],
            axis=1,
        )
        rows.append(np.concatenate((np.sqrt(chars), np.sqrt(hashed), shape), axis=1))
    return np.concatenate(rows).astype(np.float32) if rows else np.zeros((0, 256 + _WORDS + _SHAPE), np.float32)


def metadata_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """A row for each document: hashed source and language, and its length."""
    n = len(source)
    out = np.zeros((n, _META + 2), np.float32)
    for salt, column in enumerate((source, lang)):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = pa.array([f"{salt}:{x}" for x in column.to_pylist()], pa.string())
        for row, data, offsets in H.slices(column):
            words, first = H.words(data, offsets)
            whole = H.mix(H.row_sums(H.mix(words + np.arange(len(words), dtype=H.U64) - first[:-1].astype(H.U64).repeat(np.diff(first))), first))
            out[np.arange(row, row + len(whole)), (whole % H.U64(_META)).astype(np.int64)] = 1
    size = n_chars.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
    out[:, -2] = np.log1p(np.maximum(size, 0)) / 10
    out[:, -1] = out[:, -2] ** 2
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) * self.scale) @ self.weights + self.bias


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 300) -> Logistic:
    """Regularised logistic regression by accelerated gradient descent from zero;
    features are scaled by their spread. Both classes weigh the same."""
    x = x.astype(np.float64)
    mean, spread = x.mean(0), x.std(0)
    scale = np.where(spread > 1e-7, 1 / np.maximum(spread, 1e-7), 0.0) / np.sqrt(max(1, x.shape[1]))
    z = (x - mean) * scale
    share = np.where(y > 0.5, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    rate = 1 / (0.25 * float((share * (z**2).sum(1)).sum()) + 0.25 + penalty)
    w = v = np.zeros(x.shape[1])
    b = c = 0.0
    for k in range(steps):
        g = share * (_sigmoid(z @ v + c) - y)
        w_next, b_next = v - rate * (z.T @ g + penalty * v), c - rate * g.sum()
        push = k / (k + 3)
        v, c = w_next + push * (w_next - w), b_next + push * (b_next - b)
        w, b = w_next, b_next
    return Logistic(mean, scale, w, float(b))


@dataclass(frozen=True)
class CoTrained:
    """Calibrated views, their combination and the threshold of its score."""

    content: Logistic
    metadata: Logistic
    combination: Logistic
    threshold: float
    accuracy: float  # on labels held out of training, calibration not

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        views = np.stack([self.content.logit(content), self.metadata.logit(metadata)], axis=1)
        return _sigmoid(self.combination.logit(views))


@dataclass(frozen=True)
class Judge:
    """A view's model and its calibration."""

    model: Logistic
    calibrated: Logistic

    def good(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.calibrated.logit(self.model.logit(x)[:, None]))


#: From the judges of both views, the least confidence and a number: for (view,
#: answer) the other view's features of the most confident rows, that many at most,
#: none of which the other view has been given before.
Offers = Callable[[list[Judge], float, int], dict[tuple[int, int], np.ndarray]]


def _offers_of_arrays(views: tuple[np.ndarray, np.ndarray]) -> Offers:
    free = [np.ones(len(views[0]), bool), np.ones(len(views[0]), bool)]  # not yet given to view i

    def offers(judges: list[Judge], confident: float, most: int) -> dict[tuple[int, int], np.ndarray]:
        out = {}
        for i in (0, 1):
            p = judges[i].good(views[i])
            for answer, sure in ((1, p), (0, 1 - p)):
                may = np.flatnonzero(free[1 - i] & (sure >= confident))
                take = may[np.argsort(-sure[may], kind="stable")[:most]]
                free[1 - i][take] = False
                out[i, answer] = views[1 - i][take]
        return out

    return offers


def co_train(
    content: np.ndarray, metadata: np.ndarray, label: np.ndarray, rounds: int = 3,
    confident: float = 0.97, exchange: int = 500, most_lost: float = 0.002, offers: Offers | None = None,
) -> CoTrained | None:
    """Train on rows with label 0 or 1, in the given (random) order, and on what
    ``offers`` has, by default a pool of the rows with label -1; None if a class is
    absent. Of each class one row in four is held out for calibration, combination
    and the threshold, which lets through all but ``most_lost`` of the held-out good
    rows and is 0.5 at most. A class of one row is both trained on and held out."""
    classes = [np.flatnonzero(label == y) for y in (0, 1)]
    if not all(map(len, classes)):
        return None
    held = np.sort(np.concatenate([c[::4] for c in classes]))
    train = np.sort(np.concatenate([np.setdiff1d(c, c[::4]) if len(c) > 1 else c for c in classes]))
    views = (content, metadata)
    offers = offers or _offers_of_arrays((content[label < 0], metadata[label < 0]))
    rows = [v[train] for v in views]
    answers = [label[train].astype(float)] * 2
    models: list[Logistic] = []
    for round_ in range(rounds + 1):
        models = [fit_logistic(rows[i], answers[i]) for i in (0, 1)]
        if round_ == rounds:
            break
        judges = [
            Judge(m, fit_logistic(m.logit(v[held])[:, None], label[held].astype(float), 1e-4))
            for m, v in zip(models, views, strict=True)
        ]
        given = offers(judges, confident, exchange // 2)
        if not any(map(len, given.values())):
            break
        for (i, answer), x in given.items():  # view i teaches the other one
            rows[1 - i] = np.concatenate((rows[1 - i], x))
            answers[1 - i] = np.concatenate((answers[1 - i], np.full(len(x), float(answer))))
    stacked = np.stack([m.logit(v[held]) for m, v in zip(models, views, strict=True)], axis=1)
    combination = fit_logistic(stacked, label[held].astype(float), 1e-4)
    p = _sigmoid(combination.logit(stacked))
    good = np.sort(p[label[held] == 1])
    threshold = float(min(0.5, good[int(most_lost * len(good))]))
    return CoTrained(models[0], models[1], combination, threshold, float(((p >= 0.5) == label[held]).mean()))


def _features(rows: DataFrame, more: str) -> pa.Table:
    """``doc_id``, both views and the columns ``more`` (names and types) of few rows."""
    names = [c.split()[0] for c in more.split(", ")]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = (pa.array([r.tobytes() for r in v], pa.binary()) for v in _views(batch))
            given = [batch.column(c) for c in ("doc_id", *names)]
            yield pa.RecordBatch.from_arrays([*given, x, m], ["doc_id", *names, "x", "m"])

    return rows.mapInArrow(features, f"doc_id long, {more}, x binary, m binary").toArrow()


def _matrix(got: pa.Table, column: str) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.float32) for b in got.column(column).to_pylist()])


def _offers_of_table(docs: DataFrame, marks: DataFrame, seed: int) -> Offers:
    """Over all rows of ``docs`` whose id is not in ``marks``. Only ids and
    confidences are joined; texts are read again for the few rows that are taken.
    Of an id that is taken, the first row by its other columns counts."""
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars").where(F.col("doc_id").isNotNull())
    taken = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # ids given to view i

    def offers(judges: list[Judge], confident: float, most: int) -> dict[tuple[int, int], np.ndarray]:
        gone = list(taken)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 512):
                    part = batch.slice(a, 512)
                    ids, views = part.column("doc_id").to_numpy(), _views(part)
                    for i in (0, 1):
                        p, free = judges[i].good(views[i]), ~np.isin(ids, gone[1 - i])
                        for answer, sure in ((1, p), (0, 1 - p)):
                            may = free & (sure >= confident)
                            kind = np.full(may.sum(), 2 * i + answer, np.int32)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(ids[may]), pa.array(kind), pa.array(sure[may])], ["doc_id", "kind", "sure"]
                            )

        sure = rows.mapInArrow(judge, "doc_id long, kind int, sure double")
        sure = sure.groupBy("doc_id", "kind").agg(F.max("sure").alias("sure")).join(marks, "doc_id", "left_anti")
        sure = materialise(sure, "sure")
        order = [F.desc("sure"), F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
        best = [sure.where(F.col("kind") == k).orderBy(*order).limit(most) for k in range(4)]
        best = materialise(reduce(DataFrame.unionByName, best), "best").select(F.col("doc_id").alias("_id"), "kind")
        found = rows.join(F.broadcast(best), F.col("doc_id") == F.col("_id"))
        found = found.groupBy("doc_id", "kind").agg(F.min(F.struct("text", "source", "lang", "n_chars")).alias("_r"))
        got = _features(found.select("doc_id", "kind", "_r.*"), "kind int").sort_by("doc_id")
        out = {}
        for i, answer in ((0, 1), (0, 0), (1, 1), (1, 0)):
            mine = got.filter(pc.equal(got.column("kind"), 2 * i + answer))
            if mine.num_rows:
                taken[1 - i] = np.union1d(taken[1 - i], mine.column("doc_id").to_numpy())
                out[i, answer] = _matrix(mine, "x" if i else "m")
        return out

    return offers


def train_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = 6000,
    seed: int = 9, **options: float,
) -> CoTrained | None:
    """Fit on ``labelled`` labelled documents at most, those of each class with the
    smallest hashes of their ids: half of them from each class, more from one if the
    other has fewer. Every round looks at all unlabelled documents. Null labels are
    no labels; a document labelled more than once counts as its worst label. None,
    with a warning, only if no document of a class is labelled at all."""
    key = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("_y"))
    marks = materialise(marks, "marks")
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    known = materialise(ids.join(marks, "doc_id"), "known")
    of = [known.where(F.col("_y") == y).orderBy(*key) for y in (0, 1)]
    sizes = [min(labelled, known.where(F.col("_y") == y).count()) for y in (0, 1)]
    if not all(sizes):
        warnings.warn("no quality classifier: the labels of the documents lack a class", stacklevel=2)
        return None
    half = labelled // 2
    of = [of[y].limit(min(sizes[y], max(half, labelled - sizes[1 - y]))) for y in (0, 1)]
    chosen = materialise(of[0].unionByName(of[1]).select(F.col("doc_id").alias("_id"), "_y"), "sample")
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars")
    sample = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # labelled rows at most
    got = _features(sample, "_y int")
    ids_ = np.array(got.column("doc_id").to_pylist(), np.int64).astype(np.uint64)
    order = np.lexsort((ids_, H.mix(ids_ + H.U64(seed))))  # a random order that every run repeats
    x, m = _matrix(got, "x")[order], _matrix(got, "m")[order]
    y = np.array(got.column("_y").to_pylist())[order]
    return co_train(x, m, y, offers=_offers_of_table(docs, marks, seed), **options)


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return content_features(batch.column("text")), metadata_features(
        batch.column("source"), batch.column("lang"), batch.column("n_chars")
    )


def _scores(batch: pa.RecordBatch, model: CoTrained | None) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, scores) of consecutive rows; 1 without a model."""
    for a in range(0, batch.num_rows, 512):
        part = batch.slice(a, 512)
        yield a, np.ones(part.num_rows) if model is None else model.score(*_views(part))


def score_documents(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """(``doc_id``, ``score``, ``quality``) of every row: the probability that the
    document is good, and whether it is kept (1) or rejected (0). Null texts count
    as empty, null metadata as a value of its own; without a model all is kept.
    Other columns are ignored."""
    limit = model.threshold if model else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, p in _scores(batch, model):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, len(p)), pa.array(p), pa.array((p >= limit).astype(np.int32))],
                    ["doc_id", "score", "quality"],
                )

    rows = docs.select("doc_id", "text", "source", "lang", "n_chars")
    return rows.mapInArrow(score, "doc_id long, score double, quality int")


def keep_good(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    limit = model.threshold if model else 0.0

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, p in _scores(batch, model):
                yield batch.slice(a, len(p)).filter(pa.array(p >= limit))

    return docs.mapInArrow(keep, docs.schema)
