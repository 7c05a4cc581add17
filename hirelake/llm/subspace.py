"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors of cosine ``c`` or more lie within a squared distance of
``2 - 2 c``. The vectors are rotated to their principal axes, which are dealt out
into blocks of few dimensions, and every block gets a part of the squared distance
in proportion to its variance: two vectors within the whole budget are within the
part of at least one block. Each block is joined by range, on a grid over its
leading axes with cells as wide as the block's radius, and every candidate of any
block is verified by the exact cosine in double precision.

No pair leaves its task. A pair belongs to the first block in which it is near and
is counted there; tasks return counts and, for the components, a spanning forest
of their links, which is no longer than their vectors.
"""

import json
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.components import components
from hirelake.scratch import materialise

_SLACK = 1e-9  # of squared distances, far above rounding


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, column: str) -> "F.Column":
    """Whether a vector has a direction: none of its components is null or not
    finite, and not all are zero."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


class Rotation:
    """Orthogonal axes dealt out into blocks, with each block's radius and the
    grid over its first axes."""

    def __init__(self, axes: np.ndarray, spread: np.ndarray, block: int, grid: int, cosine: float):
        dims = len(spread)
        n = max(1, -(-dims // block))
        self.axes = axes
        self.blocks = [np.arange(b, dims, n) for b in range(n)]  # leading axes first
        share = np.array([spread[b].sum() for b in self.blocks]) + 1e-12
        self.budget = (2 - 2 * cosine) * share / share.sum() + _SLACK
        self.grid = grid

    def turn(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.axes

    def cells(self, turned: np.ndarray, b: int) -> np.ndarray:
        at = turned[:, self.blocks[b][: self.grid]]
        return np.floor(at / np.sqrt(self.budget[b] + _SLACK)).astype(np.int64)


def fit_rotation(spread_of: DataFrame, dims: int, block: int, grid: int, cosine: float) -> Rotation:
    """Principal axes from the sums and cross products of all unit vectors; what
    reaches the driver has a fixed size, ``dims`` squared numbers for a task."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, cross = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column("v"))
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            n, total, cross = n + len(x), total + x.sum(0), cross + x.T @ x
        flat = np.concatenate(([n], total, cross.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "x"])

    sums = spread_of.select("v").mapInArrow(moments, "at long, x double")
    flat = np.array([r[1] for r in sorted(sums.groupBy("at").agg(F.sum("x")).collect())])
    n, mean = flat[0], flat[1 : dims + 1] / max(flat[0], 1)
    cov = flat[dims + 1 :].reshape(dims, dims) / max(n, 1) - np.outer(mean, mean)
    spread, axes = np.linalg.eigh((cov + cov.T) / 2)
    return Rotation(axes[:, ::-1], np.maximum(spread[::-1], 0), block, grid, cosine)


def _root(parent: dict[int, int], x: int) -> int:
    parent.setdefault(x, x)
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


class _Tile:
    """The vectors at home in one part of a cell, against all that visit it."""

    def __init__(self, rotation: Rotation, block: int, cosine: float):
        self.r, self.b, self.cosine = rotation, block, cosine

    def start(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.copies, self.x = ids, copies, x
        self.unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.turned = self.r.turn(x)
        self.links = np.zeros(len(ids), np.int64)
        self.forest: dict[int, int] = {}

    def _join(self, a: int, b: int) -> bool:
        """Whether a link joins two trees of the forest."""
        a, b = _root(self.forest, a), _root(self.forest, b)
        self.forest[max(a, b)] = min(a, b)
        return a != b

    def visit(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, home: bool) -> tuple:
        """Links of the visitors, and new edges of the forest."""
        unit, turned = x / np.linalg.norm(x, axis=1, keepdims=True), self.r.turn(x)
        block, edges, counts = self.r.blocks[self.b], [], np.zeros(len(ids), np.int64)
        near = self.r.budget[self.b]
        own = self.turned[:, block]
        size = (own**2).sum(1)
        for a in range(0, len(ids), 512):
            other = turned[a : a + 512][:, block]
            d = (other**2).sum(1)[:, None] + size - 2 * other @ own.T
            v, h = np.nonzero(d <= near + _SLACK)  # sums in another order than below
            v = v + a
            if home:
                v, h = v[h > v], h[h > v]
            for s in range(0, len(v), 1 << 16):
                i, j = v[s : s + (1 << 16)], h[s : s + (1 << 16)]
                ok = (unit[i] * self.unit[j]).sum(1) >= self.cosine
                i, j = i[ok], j[ok]
                diff = turned[i] - self.turned[j]
                first = (diff[:, block] ** 2).sum(1) <= near
                for b in range(self.b):
                    first &= (diff[:, self.r.blocks[b]] ** 2).sum(1) > self.r.budget[b]
                i, j = i[first], j[first]
                np.add.at(counts, i, self.copies[j])
                np.add.at(self.links, j, copies[i])
                for p, q in zip(ids[i].tolist(), self.ids[j].tolist(), strict=True):
                    if self._join(p, q):
                        edges.append((p, q))
        return counts, edges


def near_components(
    vectors: DataFrame, cosine: float = 0.9, block: int = 8, grid: int = 2, tile: int = 8192
) -> DataFrame:
    """(``vec_id``, ``n_links``, ``component_id``, ``kept``) of every row.

    Two vectors of the same length are linked if their cosine reaches ``cosine``.
    Rows whose vector is null, empty, zero or holds a null or non-finite number
    link with nothing, nor do rows without a ``vec_id`` (no component, not kept).
    Equal vectors count as one up to the result. A cell with more than ``tile``
    vectors is cut into parts that meet each other in turn, so no task holds more
    than a part; visitors stream past it. Labels and other columns are ignored.
    """
    rows = vectors.select(
        "vec_id",
        F.when(usable(vectors, "embedding") & F.col("vec_id").isNotNull(), F.col("embedding")).alias("v"),
    )
    rows = rows.withColumn("d", F.size("v"))
    fine = rows.where(F.col("v").isNotNull())
    distinct = materialise(
        fine.groupBy("v", "d").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    counts, edges = None, None
    for (dims,) in distinct.select("d").distinct().orderBy("d").collect():  # lengths of vectors, commonly one
        c, e = _one_length(distinct.where(F.col("d") == dims), dims, cosine, block, grid, tile)
        counts = c if counts is None else counts.union(c)
        edges = e if edges is None else edges.union(e)
    if counts is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    parts = components(edges)
    known = distinct.join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left").join(parts, "node", "left")
    known = known.select(
        F.col("v").alias("_v"), F.coalesce("component", "node").alias("component_id"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return rows.join(known, F.col("v") == F.col("_v"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def _one_length(
    distinct: DataFrame, dims: int, cosine: float, block: int, grid: int, tile: int
) -> tuple[DataFrame, DataFrame]:
    rotation = fit_rotation(distinct, dims, block, grid, cosine)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = rotation.turn(_matrix(pa.array(batch["v"])))
            for b in range(len(rotation.blocks)):
                c = rotation.cells(turned, b)
                yield pd.DataFrame({"b": b, "cell": [json.dumps(x) for x in c.tolist()]})

    # a unit vector's coordinates span (2 / radius) ** grid cells a block at most
    sizes = {
        (b, tuple(json.loads(c))): n
        for b, c, n in distinct.select("v").mapInPandas(cells, "b int, cell string").groupBy("b", "cell").count().collect()
    }
    parts = {k: -(-n // tile) for k, n in sizes.items()}
    number = {k: i for i, k in enumerate(sorted(parts))}
    ahead = [s for s in product((-1, 0, 1), repeat=min(grid, dims)) if s > (0,) * min(grid, dims)]
    most = max(parts.values(), default=1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to its home, and as a visitor to the later parts of its
        cell and to all parts of the cells behind it."""
        for batch in batches:
            turned = rotation.turn(_matrix(batch.column("v")))
            nodes = batch.column("node").to_numpy()
            index, task, role = [], [], []
            for b in range(len(rotation.blocks)):
                for i, c in enumerate(map(tuple, rotation.cells(turned, b).tolist())):
                    k = parts[b, c]
                    own = int(nodes[i]) % k
                    for part in range(own, k):
                        index.append(i), task.append(number[b, c] * most + part), role.append(int(part != own))
                    for s in ahead:
                        behind = (b, tuple(x - y for x, y in zip(c, s, strict=True)))
                        for part in range(parts.get(behind, 0)):
                            index.append(i), task.append(number[behind] * most + part), role.append(1)
            for a in range(0, len(index), 20_000):
                at = pa.array(index[a : a + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(task[a : a + 20_000], pa.int64()), pa.array(role[a : a + 20_000], pa.int32()),
                        batch.column("node").take(at), batch.column("copies").take(at), batch.column("v").take(at),
                    ],
                    ["task", "role", "node", "copies", "v"],
                )

    blocks_of = {i * most + p: k[0] for k, i in number.items() for p in range(most)}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task, those at home first."""
        task, tile_, waiting = None, None, []

        def out(kind: list, a: list, n: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(n, pa.int64())], ["kind", "a", "n"]
            )

        def told(ids: np.ndarray, counts: np.ndarray, edges: list) -> Iterator[pa.RecordBatch]:
            some = counts > 0
            if some.any() or edges:
                yield out(
                    [0] * int(some.sum()) + [1] * len(edges),
                    ids[some].tolist() + [e[0] for e in edges],
                    counts[some].tolist() + [e[1] for e in edges],
                )

        def open_tile() -> Iterator[pa.RecordBatch]:
            nonlocal tile_, waiting
            ids, copies, x = (np.concatenate(c) for c in zip(*waiting, strict=True))
            tile_, waiting = _Tile(rotation, blocks_of[task], cosine), []
            tile_.start(ids, copies, x)
            yield from told(ids, *tile_.visit(ids, copies, x, home=True))

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal tile_
            if waiting:
                yield from open_tile()
            if tile_:
                yield from told(tile_.ids, tile_.links, [])
            tile_ = None

        for batch in batches:
            tasks, roles = batch.column("task").to_numpy(), batch.column("role").to_numpy()
            group = tasks * 2 + roles
            cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
            for a, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, e - a)
                if tasks[a] != task:
                    yield from close()
                    task = int(tasks[a])
                rows = (part.column("node").to_numpy(), part.column("copies").to_numpy(), _matrix(part.column("v")))
                if roles[a] == 0:
                    waiting.append(rows)
                    continue
                if waiting:
                    yield from open_tile()
                if tile_:
                    yield from told(rows[0], *tile_.visit(*rows, home=False))
        yield from close()

    met = materialise(
        distinct.select("node", "copies", "v")
        .mapInArrow(deal, distinct.select(F.lit(0).cast("long").alias("task"), F.lit(0).alias("role"), "node", "copies", "v").schema)
        .repartition("task")
        .sortWithinPartitions("task", "role", "node")
        .mapInArrow(meet, "kind int, a long, n long"),
        "met",
    )
    counts = met.where("kind = 0").select(F.col("a").alias("node"), "n")
    return counts, met.where("kind = 1").select(F.col("a").alias("u"), F.col("n").alias("v"))
