"""Vector bin packing of examples into fixed-length sequences.

A sequence has three limits: tokens, segments and loss-bearing tokens. Each task
keeps a pool of pending examples and fills one sequence after another: of the
examples that fit, the one whose needs (as shares of the limits) have the largest
dot product with what is left of the sequence is placed next. If none fits, the
best one is cut so that the sequence is full. Only a task's last sequence stays
short, and no example leaves its task, so nothing is shuffled.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.tokens import encoder, texts_of


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Packer:
    """Fills sequences from a bounded pool of examples.

    An example is (name, ids, loss), loss a mask over the ids; an empty one has no
    piece. ``cut=False`` cuts only examples that exceed the limits by themselves,
    so sequences may stay shorter.
    """

    def __init__(self, limits: Limits, pool: int = 256, cut: bool = True):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits are 1 or more")
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pool, self.cut = pool, cut
        self.waiting: list[tuple] = []  # (name, first id, end, loss prefix sums)
        self.needs = np.zeros((0, 3))
        self.sequence = 0

    def _need(self, item: tuple) -> list[float]:
        _, a, b, sums = item
        return [b - a, 1, sums[b] - sums[a]]

    def _fitting(self, item: tuple, left: np.ndarray) -> int:
        """End of the longest beginning of an example that fits."""
        _, a, b, sums = item
        by_loss = int(np.searchsorted(sums, sums[a] + left[2], "right")) - 1
        return int(min(b, a + left[0], by_loss))

    def add(self, name: object, loss: np.ndarray) -> Iterator[tuple]:
        if len(loss):
            sums = np.concatenate(([0], np.cumsum(loss)))
            self.waiting.append((name, 0, len(loss), sums))
            self.needs = np.concatenate((self.needs, [self._need(self.waiting[-1])]))
        while len(self.waiting) > self.pool:
            yield from self._fill()

    def finish(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self._fill()

    def _fill(self) -> Iterator[tuple]:
        """One sequence: (name, start, end, sequence, offset) of each piece."""
        left, offset = self.caps.copy(), 0
        open_ = np.ones(len(self.waiting), bool)  # not yet used up or refused
        gone = []
        shares = self.needs / self.caps
        while left[0] >= 1 and left[1] >= 1 and open_.any():
            score = shares @ (left / self.caps)
            fits = open_ & (self.needs <= left).all(1)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1)))
            elif self.cut or not offset:
                i = int(np.argmax(np.where(open_, score, -1)))
            else:
                break
            name, a, b, sums = self.waiting[i]
            end = b if fits[i] else self._fitting(self.waiting[i], left)
            open_[i] = False
            if end == a:
                continue
            yield name, a, end, self.sequence, offset
            offset += end - a
            left -= [end - a, 1, sums[end] - sums[a]]
            self.waiting[i] = (name, end, b, sums)
            self.needs[i] = self._need(self.waiting[i])
            if end == b:
                gone.append(i)
        for i in sorted(gone, reverse=True):
            del self.waiting[i]
        self.needs = np.delete(self.needs, gone, axis=0)
        self.sequence += 1


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, n_loss long"
)
_ROW_BITS = 33


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(),
    by_word: bool = False, pool: int = 256, learned: str | None = None,
) -> DataFrame:
    """Pieces of every document (null text: empty), each with its place.

    A document is its ids and ``end_id``. All of them bear loss, unless ``learned``
    names a column of spans (array of structs of begin and end, code points, ends
    exclusive): then the ids that hold a character of a span do, and ``end_id`` if
    the text's last character is in one. Null spans, null bounds and an empty text
    bear none; spans may overlap or reach beyond the text. Sequence ids
    are unique: the task's number in the upper bits, a running number below.
    Repeated rows are packed once each; other columns are ignored.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, packer = encoder(tokenizer, by_word), Packer(limits, pool)
        base = TaskContext.get().partitionId() << _ROW_BITS
        held: dict[int, tuple] = {}
        serial, rows = 0, []
        schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

        def place(pieces: Iterator[tuple]) -> None:
            for name, a, b, sequence, offset in pieces:
                doc_id, ids, loss = held[name]
                n_loss = int(loss[a:b].sum())
                rows.append((doc_id, a, b - a, zlib.crc32(ids[a:b]), len(ids), base + sequence, offset, n_loss))
                if b == len(ids):
                    del held[name]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
            rows.clear()
            return made

        def encoded(batch: pa.RecordBatch, i: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Ids and loss mask, ``end_id`` included, of some rows of a batch."""
            texts = texts_of(batch.column("text"), i, 64)
            if learned is None:
                for ids in make.ids(texts):
                    yield ids, np.ones(len(ids) + 1, np.int64)
                return
            spans = [
                [tuple(x.values()) for x in own or [] if x and None not in x.values()]
                for own in batch.column("learned").slice(i, 64).to_pylist()
            ]
            for (ids, mask), text, own in zip(make.learned(texts, spans), texts, spans, strict=True):
                last = any(a < len(text) <= b for a, b in own)
                yield ids, np.append(mask, last).astype(np.int64)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                names = batch.column("doc_id").slice(i, 64).to_pylist()
                for doc_id, (ids, loss) in zip(names, encoded(batch, i), strict=True):
                    held[serial] = (doc_id, np.concatenate((ids, end)).astype("<u4", copy=False), loss)
                    place(packer.add(serial, loss))
                    serial += 1
                if len(rows) > 10_000:
                    yield out()
        place(packer.finish())
        if rows:
            yield out()

    columns = ["doc_id", "text"] + ([F.col(learned).alias("learned")] if learned else [])
    return docs.select(*columns).mapInArrow(pack, PIECES)
