"""Wavelet matrices of token ids: one file per shard of documents.

Every bit of the ids, from the highest, is a plane of one bit per token; tokens
are stably parted by that bit before the next plane. With counts of ones at every
512 bits, access to a token, counting a token's occurrences in a range and finding
its k-th one take one rank or select a plane, on the planes as they lie in the
file.

File: ``WMX1``, then little-endian: bits u64, tokens u64, documents u64; document
ids (i64), their presence (u8, padded to 8), their ends (u64); for each plane the
number of zeros (u64), the bits (u64 words, in blocks of 512 bits) and the ones
before each block (u64, one more at the end). Shards are rows of a Parquet table
(columns part, shard, n_tokens, payload) compressed by zstd, because executors
share no other writable store than Spark's.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.tokens import encoder, texts_of

_BLOCK = 512


def _width(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, zeros: int, words: np.ndarray, before: np.ndarray):
        self.zeros, self.words, self.before = zeros, words.reshape(-1, 8), before

    @classmethod
    def of(cls, bits: np.ndarray) -> "Plane":
        packed = np.packbits(bits, bitorder="little")
        size = -(-max(len(bits), 1) // _BLOCK) * (_BLOCK // 8)
        words = np.concatenate((packed, np.zeros(size - len(packed), np.uint8))).view("<u8").reshape(-1, 8)
        ones = np.bitwise_count(words).sum(1, dtype=np.uint64)
        before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)))
        return cls(len(bits) - int(before[-1]), words, before)

    def bits(self, n: int) -> np.ndarray:
        return np.unpackbits(self.words.reshape(-1).view(np.uint8), count=n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        word = self.words.reshape(-1)[at >> 6]
        return (word >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position (0 to the length)."""
        block = np.minimum(at // _BLOCK, len(self.words) - 1)
        inside = at - block * _BLOCK
        word = np.arange(8) * 64
        keep = np.clip(inside[:, None] - word, 0, 64)
        mask = np.where(keep >= 64, ~np.uint64(0), (np.uint64(1) << (keep % 64).astype(np.uint64)) - np.uint64(1))
        ones = np.bitwise_count(self.words[block] & mask).sum(1, dtype=np.int64)
        return self.before[block].astype(np.int64) + ones

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        starts = np.arange(len(self.before)) * _BLOCK
        counts = self.before.astype(np.int64)
        if not bit:
            counts = starts - counts
        block = np.searchsorted(counts, k, "right") - 1
        flat = np.unpackbits(self.words[block].view(np.uint8).reshape(len(k), 64), axis=1, bitorder="little")
        seen = np.cumsum(flat == bit, axis=1)
        return block * _BLOCK + (seen <= (k - counts[block])[:, None]).sum(1)


class WaveletMatrix:
    """Token ids with access, count and occurrence lookup."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"token id {int(ids.max())} needs more than {bits} bits")
        planes, ids = [], ids.astype(_width(bits), copy=False)
        for shift in range(bits - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << shift)).astype(bool)
            planes.append(Plane.of(one))
            if shift:  # nothing looks at the order below the last plane
                # by the places of the ones: a mask is copied run by run, and runs are short
                ids = np.concatenate((ids.compress(~one), ids.compress(one)))
        return cls(len(ids), planes)

    def _bits_of(self, symbol: int) -> list[int]:
        return [symbol >> s & 1 for s in range(len(self.planes) - 1, -1, -1)]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The tokens at the given positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for p in self.planes:
            one, ones = p.get(at), p.rank1(at)
            out = out << 1 | one
            at = np.where(one, p.zeros + ones, at - ones)
        return out

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        ends = np.array([lo, hi], np.int64)
        if symbol >> len(self.planes):
            return 0, 0
        for p, bit in zip(self.planes, self._bits_of(symbol), strict=True):
            ones = p.rank1(ends)
            ends = p.zeros + ones if bit else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions lo to hi."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, symbol: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Positions of a token in a range, ascending."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        at = np.arange(a, b)
        for p, bit in zip(self.planes[::-1], self._bits_of(symbol)[::-1], strict=True):
            at = p.select(at - p.zeros if bit else at, bit) if len(at) else at
        return at

    def decode(self) -> np.ndarray:
        """All tokens, by undoing the partings from the last plane up."""
        kind = _width(len(self.planes))
        ids = self.planes[-1].bits(self.n).astype(kind) if self.planes else np.zeros(self.n, kind)
        for i, p in enumerate(self.planes[-2::-1], 1):
            one, above = p.bits(self.n), np.empty(self.n, kind)
            above[np.flatnonzero(~one)] = ids[: p.zeros]
            above[np.flatnonzero(one)] = ids[p.zeros :] | kind(1 << i)
            ids = above
        return ids.astype(np.uint32)


def dump(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A shard file."""
    known = np.array([i is not None for i in doc_ids], np.uint8)
    w = WaveletMatrix.build(ids, bits)
    parts = [
        b"WMX1\0\0\0\0",
        np.array([bits, len(ids), len(doc_ids)], "<u8"),
        np.array([i or 0 for i in doc_ids], "<i8"),
        np.concatenate((known, np.zeros(-len(known) % 8, np.uint8))),
        np.asarray(ends, "<u8"),
    ]
    for p in w.planes:
        parts += [np.array([p.zeros], "<u8"), p.words, p.before]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts)


def load(payload: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their ends and the matrix of a shard file; planes are views."""
    if payload[:4] != b"WMX1":
        raise ValueError("no wavelet shard")
    at = 8

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(payload, kind, n, at)
        at += x.nbytes
        return x

    bits, n, docs = map(int, take(3, "<u8"))
    ids, known = take(docs, "<i8"), take(docs + -docs % 8, "u1")[:docs]
    ends = take(docs, "<u8").astype(np.int64)
    blocks = -(-max(n, 1) // _BLOCK)
    planes = [Plane(int(take(1, "<u8")[0]), take(blocks * 8, "<u8"), take(blocks + 1, "<u8")) for _ in range(bits)]
    return [i if k else None for i, k in zip(ids.tolist(), known, strict=True)], ends, WaveletMatrix(n, planes)


SHARDS = "part int, shard int, n_docs long, n_tokens long, payload binary"


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: int,
    by_word: bool = False, shard_tokens: int = 1 << 19,
) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write shards
    in ascending ``doc_id`` order (null ids first, equal ids by text).

    Documents are range-partitioned once; a task writes a shard whenever it holds
    ``shard_tokens`` ids (few enough that their partings stay in a core's cache), and
    never cuts a document. An id that needs more than ``bits`` bits is an error. Other
    columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, part, shard = encoder(tokenizer, by_word), TaskContext.get().partitionId(), 0
        names, ends, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = [[part], [shard], [len(names)], [size], [dump(names, np.array(ends), np.concatenate(held), bits)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                ["part", "shard", "n_docs", "n_tokens", "payload"],
            )

        end = np.array([end_id], np.uint32)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                found = make.ids(texts_of(batch.column("text"), i, 64))
                for name, ids in zip(batch.column("doc_id").slice(i, 64).to_pylist(), found, strict=True):
                    held += [ids, end]
                    size += len(ids) + 1
                    names.append(name)
                    ends.append(size)
                    if size >= shard_tokens:
                        yield flush()
                        names, ends, held, size, shard = [], [], [], 0, shard + 1
        if names:
            yield flush()

    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")]
    (
        docs.select("doc_id", "text")
        .repartitionByRange(order[0])
        .sortWithinPartitions(*order)
        .mapInArrow(encode, SHARDS)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32`` of its ids."""
    table = spark.read.schema(SHARDS).parquet(path)
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = parts.select("part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        table.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_in"))
        .join(parts, "part")
        .select("part", "shard", (F.col("_base") + F.col("_in")).alias("_base"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names, ends, matrix = load(batch.column("payload")[i].as_py())
                ids = matrix.decode().astype("<u4", copy=False)
                begins = np.concatenate((np.zeros(1, np.int64), ends))[:-1]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                same = lambda c, n=len(names), b=batch, i=i: pa.array([b.column(c)[i].as_py()] * n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [same("part"), same("shard"), pa.array(names, pa.int64()), pa.array(begins), pa.array(ends - begins), pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "_at", "n_tokens", "ids_crc32"],
                )

    rows = table.select("part", "shard", "payload").mapInArrow(
        decode, "part int, shard int, doc_id long, _at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"
    )
