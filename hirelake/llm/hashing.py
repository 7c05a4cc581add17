"""Words, shingles and set signatures of texts as numpy arrays.

Everything works on Arrow string arrays in slices of a bounded number of text
bytes; a slice holds at least one whole text. A word is a maximal run of bytes
other than ASCII white space (``\\x20 \\x09-\\x0D``), A-Z read as a-z. All hashes
are 64 bits wide.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_SHINGLE_BASE = U64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        made = []
        for base in (_BASE, inverse):
            p = np.full(size, base, U64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = (made[0], made[1])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit over the whole word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(texts: pa.Array, most_bytes: int = (1 << 20) - 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive slices; null is empty. Hashing a
    slice takes some forty times its bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each row's first word (one more entry at the end)."""
    word = ~_SPACE[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    opens[inner] |= word[inner]
    closes[inner - 1] |= word[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((_LOWER[data].astype(U64) + U64(1)) * up[:-1], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return hashes, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word shingle, and each row's first one. A row of fewer
    words has one shingle, its whole sequence; a row without words has none."""
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    begin = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(begin[-1]) - begin[row] + first[row]
    acc = np.zeros(len(at), U64)
    last = first[row + 1]
    padded = np.concatenate((hashes, np.zeros(k, U64)))
    for j in range(k):
        step = acc * _SHINGLE_BASE + padded[at + j]
        acc = np.where(at + j < last, step, acc) if (n_words < k).any() else step
    return mix(acc + np.minimum(n_words, k).astype(U64)[row]), begin


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and each row's first one."""
    parts = [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate(([0], np.cumsum(sizes)))


def row_sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of each row's values modulo 2**64 (rows may be empty)."""
    total = np.concatenate((np.zeros(1, U64), np.cumsum(values, dtype=U64)))
    return total[begin[1:]] - total[begin[:-1]]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, and each row's first one."""
    return distinct(*shingles(*words(data, offsets), k))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, U64).view(np.int64)
