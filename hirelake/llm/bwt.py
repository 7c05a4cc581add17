"""Burrows-Wheeler transforms of shards, and their merge by interleave refinement.

A shard is a few strings, each followed by pads (symbol 0). Its transform lists,
in the order of its suffixes, the symbols before each suffix: here ``step`` symbols
at a time, as a dense code. The merge never compares suffixes. It keeps for every
place of the merged order the shard that the suffix there comes from, first all of
shard 0, then shard 1 and so on. In each round the places are read in order and
dealt out, stably, by the code before their suffix, and each goes on to the place in
its shard of the suffix with that code: an order by the first ``d`` symbols becomes
one by the first ``d + step``. Places that were told apart stay
apart, so after the last round the blocks of places that were never told apart are
the intervals of suffixes with a common prefix of that length.
"""

from dataclasses import dataclass

import numpy as np

PAD = 0


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by ``depth`` symbols of 8 bits or more (ties in any order),
    by doubling the sorted length; only suffixes that are level yet are sorted again."""
    n = len(symbols)
    wide = np.concatenate((symbols.astype(np.uint64), np.zeros(8, np.uint64)))
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | wide[j : j + n]
    order, sorted_ = np.argsort(key, kind="stable"), 8
    rank, level, key = np.empty(n, np.uint64), np.arange(n), key[order]
    while True:
        # places level with a neighbour; a rank is the first place of its level, from 1
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[level]] = level[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] + 1
        level = level[~(new & np.append(new[1:], True))] if len(level) else level
        if sorted_ >= depth or not len(level):
            return order
        at = order[level]
        after = np.where(at + sorted_ < n, rank[np.minimum(at + sorted_, n - 1)], np.uint64(0))
        key = rank[at] << np.uint64(32) | after
        inner = np.argsort(key, kind="stable")
        order[level], key, sorted_ = at[inner], key[inner], sorted_ * 2


@dataclass(frozen=True)
class Collection:
    """Padded strings of all shards, shard by shard."""

    symbols: np.ndarray  # 8 bits each
    string: np.ndarray  # which string each position belongs to, pads too
    inside: np.ndarray  # position within the string
    shard_ends: np.ndarray
    strings: np.ndarray  # original number of each string
    step: int


def collect(strings: list[np.ndarray], shards: int, depth: int) -> Collection:
    """Deal the strings out to shards and choose the widest step that divides
    ``depth`` and has fewer than 2**16 different codes."""
    present = np.zeros(256, bool)
    for s in strings:
        present[s] = True
    if present.sum() > 255:
        raise ValueError("more than 255 different bytes")
    code = np.cumsum(present).astype(np.uint8)  # 1 upwards
    shards = max(1, min(shards, len(strings)))
    order = [i for k in range(shards) for i in range(k, len(strings), shards)]
    in_shard = [len(range(k, len(strings), shards)) for k in range(shards)]
    for step in (5, 4, 2, 1):
        if depth % step:
            continue
        sizes = np.array([len(strings[i]) + step for i in order])
        ends = np.cumsum(sizes)
        symbols = np.zeros(ends[-1], np.uint8)
        for i, end, size in zip(order, ends, sizes, strict=True):
            symbols[end - size : end - step] = code[strings[i]]
        c = Collection(
            symbols,
            np.repeat(np.arange(len(order)), sizes),
            np.arange(ends[-1]) - np.repeat(ends - sizes, sizes),
            ends[np.cumsum(in_shard) - 1],
            np.array(order),
            step,
        )
        if step == 1 or len(np.unique(_grams(c))) < 1 << 16:
            return c
    raise AssertionError("step 1 always fits")


def _grams(c: Collection) -> np.ndarray:
    wide = np.concatenate((c.symbols.astype(np.uint64), np.zeros(c.step, np.uint64)))
    gram = np.zeros(len(c.symbols), np.uint64)
    for j in range(c.step):
        gram = gram << np.uint64(8) | wide[j : j + len(c.symbols)]
    return gram


def merge(c: Collection, depth: int, windows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(position of the suffix, block) at each place of the merged order; equal
    blocks mean equal first ``depth`` symbols. Pads count as equal to each other.

    With ``windows``, only suffixes that begin among the first ``windows[i]`` positions
    of string i and are in a block with others are merged: a round looks at the places
    that lead to them and are not alone in their block yet. The others keep no place, as
    no block of theirs can come to hold another suffix."""
    n = len(c.symbols)
    index = np.int32 if n < 1 << 31 else np.int64
    codes = (np.unique(_grams(c), return_inverse=True)[1] + 1).astype(np.int32)
    codes = codes.astype(np.uint16) if codes.max(initial=0) < 1 << 16 else codes  # radix sort
    begins = [0, *c.shard_ends.tolist()]
    suffix = np.concatenate(
        [suffix_order(c.symbols[a:b], depth + c.step) + a for a, b in zip(begins[:-1], begins[1:], strict=True)]
    ).astype(index)
    inside = c.inside[suffix]
    code = np.where(inside >= c.step, codes[suffix - c.step], 0).astype(codes.dtype)
    # where in its shard's transform the suffix is that begins with the symbols before this one
    back = np.empty(n, index)
    back[suffix] = np.arange(n, dtype=index)
    back = back[suffix - c.step]
    if windows is None:
        heads = np.flatnonzero(c.symbols[suffix] == PAD).astype(index)  # the first of each shard's suffixes
        place = np.arange(n, dtype=index)
    else:
        heads = np.zeros(0, index)
        place = np.flatnonzero((inside >= depth) & (inside < windows[c.strings[c.string[suffix]]] + depth)).astype(index)
    block = np.zeros(len(place), index)
    for _ in range(depth // c.step):
        here = code[place]
        dealt = np.argsort(here, kind="stable")
        key, old = here[dealt], block[dealt]
        some = int(np.searchsorted(key, 1))  # the others have no symbols before them
        dealt, key, old = dealt[some:], key[some:], old[some:]
        apart = np.zeros(len(dealt), bool)
        apart[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
        place = back[place[dealt]]
        if windows is not None and len(place):
            apart[0] = True
            alone = apart & np.append(apart[1:], True)
            place, apart = place[~alone], apart[~alone]
        block = np.cumsum(apart, dtype=index)
        if windows is None:
            place = np.concatenate((heads, place))
            block = np.concatenate((np.zeros(len(heads), index), 1 + block))
    return suffix[place], block
