"""Merging Burrows-Wheeler transforms by iterative interleave refinement.

The interleave of the shards' transforms says from which shard each suffix of the merged order comes. It starts as the
shards one after the other; a pass puts the merged transform's characters into a stable order and carries the interleave
along, after which it is right for prefixes one character longer. The blocks of suffixes with a common prefix are refined
in the same pass: where a block starts first, the pass tells the common prefix of its first suffix and the one before.
Since each shard's own order is known, its last-to-first map carries its suffixes from pass to pass.
No suffix is sorted again. ``depth`` passes are enough to know which suffixes have ``depth`` characters in common.
"""

from __future__ import annotations

import numpy as np


def shard_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of one shard (characters u8) by the first ``depth`` characters at least, cyclically; ties by position."""
    n = len(text)
    around = np.resize(text, n + depth + 8)
    word = np.zeros(n + depth, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | around[i : i + n + depth].astype(np.uint64)
    order = np.argsort(word[:n], kind="stable")
    first = np.ones(n, bool)
    key = word[:n][order]
    first[1:] = key[1:] != key[:-1]
    for at in range(8, depth, 8):
        alone = first & np.append(first[1:], True)
        tied = np.flatnonzero(~alone)  # the places of suffixes that share all characters so far
        if not len(tied):
            break
        group = np.cumsum(first[tied])
        key = word[order[tied] + at]
        inner = np.lexsort((key, group))
        order[tied] = order[tied][inner]
        key = key[inner]
        first[tied[1:]] |= key[1:] != key[:-1]
    return order


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, position, common) of the merged suffix order; common: how many characters, up to ``depth`` and in whole
    strides, a suffix shares with the one before.

    A shard is an array of u8 characters, read cyclically. The transform's characters are grams of ``stride`` characters,
    the most for which the grams at hand can be numbered in 16 bits, so that a pass is one counting sort and goes
    ``stride`` characters further."""
    orders = [shard_order(t, depth) for t in shards]
    n = sum(map(len, shards))
    for stride in (s for s in (5, 4, 2, 1) if depth % s == 0):
        grams = [sum(np.roll(t, i).astype(np.uint64) << np.uint64(8 * (i - 1)) for i in range(1, stride + 1)) for t in shards]
        values, number = np.unique(np.concatenate(grams), return_inverse=True)
        if len(values) <= 65536:
            break
    bases = np.cumsum([0, *map(len, shards)])
    # by rank: the gram before each suffix, and the rank of the suffix that it begins
    bwt = np.concatenate([number[b : b + len(o)][o] for b, o in zip(bases, orders, strict=False)]).astype(np.uint16)
    back = np.empty(n, np.int32)
    for b, o in zip(bases, orders, strict=False):
        rank = np.empty(len(o), np.int32)
        rank[o] = np.arange(b, b + len(o), dtype=np.int32)
        back[b : b + len(o)] = rank[(o - stride) % len(o)]
    suffix = np.arange(n, dtype=np.int32)  # the interleave: in each shard, ranks stay in their order
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.uint8 if depth < 256 else np.int32)
    starts = np.ones(n, bool)
    for h in range(0, depth, stride):
        chars = bwt[suffix]
        place = np.argsort(chars, kind="stable")
        chars, of = chars[place], block[place]
        starts[1:] = (chars[1:] != chars[:-1]) | (of[1:] != of[:-1])
        common[starts & (common == depth)] = h
        block = np.cumsum(starts, dtype=np.int32)
        suffix = back[suffix[place]]
    side = np.searchsorted(bases, suffix, side="right") - 1
    return side, np.concatenate(orders)[suffix], common
