"""Signature trees: who, among many sets, can overlap enough to be similar.

A set is an entry: a bitmap with a bit for each element, its size, and its excess (elements that got no
bit). Elements are dealt to buckets by their hash, and the first, second, .. element of a bucket has a
bit in the first, second, .. plane. Bits that two bitmaps have in common are then, bucket by bucket,
the smaller number of elements: at least the overlap, and more only where different elements meet
in a bucket. A node combines its children: the OR of their bitmaps, the range of sizes, the largest
excess. Two nodes can hold a similar pair only if their size ranges allow it and the largest possible
overlap, common bits + the smaller excess, reaches what the smallest sizes need. Two trees are walked
together from the top, pairs of nodes at a time, and pruned pairs are not opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 8
BLOCK = 1 << 14
PLANES = 4


def bitmap(elements: np.ndarray, width: int) -> np.ndarray:
    """``PLANES`` planes of ``width`` buckets (a power of two, 64 at least) as uint64 words."""
    counts = np.bincount((elements & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return _planes(counts)


def _planes(counts: np.ndarray) -> np.ndarray:
    bits = (counts[None, :] > np.arange(PLANES)[:, None]).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").view(np.uint64)


def width_for(size: int) -> int:
    """One to two buckets for an element."""
    return max(64, 1 << (max(1, size) - 1).bit_length())


def width_of(words: np.ndarray) -> int:
    return len(words) * 64 // PLANES


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """The bitmap with fewer buckets: what they hold is added up; what has no plane goes without a bit."""
    if width_of(words) == width:
        return words
    bits = np.unpackbits(words.view(np.uint8), bitorder="little").reshape(PLANES, -1)
    return _planes(bits.sum(axis=0, dtype=np.int64).reshape(-1, width).sum(axis=0))


def overlap(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> int:
    """The largest possible overlap of two sets of ``na`` and ``nb`` elements, from their bitmaps."""
    width = min(width_of(a), width_of(b))
    a, b = fold(a, width), fold(b, width)
    excess = min(na - int(np.bitwise_count(a).sum()), nb - int(np.bitwise_count(b).sum()))
    return min(int(np.bitwise_count(a & b).sum()) + excess, na, nb)


class Tree:
    """Levels from the entries up; node k's children are FAN neighbours from FAN * k on."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        excess = sizes - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, excess)]
        while len(self.levels[-1][1]) > FAN:
            bits, low, high, excess = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((
                np.bitwise_or.reduceat(bits, cut, axis=0), np.minimum.reduceat(low, cut),
                np.maximum.reduceat(high, cut), np.maximum.reduceat(excess, cut)))


def _possible(tree: Tree, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    bits, low, high, excess = tree.levels[level]
    ok = (high[i] * 100 >= low[j] * percent) & (high[j] * 100 >= low[i] * percent)
    at = np.flatnonzero(ok)
    a, b = i[at], j[at]
    common = np.bitwise_count(bits[a] & bits[b]).sum(axis=1).astype(np.int64)
    most = np.minimum(common + np.minimum(excess[a], excess[b]), np.minimum(high[a], high[b]))
    ok[at] = most * (100 + percent) >= (low[a] + low[b]) * percent
    return ok


def pairs(tree: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entry pairs (i < j) whose bound allows 100 * overlap >= percent * union, in blocks."""
    top = len(tree.levels) - 1
    i, j = np.triu_indices(len(tree.levels[top][1]))
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if len(i) > BLOCK:
            for at in range(0, len(i), BLOCK):
                stack.append((level, i[at:at + BLOCK], j[at:at + BLOCK]))
            continue
        keep = _possible(tree, level, i, j, percent)
        i, j = i[keep], j[keep]
        if level == 0:
            apart = i < j
            if apart.any():
                yield i[apart], j[apart]
            continue
        n = len(tree.levels[level - 1][1])
        a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)[None, :]).ravel()
        b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)[None, :]).ravel()
        real = (a < n) & (b < n) & (a <= b)
        if real.any():
            stack.append((level - 1, a[real], b[real]))
