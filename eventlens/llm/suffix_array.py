"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The algorithm is SA-IS: classify suffixes, sort the leftmost-smaller (LMS) substrings by inducing, name
them, recurse on the names while two are equal, and induce all suffixes from the sorted LMS
suffixes. An inducing scan reads and writes one array in order; here it advances by blocks, each the
longest whose own insertions all land behind it, so a block is a handful of array operations.
"""

from __future__ import annotations

import numpy as np

_FIRST_BLOCK = 64
_COMPARED = 1 << 20  # symbols of LMS substrings compared at once
_COUNT = np.arange(1 << 16)


def _suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last suffix is."""
    n = len(text)
    smaller = np.ones(n, bool)
    if n > 1:
        step = np.sign(np.diff(text.astype(np.int64)))
        at = np.where(step != 0, np.arange(n - 1), n - 1)
        following = np.minimum.accumulate(at[::-1])[::-1]
        smaller[:-1] = np.append(step, 1)[following] > 0
    return smaller


def _scan(text, smaller, sa, bounds, forward: bool) -> None:
    """Induces larger suffixes from the left (forward) or smaller ones from the right."""
    n, size, i = len(text), _FIRST_BLOCK, 0
    free = bounds.copy()  # per symbol the next free place
    late = 2 * n
    while i < n:
        block = sa[i:i + size] if forward else sa[max(0, n - i - size):n - i][::-1]
        width = len(block)
        source = block - 1
        use = (source >= 0).nonzero()[0]
        source = source[use]
        mine = smaller[source] != forward
        use, source = use[mine], source[mine]
        symbol = text[source]
        place = free[symbol] if forward else n - 1 - free[symbol]
        # Entry k may take part if no entry up to k lands inside the block that ends with k.
        nearest = np.full(width, late)
        nearest[use] = place
        good = np.minimum.accumulate(nearest) > _COUNT[:width] + i if width <= len(_COUNT) else (
            np.minimum.accumulate(nearest) > np.arange(i, i + width))
        m = int(good.argmin())
        m = width if m == 0 and good[0] else max(1, m)
        k = int(use.searchsorted(m))
        if k == 1:
            c = symbol[0]
            sa[free[c]] = source[0]
            free[c] += 1 if forward else -1
        elif k:
            symbol, source = symbol[:k], source[:k]
            order = symbol.argsort(kind="stable")
            symbol = symbol[order]
            first = np.empty(k, bool)
            first[0] = True
            np.not_equal(symbol[1:], symbol[:-1], out=first[1:])
            new = first.nonzero()[0]
            rank = _COUNT[:k] if k <= len(_COUNT) else np.arange(k)
            rank = rank - new[first.cumsum() - 1]
            heads = symbol[new]
            if forward:
                sa[free[symbol] + rank] = source[order]
            else:
                sa[free[symbol] - rank] = source[order]
            counts = np.empty(len(new), np.int64)
            counts[:-1] = new[1:] - new[:-1]
            counts[-1] = k - new[-1]
            if forward:
                free[heads] += counts
            else:
                free[heads] -= counts
        i += m
        size = max(_FIRST_BLOCK, min(2 * m, n))


def _induce(text, smaller, starts, ends, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS suffixes that are in order within their first symbol."""
    sa = np.full(len(text), -1, np.int32)  # a shard is far below 2^31 symbols
    symbol = text[lms]
    order = np.argsort(symbol, kind="stable")
    symbol = symbol[order]
    last = np.searchsorted(symbol, symbol, "right")
    sa[ends[symbol] - (last - np.arange(len(lms)))] = lms[order]
    _scan(text, smaller, sa, starts, True)
    filled = sa >= 0
    filled[filled] = ~smaller[sa[filled]]
    sa[~filled] = -1  # smaller suffixes are all induced anew
    sa[0] = len(text) - 1
    _scan(text, smaller, sa, ends - 1, False)
    return sa


def _names(text, smaller, starts, ends, lms: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings, each from its LMS position to the next one, both included.

    Inducing from LMS positions in any order sorts all suffixes by their first LMS substring; then
    neighbours of equal length are compared, more symbols at a time the fewer are left.
    """
    sa = _induce(text, smaller, starts, ends, lms)
    width = np.zeros(len(text), np.int64)
    width[lms] = np.append(np.diff(lms), 0) + 1
    order = sa[width[sa] > 0].astype(np.int64)
    one, other = order[:-1], order[1:]
    equal = width[one] == width[other]
    tied, done = np.flatnonzero(equal), 0
    while len(tied):
        a, b = one[tied] + done, other[tied] + done
        step = max(1, min(4096, _COMPARED // len(tied)))
        if step == 1:
            agree = text[a] == text[b]
        else:
            inside = np.arange(step) < (width[one[tied]] - done)[:, None]
            a, b = (np.minimum(x[:, None] + np.arange(step), len(text) - 1) for x in (a, b))
            agree = ((text[a] == text[b]) | ~inside).all(axis=1)
        equal[tied[~agree]] = False
        done += step
        tied = tied[agree]
        tied = tied[width[one[tied]] > done]
    names = np.zeros(len(text), np.int64)
    names[order] = np.append(0, np.cumsum(~equal))
    return names[lms]


def induced_sort(text: np.ndarray) -> np.ndarray:
    """The suffix array of small integers whose last one is 0 and the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    # A stable sort of 16-bit symbols is a radix sort.
    text = text.astype(np.uint16 if int(text.max()) < 1 << 16 else np.int32)
    smaller = _suffix_types(text)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    starts = ends - counts
    names = _names(text, smaller, starts, ends, lms)
    if int(names.max()) + 1 < len(lms):
        order = lms[induced_sort(names)]
    else:
        order = np.empty(len(lms), np.int64)
        order[names] = lms
    return _induce(text, smaller, starts, ends, order)


def permuted_common_prefixes(
    raw: np.ndarray, sa: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(PLCP, predecessor): per text position the common prefix with the suffix before it in ``sa``.

    ``raw`` holds bytes; a suffix counts as far as ``ends`` at its position. Along a text, the value
    falls by one as long as the predecessors go along and the symbols passed agree, so only the
    other positions are compared, eight bytes at a time.
    """
    n = len(raw)
    before = np.full(n, -1, np.int64)
    real = sa[sa < n]
    before[real[1:]] = real[:-1]
    at = np.arange(n)
    chained = (before > 0) & (at > 0)
    chained[1:] &= (before[1:] == before[:-1] + 1) & (ends[1:] == ends[:-1])
    previous = np.maximum(before - 1, 0)
    chained &= ends[before] == ends[previous]
    chained[1:] &= raw[:-1] == raw[previous[1:]]
    heads = np.flatnonzero(~chained & (before >= 0))
    words = np.zeros(n, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    for k in range(8):
        words |= padded[k:n + k].astype(np.uint64) << np.uint64(8 * k)
    value = np.full(n, -1, np.int64)
    limit = np.minimum(ends[heads] - heads, ends[before[heads]] - before[heads])
    matched = np.zeros(len(heads), np.int64)
    active = np.flatnonzero(limit > 0)
    while len(active):
        a, b = heads[active] + matched[active], before[heads[active]] + matched[active]
        different = words[a] ^ words[b]
        low = different & (~different + np.uint64(1))
        equal = np.where(different == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        matched[active] += equal.astype(np.int64)
        active = active[(equal == 8) & (matched[active] < limit[active])]
    value[heads] = heads + np.minimum(matched, limit)
    # A chained position ends its match where the head of its chain does.
    last = np.maximum.accumulate(np.where(~chained, at, 0))
    return np.where(before >= 0, np.maximum(value[last] - at, 0), 0), before
