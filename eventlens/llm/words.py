"""Words of whole Arrow columns as 64-bit hashes, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``; A-Z are lowered. The bytes of a column are taken in pieces that
end between words, so memory is a small multiple of the batch, however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
SLICE = 4 << 20
_rng = np.random.default_rng(20_26)
_LETTER = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1]
_MIX = _rng.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, PIECE + 1), _powers(_INVERSE, PIECE + 1)


def finish(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of ``h`` over all bits of the result; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    """Hashes of all words; text i has words[first[i]:first[i + 1]]."""

    hashes: np.ndarray
    first: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and where each text starts, with the end."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in rows whose texts have ``size`` bytes together, or one longer text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = np.cumsum(lengths)
    low = 0
    while low < len(ends):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(low, high - low)
        low = high


def _long_word(raw: np.ndarray) -> np.uint64:
    """The hash of one word that does not fit a piece."""
    total, shift = np.uint64(0), np.uint64(1)
    for at in range(0, len(raw), PIECE):
        part = _LETTER[raw[at:at + PIECE]]
        total = total + shift * np.add.reduce(part * _UP[:len(part)])
        shift = shift * _UP[len(part)]
    return total


def words_of(column: pa.Array) -> Words:
    raw, bounds = text_bytes(column)
    n = len(raw)
    if n == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    del inside, before, after, edge
    hashes = np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        k = 0
        while k < len(starts):
            low = int(starts[k])
            upto = max(k + 1, int(np.searchsorted(ends, low + PIECE, "right")))
            high = int(ends[upto - 1])
            if high - low > PIECE:
                hashes[k] = _long_word(raw[low:high])
            else:
                sums = np.empty(high - low + 1, np.uint64)
                sums[0] = 0
                np.cumsum(_LETTER[raw[low:high]] * _UP[:high - low], out=sums[1:])
                s, e = starts[k:upto] - low, ends[k:upto] - low
                hashes[k:upto] = (sums[e] - sums[s]) * _DOWN[s]
            k = upto
        return Words(finish(hashes), np.searchsorted(starts, bounds))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; runs over a text's end are for the caller to skip."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n] * _MIX[0]
        for j in range(1, size):
            total += hashes[j:j + n] * _MIX[j % 64]
        return finish(total + np.uint64(size))
