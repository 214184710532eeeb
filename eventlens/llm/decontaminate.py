"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are sequences of words (A-Z lowered). A document is contaminated by an item of m words when
some run of its words is within ``edit_share * m`` word edits of the item.

* The CGK random walk reads a sequence and writes 3 m words: at step j it writes the current word
  and moves on if a random bit of (j, word) says so. Two sequences at a small edit distance are
  written at a small Hamming distance.
* Windows of the item's own length are embedded at each place where the q-gram lemma leaves the
  item possible (m - q + 1 - k q common q-grams, q = 3): with fewer, no window is within k edits.
* An item is embedded in even segments of at most ``SEGMENT`` words, since walks part with the number
  of edits and not with their share. Of k edits on n segments, some segment has k // n at most.
* ``repeats`` tables sample ``sampled`` places of the embedding of one of ``walks`` walks; a window
  with a segment that agrees with the item's in a table is a candidate. ``repeats`` is set for a
  high recall at the largest distance of one segment (tests measure it, up to 500 words).
* A candidate is decided by the exact edit distance of the item to the best run around the window.

The benchmark is broadcast in blocks of at most ``block_bytes``, whatever its size; documents are
read where they lie and nothing but matches leaves a task.

Defined results: null and blank texts and items match nothing; an item with a null id is carried;
repeated documents are matched each, repeated items are one; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W
from eventlens.llm.common import fresh, join_rows

EDIT_SHARE = 0.2
WALKS, REPEATS, SAMPLED = 8, 64, 3
SEGMENT = 50
BLOCK_BYTES = 4 << 20
BITS = 20
MATCHES = ("doc_id bigint, text_key bigint, item_id bigint, start_word bigint, end_word bigint, "
           "distance bigint")


def seed_size(m: int) -> int:
    return 3 if m >= 6 else min(m, 2)


def least_common(m: int, k: int) -> int:
    """q-grams that a run within k edits of m words has in common with them, at least."""
    q = seed_size(m)
    return max(1, m - q + 1 - k * q)


def segments(m: int) -> list[tuple[int, int]]:
    """(offset, length) of the segments of an item of m words."""
    n = -(-m // SEGMENT)
    cuts = [m * j // n for j in range(n + 1)]
    return [(low, high - low) for low, high in pairwise(cuts)]


class Walk:
    """Random walks and samples for sequences of ``m`` words; the same for all tasks."""

    def __init__(self, m: int, walks: int = WALKS, repeats: int = REPEATS, sampled: int = SAMPLED):
        rng = np.random.default_rng(m)
        self.m, self.length, self.walks = m, 3 * m, walks
        self.salts = rng.integers(1, 2**64, (walks, self.length), dtype=np.uint64) | np.uint64(1)
        # The walk has passed most of the sequence long before its last third: sample there.
        self.places = rng.integers(0, max(1, 2 * m), (repeats, sampled))

    def embed(self, sequences: np.ndarray, walk: int) -> np.ndarray:
        """Sequences [n, m] as [n, 3 m]; zero once a walk has left its sequence."""
        n = len(sequences)
        padded = np.zeros((n, self.m + 1), np.uint64)
        padded[:, :self.m] = sequences
        at, rows = np.zeros(n, np.int64), np.arange(n)
        out = np.empty((n, self.length), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(self.length):
                current = padded[rows, at]
                out[:, j] = current
                step = (current * self.salts[walk, j]) >> np.uint64(63)
                at = np.minimum(at + step.astype(np.int64), self.m)
        return out

    def keys(self, sequences: np.ndarray) -> np.ndarray:
        """LSH keys [n, repeats]; a key depends on its table."""
        out = np.empty((len(sequences), len(self.places)), np.uint64)
        for walk in range(self.walks):
            embedded = self.embed(sequences, walk)
            for table in range(walk, len(self.places), self.walks):
                with np.errstate(over="ignore"):
                    key = np.full(len(sequences), table + 1, np.uint64)
                    for place in self.places[table]:
                        key = W.finish(key * np.uint64(0x9E3779B97F4A7C15) + embedded[:, place])
                out[:, table] = key
        return out


def best_run(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the run in ``region`` nearest to ``item`` by word edits."""
    m, n = len(item), len(region)
    cost = list(range(m + 1))   # column for the empty prefix of the region
    start = [0] * (m + 1)
    best = (m, 0, 0)
    a, b = item.tolist(), region.tolist()
    for j in range(n):
        previous, came = cost, start
        cost, start = [0] * (m + 1), [0] * (m + 1)
        start[0] = j + 1
        for i in range(m):
            options = ((previous[i] + (a[i] != b[j]), came[i]), (previous[i + 1] + 1, came[i + 1]),
                       (cost[i] + 1, start[i]))
            cost[i + 1], start[i + 1] = min(options, key=lambda x: (x[0], -x[1]))
        if cost[m] < best[0]:
            best = (cost[m], start[m], j + 1)
    return best


class Items:
    """A block of the benchmark, prepared: seeds, walks and keys by item."""

    def __init__(self, ids: list[int | None], texts: list[str], edit_share: float = EDIT_SHARE):
        found = W.words_of(pa.array(texts, pa.string()))
        self.ids, self.items = [], []
        for k, item_id in enumerate(ids):
            sequence = found.hashes[found.first[k]:found.first[k + 1]]
            if len(sequence):
                self.ids.append(item_id)
                self.items.append(sequence)
        self.edits = [int(edit_share * len(s) + 1e-9) for s in self.items]
        self.least = np.array([least_common(len(s), k)
                               for s, k in zip(self.items, self.edits, strict=True)], np.int64)
        seeds: dict[int, list[list[np.ndarray]]] = {}
        for k, s in enumerate(self.items):
            grams = W.windows(s, seed_size(len(s)))
            seeds.setdefault(seed_size(len(s)), []).append(
                [grams, np.full(len(grams), k), np.arange(len(grams))])
        self.seeds = {}
        for q, parts in seeds.items():
            gram, item, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(gram, kind="stable")
            member = np.zeros(1 << BITS, bool)
            member[(gram >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.seeds[q] = (gram[order], item[order], offset[order], member)
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(self.items):
            by_length.setdefault(len(s), []).append(k)
        self.walks = {n: Walk(n) for n in {n for m in by_length for _, n in segments(m)}}
        self.keys: dict[int, list[np.ndarray]] = {}  # by length of the item: keys of each segment
        self.place = np.zeros(len(self.items), np.int64)
        for m, of in by_length.items():
            whole = np.stack([self.items[k] for k in of])
            self.keys[m] = [self.walks[n].keys(whole[:, at:at + n]) for at, n in segments(m)]
            self.place[of] = np.arange(len(of))

    def hits(self, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, offset) of all seeds in texts that end at ``ends`` (per word)."""
        out = []
        for q, (gram, item, offset, member) in self.seeds.items():
            h = W.windows(hashes, q)
            at = np.flatnonzero(member[(h >> np.uint64(64 - BITS)).astype(np.int64)])
            at = at[at + q <= ends[at]]
            low = np.searchsorted(gram, h[at], "left")
            n = np.searchsorted(gram, h[at], "right") - low
            total = int(n.sum())
            which = np.repeat(low, n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            out.append((np.repeat(at, n), item[which], offset[which]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def match(self, found: W.Words) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, distance), the nearest run for each text and item."""
        lengths = np.diff(found.first)
        ends = np.repeat(found.first[1:], lengths)
        position, item, offset = self.hits(found.hashes, ends)
        if not len(position):
            return
        text = np.repeat(np.arange(len(lengths)), lengths)[position]
        _, group, count = np.unique(text * len(self.items) + item, return_inverse=True,
                                    return_counts=True)
        possible = np.flatnonzero(count[group] >= self.least[item])
        if not len(possible):
            return
        order = possible[np.argsort(group[possible], kind="stable")]
        pairs = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
        by_length: dict[int, list[np.ndarray]] = {}
        for part in pairs:
            by_length.setdefault(len(self.items[int(item[part[0]])]), []).append(part)
        for m, parts in by_length.items():  # all windows of one length are embedded together
            near = [self._starts(found, int(text[p[0]]), int(item[p[0]]), position[p] - offset[p])
                    for p in parts]
            counts = [len(n) for n in near]
            of = np.repeat([int(item[p[0]]) for p in parts], counts)
            bounds = np.array([[found.first[t], found.first[t + 1]] for t in
                               (int(text[p[0]]) for p in parts)])
            begin = np.concatenate(near)
            low, high = (np.repeat(bounds[:, c], counts)[:, None] for c in (0, 1))
            agree = np.zeros(len(begin), bool)
            for (offset_in, n), keys in zip(segments(m), self.keys[m], strict=True):
                at = begin[:, None] + (offset_in + np.arange(n))[None, :]
                windows = np.where((at >= low) & (at < high),
                                   found.hashes[np.clip(at, 0, len(found.hashes) - 1)], np.uint64(0))
                agree |= (self.walks[n].keys(windows) == keys[self.place[of]]).any(axis=1)
            for p, starts, yes in zip(parts, near, np.split(agree, np.cumsum(counts)[:-1]), strict=True):
                t, k = int(text[p[0]]), int(item[p[0]])
                first, last = int(found.first[t]), int(found.first[t + 1])
                hit = self._nearest(found.hashes[first:last], k, starts[yes] - first)
                if hit is not None:
                    yield t, k, *hit

    def _starts(self, found: W.Words, t: int, k: int, diagonals: np.ndarray) -> np.ndarray:
        """Where windows for a document and an item begin; they may lap over the document's ends."""
        m, edits = len(self.items[k]), self.edits[k]
        near = np.unique(diagonals[:, None] + np.arange(-edits, edits + 1)[None, :])
        return near[(near > found.first[t] - m) & (near < found.first[t + 1])]

    def _nearest(self, words: np.ndarray, k: int, starts: np.ndarray):
        """(start, end, distance) of the best run around the candidate windows, if near enough."""
        sequence, edits = self.items[k], self.edits[k]
        m, best, low, high = len(sequence), None, 0, -1
        for s in starts.tolist():
            if s >= 0 and np.array_equal(words[s:s + m], sequence):
                return s, s + m, 0
        for s in starts.tolist():  # overlapping candidates are verified together
            if high >= 0 and s - edits <= high:
                high = s + m + edits
                continue
            best = self._verify(words, k, low, high, best)
            low, high = s - edits, s + m + edits
        return self._verify(words, k, low, high, best)

    def _verify(self, words, k, low, high, best):
        if high < 0:
            return best
        low, high = max(0, low), min(len(words), high)
        distance, start, end = best_run(self.items[k], words[low:high])
        if distance <= self.edits[k] and (best is None or distance < best[2]):
            return low + start, low + end, distance
        return best


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list]:
    """Distinct items, in blocks that are safe to collect and to broadcast."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter(
        F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes))  # hashed parts are uneven; half full on average
    for part in range(n):
        yield items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == part).collect()


def matches(docs: DataFrame, benchmark: DataFrame, *, edit_share: float = EDIT_SHARE,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document and item that it contains: where, and at which distance."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                       F.xxhash64(docs["text"]).alias("text_key"), docs["text"].alias("text"))
    names = [part.split()[0] for part in MATCHES.split(", ")]

    def of(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(
            Items([r[0] for r in block], [r[1] for r in block], edit_share))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in (part for whole in batches for part in W.slices(whole, 2)):
                found = list(items.match(W.words_of(batch.column(2))))
                if found:
                    at = pa.array([f[0] for f in found])
                    columns = [batch.column(0).take(at), batch.column(1).take(at),
                               pa.array([items.ids[f[1]] for f in found], pa.int64())]
                    columns += [pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4)]
                    yield pa.RecordBatch.from_arrays(columns, names)

        return rows.mapInArrow(run, MATCHES)

    return reduce(DataFrame.union, [of(b) for b in _blocks(benchmark, block_bytes)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match, with the columns they came with."""
    names = fresh(docs.columns, "found_id", "found_key")
    found = matches(docs, benchmark).select("doc_id", "text_key").distinct().toDF(*names)
    return join_rows(docs, found, "left_anti")
