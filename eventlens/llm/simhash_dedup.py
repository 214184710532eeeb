"""Near-duplicates by SimHash: all fingerprints within a few bits of each other, by anchors.

A covering code is a set of words, the anchors, such that every word is within the covering radius of
one. Each fingerprint has a home, its nearest anchor. Two words within the threshold have anchors in
common: the home of one is within radius + threshold of the other. So a fingerprint is replicated to
every anchor that near, and each anchor compares those at home there with all that came.

On all 64 bits no code keeps both few replicas and small groups, so the fingerprint is cut into blocks
with a threshold of their own, chosen so that every near pair is near in one of them: thresholds
t1..tk with (t1 + 1) + ... + (tk + 1) > threshold. A block's code is a Hamming code on some of its
bits (perfect, radius 1) beside all words on the others; a block of threshold 0 has every word as its
anchor. ``COVERS`` lists them; ``cheapest`` takes the one with the least work for the number of
fingerprints, which changes the work and never the links.

Equal fingerprints are folded before anything is replicated. A pair is looked at in one place only: in
the first block where it is near, at the home of the smaller one. Anchors with many visitors are cut
into chunks, and each pair of chunks is a group of its own. A group returns a spanning forest of its
links, never all of them.

Defined results: a null text is empty; the fingerprint of a text without words is zero, and links
like any other; a null id joins in but never names a component unless alone; repeated rows are returned
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import arrow_map, materialize
from eventlens.llm.jaccard_join import components

SHINGLE = 4
SEED = 42
BITS = 64
THRESHOLD = 4
PIECE = 1 << 16
CHUNK = 4096
BLOCK = 1 << 20
SMALL = 512


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """A bit is set if it is in more than half of the hashes of the text's shingles, repeats included."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    size = min(size, len(found))
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    low, high = starts[:len(starts) - size + 1], ends[size - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(low), PIECE):
        part = zip(low[at:at + PIECE].tolist(), high[at:at + PIECE].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in part), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(low), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, print), the fingerprint as a signed number."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, of, "doc_id bigint, print bigint", text=1)


class Block(NamedTuple):
    """Some bits of the fingerprint, a Hamming code of ``parity`` checks on the first of them."""

    low: int
    bits: int
    parity: int
    threshold: int

    def of(self, prints: np.ndarray) -> np.ndarray:
        return (prints >> np.uint64(self.low)) & np.uint64((1 << self.bits) - 1)

    def near(self, differing: np.ndarray) -> np.ndarray:
        """Whether two fingerprints with these differing bits are within the block's threshold."""
        return np.bitwise_count(self.of(differing)) <= self.threshold

    @property
    def coded(self) -> int:
        return (1 << self.parity) - 1

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for j in range(self.parity):
            mask = sum(1 << (k - 1) for k in range(1, self.coded + 1) if k >> j & 1)
            out |= (np.bitwise_count(words & np.uint64(mask)) & 1).astype(np.int64) << j
        return out

    def patterns(self) -> list[np.ndarray]:
        """By syndrome: the changes that lead to an anchor within radius + threshold; the home's first."""
        reach = self.threshold + bool(self.parity)
        found: list[list[tuple]] = [[] for _ in range(1 << self.parity)]
        for weight in range(reach + 1):
            for places in itertools.combinations(range(self.bits), weight):
                syndrome = 0
                for p in places:
                    syndrome ^= p + 1 if p < self.coded else 0
                at_home = weight <= 1 and all(p < self.coded for p in places)
                found[syndrome].append((not at_home, sum(1 << p for p in places)))
        return [np.array([e for _, e in sorted(f)], np.uint64) for f in found]

    def replicas(self) -> float:
        return sum(len(p) for p in self.patterns()) / (1 << self.parity)

    def share(self) -> float:
        """The part of unrelated fingerprints that a home meets."""
        reach = self.threshold + bool(self.parity)
        words = sum(len(list(itertools.combinations(range(self.bits), w))) for w in range(reach + 1))
        return words / 2**self.bits


def _cover(*blocks: tuple[int, int, int]) -> tuple[Block, ...]:
    lows = itertools.accumulate((b[0] for b in blocks), initial=0)
    return tuple(Block(low, *b) for low, b in zip(lows, blocks, strict=False))


#: (bits, parity, threshold) of each block; from few replicas to small groups.
COVERS = (_cover((22, 4, 1), (22, 4, 1), (20, 0, 0)), _cover((34, 5, 2), (30, 4, 1)))
#: What a replica costs, in comparisons: it is sorted and shuffled.
REPLICA = 1_000


def covers(cover: tuple[Block, ...], threshold: int) -> bool:
    """Whether every pair within the threshold is within that of some block."""
    return sum(b.bits for b in cover) == BITS and sum(b.threshold + 1 for b in cover) > threshold


def cheapest(n: int) -> tuple[Block, ...]:
    """The cover with the least work for ``n`` distinct fingerprints."""
    return min(COVERS, key=lambda c: sum(n * REPLICA * b.replicas() + float(n) * n * b.share() for b in c))


def visits(prints: DataFrame, cover: tuple[Block, ...]) -> DataFrame:
    """(anchor, home, print): a row for each anchor within reach, and one more at its home.

    The number of the block is part of ``anchor``.
    """
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy().view(np.uint64)
        anchors, owners, homes = [], [], []
        for number, block in enumerate(cover):
            words = block.of(values)
            syndromes = block.syndromes(words)
            for syndrome, changes in enumerate(block.patterns()):
                mine = np.flatnonzero(syndromes == syndrome)
                near = (words[mine][:, None] ^ changes[None, :]) | np.uint64(number << 56)
                anchors += [near.ravel(), near[:, 0]]
                owners += [np.repeat(values[mine], len(changes)), values[mine]]
                homes += [np.zeros(near.size, bool), np.ones(len(mine), bool)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(anchors).view(np.int64)), pa.array(np.concatenate(homes)),
             pa.array(np.concatenate(owners).view(np.int64))], ["anchor", "home", "print"])

    return arrow_map(prints.select("print"), of, "anchor bigint, home boolean, print bigint")


def _forest(homes: np.ndarray, guests: np.ndarray, number: int, cover: tuple[Block, ...],
            threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all that is linked in a group, one less than members; breadth first.

    Each member is compared once, with those not yet reached, so a crowd of relatives is cheap.
    """
    members = np.union1d(homes, guests)
    at_home = np.isin(members, homes, assume_unique=True)
    came = np.isin(members, guests, assume_unique=True)
    left, out = np.arange(len(members)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            y = members[left]
            after = y > members[x]
            apart = y ^ members[x]
            linked = _linked(apart, number, cover, threshold) & np.where(
                after, at_home[x] & came[left], came[x] & at_home[left])
            hits = left[linked]
            if len(hits):
                out.append((np.repeat(members[x], len(hits)), members[hits]))
                queue.extend(hits.tolist())
                left = left[~linked]
    return out


def _linked(apart: np.ndarray, number: int, cover: tuple[Block, ...], threshold: int) -> np.ndarray:
    """Near, near in this block, and in none before it."""
    ok = (np.bitwise_count(apart) <= threshold) & cover[number].near(apart)
    for block in cover[:number]:
        ok &= ~block.near(apart)
    return ok


def _links(cover: tuple[Block, ...], threshold: int):
    """Over rows sorted by group; holds a batch, and what has come of the last group."""
    def forests(keys: np.ndarray, homes: np.ndarray, prints: np.ndarray) -> Iterator[tuple]:
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(prints)]])
        sizes = np.diff(cuts)
        at_home = np.add.reduceat(homes.astype(np.int64), cuts[:-1])
        work = at_home * (sizes - at_home)
        for g in np.flatnonzero(work > SMALL):
            low, high = cuts[g], cuts[g + 1]
            inside, own = prints[low:high], homes[low:high]
            yield from _forest(np.unique(inside[own]), np.unique(inside[~own]), int(keys[low, 0] >> 56),
                               cover, threshold)
        # All pairs of many small groups at once.
        small = np.flatnonzero((work > 0) & (work <= SMALL))
        for first in range(0, len(small), BLOCK // SMALL):
            groups = small[first:first + BLOCK // SMALL]
            counts = work[groups]
            group = np.repeat(groups, counts)
            k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            guests = (sizes - at_home)[group]
            # Within a group guests come first, then those at home.
            a = prints[cuts[group] + guests + k // guests]
            b = prints[cuts[group] + k % guests]
            number = keys[cuts[group], 0] >> 56
            close = np.flatnonzero((a < b) & (np.bitwise_count(a ^ b) <= threshold))
            for n in range(len(cover)):
                at = close[number[close] == n]
                at = at[_linked(a[at] ^ b[at], n, cover, threshold)]
                if len(at):
                    yield _thin(group[at], a[at], b[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or held.num_rows == 0:
                continue
            keys = np.stack([held[c].to_numpy() for c in ("anchor", "h", "g")], axis=1)
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            upto = held.num_rows if batch is None else int(new[-1]) if len(new) else 0
            if upto:
                done = held.slice(0, upto)
                found = list(forests(keys[:upto], done["home"].to_numpy(),
                                     done["print"].to_numpy().view(np.uint64)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(side).view(np.int64)) for side in zip(*found, strict=True)],
                        ["a", "b"])
            held = held.slice(upto)

    return run


def _thin(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of each group's links."""
    parent: dict[tuple[int, int], tuple[int, int]] = {}

    def top(x: tuple[int, int]) -> tuple[int, int]:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up] if up in parent else up
            x = up
        return x

    keep = []
    for k, (g, x, y) in enumerate(zip(group.tolist(), a.tolist(), b.tolist(), strict=True)):
        p, q = top((g, x)), top((g, y))
        if p != q:
            parent[p] = q
            keep.append(k)
    return a[keep], b[keep]


def links(prints: DataFrame, cover: tuple[Block, ...], threshold: int = THRESHOLD,
          chunk: int = CHUNK) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are linked."""
    if not covers(cover, threshold):
        raise ValueError("the cover misses pairs within the threshold")
    rows = visits(prints, cover)
    # Only anchors with more rows than a chunk are cut; nobody at home: nothing to compare.
    sizes = (rows.groupBy("anchor")
             .agg(F.sum(F.col("home").cast("bigint")).alias("homes"), F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > chunk)
             .select("anchor", F.ceil(F.col("homes") / chunk).cast("int").alias("hs"),
                     F.ceil((F.col("n") - F.col("homes")) / chunk).cast("int").alias("gs")))
    mine = F.xxhash64("print")
    dealt = (rows.join(sizes, "anchor", "left").fillna(1, ["hs", "gs"]).filter("hs > 0")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("gs"))
                                                       .otherwise(F.col("hs")) - 1)))
             .withColumn("h", F.when(F.col("home"), F.pmod(mine, F.col("hs")).cast("int")).otherwise(F.col("other")))
             .withColumn("g", F.when(F.col("home"), F.col("other")).otherwise(F.pmod(mine, F.col("gs")).cast("int")))
             .select("anchor", "h", "g", "home", "print"))
    return (dealt.repartition("anchor", "h", "g").sortWithinPartitions("anchor", "h", "g", "home")
            .mapInArrow(_links(cover, threshold), "a bigint, b bigint"))


def cluster(docs: DataFrame, *, size: int = SHINGLE, threshold: int = THRESHOLD,
            cover: tuple[Block, ...] | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    marked = materialize(fingerprints(docs, size))
    prints = materialize(marked.groupBy("print").agg(F.min("doc_id").alias("low")))
    found = materialize(links(prints, cover or cheapest(prints.count()), threshold))
    labels = components(found).toDF("print", "component")
    named = prints.join(labels, "print")
    least = named.groupBy("component").agg(F.min("low").alias("least"))
    names = materialize(named.join(least, "component").select("print", "least"))
    known = prints.join(names, "print", "left").select("print", F.coalesce("least", "low").alias("component_id"))
    return (marked.join(known, "print")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))
