"""Cross-entropy difference with exact n-gram counts of the whole corpus, wherever they are needed.

Two bigram models share one vocabulary (the distinct words of all documents), one order, one smoothing
and one token total: the target model counts the documents labelled good, the background model all
others, and its counts are scaled to the target's total. A document's score is the mean over its
tokens of the target's loss less the background's loss, in nats.

    p(w | v) = r c(v, w) / c(v) + (1 - r) (c(w) + a) / (N + a V),   r = ``interpolation``

The counts are a distributed table and never a model that one task or the driver holds:

1. documents are dealt to blocks of a few megabytes by a hash of id and text; a block counts its own
   words and pairs of words, each side's, and sends them, sorted by their hash, in pieces to the
   buckets that the hash values are cut into;
2. a bucket adds up what all blocks have sent and answers each piece with the corpus's counts;
3. a block meets its answers, which follow the order of its own sorted hashes, and scores its
   documents.

All of this is one plan: the texts are shuffled to their blocks once and the requests to their buckets once,
and whatever reads them again reuses the exchange.

So a frequent pair is sent once per block, no bucket depends on how often its words occur, and what is
gathered grows with the corpus. Hashes have ``SPARE_BITS`` more bits than it takes to number the
corpus's bytes: at any size about one n-gram in a million shares its count with another one.

Defined results: a null or blank text has no tokens and null losses; a document without a label is
background; several labels of one id are one (the best quality, toxic if any says so); with an empty
target or background that model is uniform; a null id is never labelled; repeated rows are counted
and scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W

INTERPOLATION = 0.6
ADDED = 0.1
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
SPARE_BITS = 20
MAX_BITS = 62
MAX_BROADCAST_IDS = 1_000_000
SCORES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"
REQUESTS = ("bucket bigint, block bigint, n bigint, keys binary, target binary, background binary, "
            "target_tokens bigint, background_tokens bigint")
REPLIES = "block bigint, bucket bigint, n bigint, target binary, background binary"
TOTALS = "words bigint, target_tokens bigint, background_tokens bigint"


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers, byte planes apart so that leading zeros cost nothing, compressed."""
    return pa.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


class Grams:
    """The words and pairs of a block's texts: distinct keys in order, and where each token's are.

    A key is a hash with the kind as its last bit: 0 for a word, 1 for a pair. What stands before a
    text's first word is a word of its own, which is no token.
    """

    START = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, texts: pa.Array, bits: int):
        found = W.words_of(texts)
        lengths = np.diff(found.first)
        n = len(found.hashes)
        self.text = np.repeat(np.arange(len(lengths)), lengths)
        self.firsts = np.zeros(n, bool)
        self.firsts[found.first[:-1][lengths > 0]] = True
        before = np.concatenate([np.zeros(1, np.uint64), found.hashes[:-1]])[:n]
        before[self.firsts] = self.START
        with np.errstate(over="ignore"):
            pairs = W.finish(before * np.uint64(0xD1342543DE82EF95) + found.hashes)
            start = W.finish(np.array([self.START]))
        drop = np.uint64(65 - bits)
        keys = [(h >> drop) << np.uint64(1) | np.uint64(kind)
                for h, kind in ((found.hashes, 0), (pairs, 1), (start[:int(n > 0)], 0))]
        self.keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        self.word, self.pair, self.start = place[:n], place[n:2 * n], place[2 * n:]

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Of each key, over the tokens of the texts where ``mask`` holds."""
        size, of = len(self.keys), mask[self.text]
        out = np.bincount(self.word[of], minlength=size) + np.bincount(self.pair[of], minlength=size)
        out[self.start] += int((self.firsts & of).sum())
        return out

    def losses(self, counts: np.ndarray, total: float, scale: float, vocabulary: int,
               interpolation: float, added: float) -> np.ndarray:
        """The loss of each token, from the corpus's counts of this block's keys."""
        word = counts[self.word].astype(np.float64)
        seen = np.concatenate([[0.0], word[:-1]])[:len(word)]
        seen[self.firsts] = counts[self.start].astype(np.float64).sum()
        plain = (word * scale + added) / (total * scale + added * vocabulary)
        ratio = np.minimum(1.0, counts[self.pair] / np.maximum(seen, 1.0))
        return -np.log(np.where(seen > 0, interpolation * ratio + (1 - interpolation) * plain, plain))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(block, its rows) of rows that come sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if batch is None or batch.num_rows:
            block = None if batch is None else batch.column(0).to_numpy()
            if held and (batch is None or block[0] != held[0].column(0)[0].as_py()):
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            if batch is None:
                return
            cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]).tolist()
            for low, high in itertools.pairwise(cuts):
                if low:
                    yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(low, high - low))


def _request(bits: int, bucket_bits: int):
    names = [f.split()[0] for f in REQUESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            texts = rows["text"].combine_chunks()
            grams = Grams(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts, bits)
            if not len(grams.keys):
                continue
            target = rows["target"].to_numpy()
            sides = [grams.counts(target), grams.counts(~target)]
            tokens = [int(target[grams.text].sum()), int((~target)[grams.text].sum())]
            bucket = (grams.keys >> np.uint64(bits - bucket_bits)).astype(np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]).tolist()
            out = [(int(bucket[a]), block, b - a, pack_sorted(grams.keys[a:b]), pack(sides[0][a:b]), pack(sides[1][a:b]),
                    *(tokens if a == 0 else (0, 0))) for a, b in itertools.pairwise(cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    return run


def _reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the requests of each bucket and answers them."""
    names = [f.split()[0] for f in REPLIES.split(", ")]
    for bucket, rows in _blocks(batches):
        sizes = rows["n"].to_pylist()
        parts = [unpack_sorted(k, n) for k, n in zip(rows["keys"].to_pylist(), sizes, strict=True)]
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        totals = []
        for side in ("target", "background"):
            own = np.concatenate([unpack(c, n) for c, n in zip(rows[side].to_pylist(), sizes, strict=True)])
            # Exact: counts are far below 2**53.
            totals.append(np.bincount(place, own.astype(np.float64), len(keys)).astype(np.uint64)[place])
        out, at = [], 0
        for block, n in zip(rows["block"].to_pylist(), sizes, strict=True):
            out.append((block, bucket, n, *(pack(t[at:at + n]) for t in totals)))
            at += n
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each bucket, and the tokens of the blocks whose first request it has."""
    names = [f.split()[0] for f in TOTALS.split(", ")]
    for _, rows in _blocks(batches):
        parts = (unpack_sorted(k, n) for k, n in zip(rows["keys"].to_pylist(), rows["n"].to_pylist(), strict=True))
        words = len(np.unique(np.concatenate([p[p & np.uint64(1) == 0] for p in parts])))
        tokens = [sum(rows[c].to_pylist()) for c in names[1:]]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (words, *tokens)], names)


def _score(bits: int, interpolation: float, added: float):
    names = [f.split()[0] for f in SCORES.split(", ")]

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        texts = docs["text"].combine_chunks()
        grams = Grams(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts, bits)
        n = np.bincount(grams.text, minlength=docs.num_rows)
        replies = replies.sort_by("bucket")
        # A block without replies has no tokens. The start is counted like a word, so it is taken off.
        words, *totals = (replies[c][0].as_py() if replies.num_rows else 0 for c in (
            f.split()[0] for f in TOTALS.split(", ")))
        means = []
        for side, total in zip(("target", "background"), totals, strict=True):
            parts = [unpack(c, k) for c, k in zip(replies[side].to_pylist(), replies["n"].to_pylist(), strict=True)]
            counts = np.concatenate([np.zeros(0, np.uint64), *parts])
            if len(counts) != len(grams.keys):
                raise RuntimeError("a block has other rows than when it was counted")
            scale = totals[0] / total if total and totals[0] else 1.0
            losses = grams.losses(counts, total, scale, max(0, words - 1), interpolation, added)
            means.append(np.bincount(grams.text, losses, docs.num_rows) / np.maximum(n, 1))
        columns = [docs["doc_id"], pa.array(n, pa.int64())]
        columns += [pa.array(x, pa.float64(), mask=n == 0) for x in (*means, means[0] - means[1])]
        return pa.table(columns, names)

    return run


def with_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, target): whether an id is labelled good and not toxic."""
    judged = labels.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max(F.coalesce("quality", F.lit(0))).alias("_quality"),
        F.max(F.coalesce("toxic", F.lit(0))).alias("_toxic"))
    good = judged.filter("_quality = 1 AND _toxic = 0").select("_id", F.lit(True).alias("_good"))
    # Ids are narrow and texts are not: below the bound texts stay where they are, beyond it both
    # are shuffled.
    if good.count() <= MAX_BROADCAST_IDS:
        good = F.broadcast(good)
    return docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text")).join(
        good, "_id", "left").select(F.col("_id").alias("doc_id"), "text", F.coalesce("_good", F.lit(False)).alias("target"))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, *, interpolation: float = INTERPOLATION,
                             added: float = ADDED, block_bytes: int = BLOCK_BYTES,
                             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: tokens, mean loss under each model, and their difference."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = min(MAX_BITS, SPARE_BITS + max(1, size).bit_length())
    bucket_bits = min(max(0, (size // bucket_bytes).bit_length()), bits - 2)
    rows = with_target(docs, labels).select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // block_bytes + 1)).alias("block"), "doc_id", "text", "target",
    ).repartition("block")
    requests = (rows.sortWithinPartitions("block").mapInArrow(_request(bits, bucket_bits), REQUESTS)
                .repartition("bucket").sortWithinPartitions("bucket"))
    totals = requests.mapInArrow(_totals, TOTALS).agg(*(
        F.sum(c).alias(c) for c in (f.split()[0] for f in TOTALS.split(", "))))
    replies = requests.mapInArrow(_reply, REPLIES).crossJoin(F.broadcast(totals))
    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _score(bits, interpolation, added), SCORES)
