"""Language-model scoring by cross-entropy difference, with a compact model that fits a task.

``lm_counts`` scores a corpus with its exact counts; the model here has hashed classes of a fixed
number and is for scoring other documents than those it was trained on.

Two bigram models share one vocabulary (words hashed into ``2**word_bits`` classes), one order, one
smoothing and one token total: the target model counts the documents labelled good (quality 1, not
toxic), the background model counts all others, and its counts are scaled to the target's total.
A document's score is the mean over its tokens of the target's loss less the background's loss, in
nats; a document like the target scores below 0.

    p(w | v) = r c(v, w) / c(v) + (1 - r) (c(w) + a) / (N + a V),   r = ``interpolation``

Each task counts its rows into arrays of fixed length and sends them in chunks; chunks are summed
where they meet, so what travels is bounded by tasks times model size, whatever the skew. The
model's size is fixed by ``word_bits`` and ``pair_bits``; that is what is broadcast.

Defined results: a null or blank text has no tokens and null losses; a document without a label is
background; several labels of one id are one (the best quality, toxic if any says so); with an
empty target or background that model is uniform; a null id is never labelled; repeated rows are
counted and scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W
from eventlens.llm.common import arrow_map
from eventlens.llm.lm_counts import cross_entropy_difference

__all__ = ["Model", "Tokens", "cross_entropy_difference", "score", "tokens_of", "train"]

WORD_BITS = 17
PAIR_BITS = 20
INTERPOLATION = 0.6
ADDED = 0.1
CHUNK = 1 << 13
MAX_BROADCAST_IDS = 1_000_000
SCORES = ("doc_id bigint, n_tokens bigint, target_loss double, background_loss double, "
          "score double")


class Tokens(NamedTuple):
    """Word classes, pair classes, and the text each token belongs to."""

    words: np.ndarray
    pairs: np.ndarray  # of a word and the one before it; the first word's is that with no word
    text: np.ndarray
    firsts: np.ndarray


def tokens_of(column: pa.Array, word_bits: int, pair_bits: int) -> Tokens:
    found = W.words_of(column)
    lengths = np.diff(found.first)
    before = np.concatenate([np.zeros(1, np.uint64), found.hashes[:-1]])[:len(found.hashes)]
    firsts = np.zeros(len(found.hashes), bool)
    firsts[found.first[:-1][lengths > 0]] = True
    before[firsts] = 0
    with np.errstate(over="ignore"):
        pairs = W.finish(before * np.uint64(0x9E3779B97F4A7C15) + found.hashes)
    return Tokens((found.hashes >> np.uint64(64 - word_bits)).astype(np.int64),
                  (pairs >> np.uint64(64 - pair_bits)).astype(np.int64),
                  np.repeat(np.arange(len(lengths)), lengths), firsts)


class Model:
    """Both models' counts, in one array each: word classes, then pair classes, then the starts."""

    def __init__(self, target: np.ndarray, background: np.ndarray, word_bits: int, pair_bits: int):
        self.word_bits, self.pair_bits = word_bits, pair_bits
        self.counts = [target.astype(np.float32), background.astype(np.float32)]

    def losses(self, tokens: Tokens, interpolation: float = INTERPOLATION,
               added: float = ADDED) -> list[np.ndarray]:
        v = 1 << self.word_bits
        totals = [float(c[:v].sum(dtype=np.float64)) for c in self.counts]
        history = np.where(tokens.firsts, 0, np.concatenate([[0], tokens.words[:-1]])[:len(tokens.words)])
        out = []
        for counts, total in zip(self.counts, totals, strict=True):
            # Matched models: the background's counts are scaled to the target's total.
            scale = totals[0] / total if total and totals[0] else 1.0
            word = counts[tokens.words].astype(np.float64) * scale
            pair = counts[v + tokens.pairs].astype(np.float64)
            seen = np.where(tokens.firsts, float(counts[-1]), counts[history].astype(np.float64))
            plain = (word + added) / (total * scale + added * v)
            ratio = np.minimum(1.0, pair / np.maximum(seen, 1.0))
            mixed = np.where(seen > 0, interpolation * ratio + (1 - interpolation) * plain, plain)
            out.append(-np.log(mixed))
        return out


def _counter(word_bits: int, pair_bits: int):
    size = (1 << word_bits) + (1 << pair_bits) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int32)
        for batch in (part for whole in batches for part in W.slices(whole, 0)):
            tokens = tokens_of(batch.column(0), word_bits, pair_bits)
            if not len(tokens.words):
                continue
            target = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)[tokens.text]
            for row, mask in ((0, target), (1, ~target)):
                counts[row, :1 << word_bits] += np.bincount(
                    tokens.words[mask], minlength=1 << word_bits).astype(np.int32)
                counts[row, 1 << word_bits:-1] += np.bincount(
                    tokens.pairs[mask], minlength=1 << pair_bits).astype(np.int32)
                counts[row, -1] += int((tokens.firsts & mask).sum())
        starts = [s for s in range(0, size, CHUNK) if counts[:, s:s + CHUNK].any()]
        if starts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(starts, pa.int32())] + [
                    pa.array([counts[k, s:s + CHUNK].tobytes() for s in starts], pa.binary())
                    for k in (0, 1)], ["start", "target", "background"])

    return run


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the chunks of a task's rows; the number of different chunks is fixed."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for start, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = [np.frombuffer(p, np.int32 if batch.schema.field(1).name == "target" else np.int64)
                     .astype(np.int64) for p in parts]
            if start in sums:
                sums[start] = [a + b for a, b in zip(sums[start], found, strict=True)]
            else:
                sums[start] = found
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32())] + [
                pa.array([s[k].tobytes() for s in sums.values()], pa.binary()) for k in (0, 1)],
            ["start", "target_sum", "background_sum"])


def train(docs: DataFrame, labels: DataFrame, *, word_bits: int = WORD_BITS,
          pair_bits: int = PAIR_BITS) -> Model:
    """Counts all documents; the model comes to the driver, its size fixed by its parameters."""
    judged = labels.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max(F.coalesce("quality", F.lit(0))).alias("_quality"),
        F.max(F.coalesce("toxic", F.lit(0))).alias("_toxic"))
    good = judged.filter("_quality = 1 AND _toxic = 0").select("_id", F.lit(True).alias("_good"))
    # Ids are narrow and texts are not: below the bound texts stay where they are, beyond it both
    # are shuffled.
    if good.count() <= MAX_BROADCAST_IDS:
        good = F.broadcast(good)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(
        good, "_id", "left").select("text", F.coalesce("_good", F.lit(False)).alias("target"))
    chunks = rows.mapInArrow(_counter(word_bits, pair_bits),
                             "start int, target binary, background binary")
    size = (1 << word_bits) + (1 << pair_bits) + 1
    sums = chunks.repartition("start").mapInArrow(
        _sum_chunks, "start int, target_sum binary, background_sum binary")
    counts = np.zeros((2, size), np.int64)
    for start, *parts in sums.collect():  # size / CHUNK rows
        for k, part in enumerate(parts):
            counts[k, start:start + len(part) // 8] = np.frombuffer(part, np.int64)
    return Model(counts[0], counts[1], word_bits, pair_bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: tokens, mean loss under each model, and their difference."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        tokens = tokens_of(batch.column(1), model.word_bits, model.pair_bits)
        n = np.bincount(tokens.text, minlength=batch.num_rows)
        means = [np.bincount(tokens.text, x, batch.num_rows) / np.maximum(n, 1)
                 for x in model.losses(tokens)]
        columns = [batch.column(0), pa.array(n, pa.int64())]
        columns += [pa.array(x, pa.float64(), mask=n == 0)
                    for x in (*means, means[0] - means[1])]
        return pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return arrow_map(rows, of, SCORES, text=1)
