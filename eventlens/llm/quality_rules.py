"""Quality rules with cross-document line frequency.

Base rules look at one document: too few words, or too many words in repeated 8-word windows.
The method's rule looks across documents. Lines are normalised (A-Z lowered, white space folded)
and hashed; per host the *distinct* documents that hold a line are counted. Lines held by more
than ``max_share`` of a host's documents (and by ``min_docs`` at least) are removed, and a
document is rejected when less than ``min_left`` of its words remain.

Copies are not evidence that a line is boilerplate: documents with the same set of lines count
once, by a hash over all of their lines. Without that, a large group of copies would reject itself
before deduplication has kept one of them. Documents that differ in any line are different ones.

Defined results: a null or blank text has no words, so it fails the base rules; a null host is a
host of its own; a null id is carried; repeated rows are judged each and alike; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import arrow_map, fresh, join_rows, materialize

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
MAX_SHARE = 0.05
MIN_DOCS = 20
MIN_LEFT = 0.3

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WEIGHTS = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)

FEATURES = (
    "doc_id bigint, host string, text_key bigint, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, family bigint, "
    "lines array<bigint>, line_words array<int>"
)


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at two places or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    quick = np.fromiter((hash(w) for w in words), np.int64, len(words)).view(np.uint64)
    mixed = sum(quick[j:j + n] * _WEIGHTS[j] for j in range(size)) if size == WINDOW else None
    if mixed is not None and np.unique(mixed).size == n:
        return 0  # equal windows have equal hashes, so none are equal
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    width = 1
    while width < size:  # ids of windows of 2, 4, 8 words: exact, by pairs of smaller ones
        step = min(width, size - width)
        pairs = ids[:len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width += step
    twice = np.bincount(ids)[ids] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + size, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def line_key(line: bytes) -> int:
    """60 bits of the line's MD5."""
    return int.from_bytes(hashlib.md5(line, usedforsecurity=False).digest()[:8], "big") >> 4


def family_of(keys: list[int]) -> int:
    """60 bits that name a set of lines, whatever their order; 0 for none."""
    return line_key(b",".join(b"%d" % k for k in sorted(keys))) if keys else 0


def features_of(text: str | None) -> tuple:
    """Base figures of one text, and its distinct normalised lines with their words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    word_chars = len(text) - sum(text.count(c) for c in SPACE)
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    spoken = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_dup_lines = len(spoken) - len(set(spoken))
    lines: dict[bytes, int] = {}
    for x in raw.translate(_LOWER).split(b"\n"):
        if parts := x.split():
            key = b" ".join(parts)
            lines[key] = lines.get(key, 0) + len(parts)
    keys = [line_key(x) for x in lines]
    return (len(words), word_chars, n_symbols, n_dup_lines, repeat_words(words),
            family_of(keys), keys, list(lines.values()))


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [features_of(t) for t in batch.column(3).to_pylist()]
    columns = list(zip(*found, strict=True))
    arrays = [batch.column(0), batch.column(1), batch.column(2)]
    arrays += [pa.array(columns[k], pa.int64()) for k in range(6)]
    arrays += [pa.array(columns[6], pa.list_(pa.int64())), pa.array(columns[7], pa.list_(pa.int32()))]
    names = [part.split()[0] for part in FEATURES.split(", ")]
    return pa.RecordBatch.from_arrays(arrays, names)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def judge(
    docs: DataFrame,
    host: Column | None = None,
    *,
    max_share: float = MAX_SHARE,
    min_docs: int = MIN_DOCS,
    min_left: float = MIN_LEFT,
    keep: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """One row per document: base figures, words in removed lines, the verdict.

    ``text_key`` (a hash of the text) tells rows of one id apart.
    """
    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(host if host is not None else F.col("source"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_key"), text.alias("text"))
    # The narrow features serve three passes; the text is read and parsed once.
    features = keep(arrow_map(rows, _features, FEATURES, text=3)
                    .withColumn("row_id", F.monotonically_increasing_id()))
    lines = features.select(
        "row_id", "host", "family",
        F.explode(F.arrays_zip("lines", "line_words")).alias("l")
    ).select("row_id", "host", "family", F.col("l.lines").alias("line"),
             F.col("l.line_words").alias("words"))
    # Rows bound distinct documents from above, and combine before the shuffle.
    many = (lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_docs).select("host", "line"))
    hosts = features.groupBy("host").agg(F.countDistinct("family").alias("n_host"))
    frequent = (
        lines.join(many, ["host", "line"], "left_semi")
        .groupBy("host", "line").agg(F.countDistinct("family").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .join(hosts, "host")
        .filter(F.col("n_docs") > F.col("n_host") * max_share)
        .select("host", "line"))
    removed = (lines.join(frequent, ["host", "line"], "left_semi")
               .groupBy("row_id").agg(F.sum("words").alias("n_removed_words")))
    judged = features.join(removed, "row_id", "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("bigint"))
    left = F.col("n_words") - F.col("n_removed_words")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (left >= F.col("n_words") * min_left)).alias("kept"),
        "n_removed_words", "text_key")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    names = fresh(docs.columns, "kept_id", "kept_key")
    passed = judge(docs).filter("kept").select("doc_id", "text_key").distinct().toDF(*names)
    return join_rows(docs, passed, "left_semi")
