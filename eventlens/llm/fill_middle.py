"""Fill-in-the-middle: texts cut in three, the middle put last behind marks, and back again.

A document is sent as pieces of at most ``CHUNK`` code points, each under the document's row and its
place in the output. One shuffle brings a row's pieces together and a sort within the partition puts
them in output order, so what comes out streams: a digest, or a text, takes piece after piece. For
restoration the marks are looked for in the stream itself, across the borders of pieces, which says
what is prefix, suffix and middle; these pieces are sorted anew within the same partition, by their
place in the document, and stream once more. No task holds more than pieces, whatever a text's length.

Rows are told apart by their place in the partition they are read from, so repeated ids, and rows
without one, are dealt out evenly. That asks for a table that is read in the same order if a task
runs again, as Parquet tables are; write other frames first.

Defined results: a null text is empty; a null id counts as the empty string in the hash; an empty text
and one that holds a mark stay plain; repeated rows are returned each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT = 10
SPM_PERCENT = 20
CHUNK = 1 << 14
SEED = 1
ROWS_OUT, TEXT_OUT = 4096, 4 << 20

_HEAD = "row_id bigint, doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"{_HEAD}, place bigint, text string"
#: ``digest`` closes a document: the last piece of each has it.
RESTORED = f"{_HEAD}, part int, place bigint, text string, output_sha256 string"


class Cut(NamedTuple):
    """How a text of n code points is arranged; prefix and middle are null when it stays plain."""

    form: str
    prefix: int | None
    middle: int | None

    def spans(self, n: int) -> list[tuple[str, int, int]]:
        """(mark, from, to) in output order."""
        if self.form == "plain":
            return [("", 0, n)]
        after = self.prefix + self.middle
        prefix, suffix = (PREFIX, 0, self.prefix), (SUFFIX, after, n)
        first = [prefix, suffix] if self.form == "psm" else [suffix, prefix]
        return [*first, (MIDDLE, self.prefix, after)]


def cut_of(doc_id: int | None, text: str, seed: int = SEED) -> Cut:
    """Decided by the id alone, so that it is the same wherever the document is met."""
    hashed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hashed[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or h3 % 100 >= 100 - PLAIN_PERCENT or any(m in text for m in MARKS):
        return Cut("plain", None, None)
    low, high = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return Cut("spm" if h4 % 100 < SPM_PERCENT else "psm", low, high - low)


class _Out:
    """Rows on their way out, in batches of bounded size; the text is the column ``text``."""

    def __init__(self, schema: str, text: int):
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        self.schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in schema.split(", "))])
        self.text, self.rows, self.size = text, [], 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.size += len(row[self.text] or "")

    def full(self) -> bool:
        return len(self.rows) >= ROWS_OUT or self.size >= TEXT_OUT

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def _rows(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple]:
    for batch in batches:
        for part in W.slices(batch, text):
            yield from zip(*(part.column(k).to_pylist() for k in range(part.num_columns)), strict=True)


def transform(docs: DataFrame, *, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """The pieces of all outputs: (row_id, doc_id, n, form, prefix_chars, middle_chars, place, text).

    The pieces of a row are side by side, in output order; ``place`` counts code points of the output,
    and a mark leads the piece behind it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(PIECES, 7)
        for row_id, doc_id, text in _rows(batches, 2):
            text = text or ""
            cut = cut_of(doc_id, text, seed)
            place = 0
            for mark, low, high in cut.spans(len(text)):
                for at in range(low, max(high, low + 1), chunk):
                    piece = (mark if at == low else "") + text[at:min(at + chunk, high)]
                    out.add(row_id, doc_id, len(text), *cut, place, piece)
                    place += len(piece)
                    if out.full():
                        yield out.take()
        yield out.take()

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(run, PIECES).repartition("row_id").sortWithinPartitions("row_id", "place"))


def texts(pieces: DataFrame, place: str = "place") -> DataFrame:
    """(row_id, doc_id, form, text): the whole text of each row of pieces, in the order of ``place``."""
    return (pieces.groupBy("row_id", "doc_id", "form")
            .agg(F.array_sort(F.collect_list(F.struct(place, "text"))).alias("parts"))
            .select("row_id", "doc_id", "form", F.array_join("parts.text", "").alias("text")))


class Splitter:
    """Follows an output from piece to piece and says which part of the document each bit belongs to.

    A mark may begin in one piece and end in a later one, so what could be the start of one waits.
    """

    PARTS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

    def __init__(self, form: str):
        self.form, self.part, self.rest = form, 0, ""

    def feed(self, piece: str) -> list[tuple[int, str]]:
        """(part, text) in the order they come; part 0 is the prefix, 1 the middle, 2 the suffix."""
        if self.form == "plain":
            return [(0, piece)]
        out, text = [], self.rest + piece
        while (at := min((k for k in map(text.find, MARKS) if k >= 0), default=-1)) >= 0:
            out.append((self.part, text[:at]))
            self.part, text = self.PARTS[text[at:at + 3]], text[at + 3:]
        keep = next((k for k in (2, 1) if any(m.startswith(text[-k:]) for m in MARKS) and len(text) >= k), 0)
        self.rest = text[len(text) - keep:]
        return [(p, t) for p, t in [*out, (self.part, text[:len(text) - keep])] if t]

    def end(self) -> list[tuple[int, str]]:
        return [(self.part, self.rest)] if self.rest else []


def _restoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order to pieces of the document; a last one per row has the output's digest."""
    out, head, split, sha, place = _Out(RESTORED, 8), None, None, None, 0

    def leave(found: list[tuple[int, str]]) -> None:
        nonlocal place
        for part, text in found:
            out.add(*head, part, place, text, None)
            place += 1

    def close() -> None:
        leave(split.end())
        out.add(*head, 3, place, None, sha.hexdigest())

    for *row, _, text in _rows(batches, 7):
        if head is None or head[0] != row[0]:
            if head is not None:
                close()
            head, split, sha, place = row, Splitter(row[3]), hashlib.sha256(), 0
        sha.update(text.encode())
        leave(split.feed(text))
        if out.full():
            yield out.take()
    if head is not None:
        close()
    yield out.take()


def restore(pieces: DataFrame) -> DataFrame:
    """The pieces of the documents, from outputs as ``transform`` returns them and their form.

    Sorted by row, part and place; the closing piece of a row (part 3, no text) has ``output_sha256``.
    """
    return pieces.mapInArrow(_restoring, RESTORED).sortWithinPartitions("row_id", "part", "place")


DIGESTS = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
           "output_sha256 string, restored_sha256 string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, sha = _Out(DIGESTS, 2), hashlib.sha256()
    for _, *head, part, _, text, output in _rows(batches, 8):
        if part < 3:
            sha.update(text.encode())
            continue
        out.add(*head, output, sha.hexdigest())
        sha = hashlib.sha256()
        if out.full():
            yield out.take()
    yield out.take()


def digests(docs: DataFrame, *, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """One row per document: its form and cuts, digests of the output and of the text restored from it."""
    return restore(transform(docs, seed=seed, chunk=chunk)).mapInArrow(_digested, DIGESTS)
