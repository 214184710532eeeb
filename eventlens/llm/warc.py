"""WARC archives, index first.

Writing puts one gzip member per record into a ``.warc.gz`` file per task and returns the index:
file, offset, length, page, URL, digest. Reading starts from the index: the selected entries are
sorted by file and offset, neighbours are coalesced into one byte-range read, and each record is
cut out of the range by its own offset and length. Nothing scans an archive.

Of records with equal payloads (length and SHA-1) the one with the largest page_id is the
response; the others are revisits that refer to it and carry no payload. The digest and the
length in a record's header are those of the full payload for both types.

A task writes under a temporary name and renames the finished file to a name that depends on its
partition only, so a task that runs again replaces its file; the index is materialized before
anything reads it.

Defined results: a null html is an empty payload; a null or odd URL is percent-encoded in the
header (null: empty); repeated rows of the response's page_id are responses as well; a null
page_id never beats a number, and a group of nulls only is all responses; an empty table gives an
empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import materialize, new_dir

GAP = 1 << 16
LONGEST_READ = 1 << 23
TASK_BYTES = 1 << 24
DATE = "2026-01-01T00:00:00Z"
INDEX = ("page_id bigint, url string, file string, offset bigint, length bigint, "
         "payload_digest string")
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
          "record_type string, refers_to bigint, payload binary")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, response: int | None,
                 is_response: bool) -> tuple[bytes, str]:
    """One WARC record, not compressed, and its payload digest."""
    digest = digest_of(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if is_response else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Date: {DATE}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if not is_response:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{response}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(raw: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        found = fields[name].removeprefix("<urn:page:").rstrip(">")
        return None if found == "None" else int(found)

    return {
        "page_id": page("WARC-Record-ID"), "url": unquote(fields["WARC-Target-URI"]),
        "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": page("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def coalesce_ranges(
    entries: Iterable[tuple[int, int]], gap: int = GAP, longest: int = LONGEST_READ
) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, entries) of reads that cover sorted (offset, length) entries."""
    start = end = 0
    held: list[tuple[int, int]] = []
    for offset, length in entries:
        if held and (offset > end + gap or offset + length - start > longest):
            yield start, end, held
            held = []
        if not held:
            start = end = offset
        end = max(end, offset + length)
        held.append((offset, length))
    if held:
        yield start, end, held


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, temporary = None, 0, ""
        fs, base = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        file = f"part-{part:06d}.warc.gz"
        indexed = []
        for batch in batches:
            rows = batch.to_pydict()
            found = []
            for page_id, url, payload, response in zip(
                    rows["page_id"], rows["url"], rows["payload"], rows["response"], strict=True):
                if out is None:
                    temporary = f"{base}/_attempt-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(temporary, compression=None)
                raw, digest = record_bytes(page_id, url, payload, response, page_id == response)
                member = gzip.compress(raw, 3, mtime=0)
                out.write(member)
                found.append((page_id, url, file, offset, len(member), digest))
                offset += len(member)
            if found:
                indexed.append(pa.RecordBatch.from_arrays(
                    [pa.array(c) if k not in (0, 1) else
                     pa.array(c, pa.int64() if k == 0 else pa.string())
                     for k, c in enumerate(zip(*found, strict=True))],
                    ["page_id", "url", "file", "offset", "length", "payload_digest"]))
        if out is not None:
            out.close()
            fs.move(temporary, f"{base}/{file}")
        yield from indexed  # entries leave the task once their file is in place

    return run


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives into ``folder`` (any Arrow file system URI); returns their index."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        payload.alias("payload"))
    keys = [F.sha1("payload").alias("_sha1"), F.octet_length("payload").alias("_bytes")]
    # Combined per task; only groups of two and more need a second look.
    groups = (rows.select("page_id", *keys).groupBy("_sha1", "_bytes")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").drop("_n"))
    marked = (rows.select("*", *keys).join(groups, ["_sha1", "_bytes"], "left")
              .select("page_id", "url", "payload",
                      F.coalesce("response", "page_id").alias("response")))
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    return materialize(marked.mapInArrow(_writer(folder), INDEX))


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` (all of it, or a selection) points at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                 pa.binary()]
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = batch.to_pydict()
            by_file: dict[str, list[tuple[int, int]]] = {}
            for entry in zip(rows["file"], rows["offset"], rows["length"], strict=True):
                by_file.setdefault(entry[0], []).append(entry[1:])
            for file, entries in by_file.items():
                with fs.open_input_file(f"{base}/{file}") as source:
                    for start, end, held in coalesce_ranges(sorted(entries)):
                        span = source.read_at(end - start, start)
                        found = [parse_record(gzip.decompress(span[o - start:o - start + n]))
                                 for o, n in held]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[n] for r in found], k)
                             for n, k in zip(names, kinds, strict=True)], names)

    # The index is narrow, but what it points at is not: tasks by the bytes they will read.
    size = index.agg(F.sum("length")).first()[0] or 0
    entries = (index.select("file", "offset", "length")
               .repartitionByRange(1 + size // TASK_BYTES, "file", "offset").sortWithinPartitions("file", "offset"))
    return entries.mapInArrow(run, RECORD)


def archive(pages: DataFrame) -> DataFrame:
    """Writes all pages below the shared folder and reads the archives back."""
    folder = new_dir(pages.sparkSession, "warc")
    return read(write(pages, folder), folder)
