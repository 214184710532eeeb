"""Removal of repeated byte strings with suffix arrays of shards.

A window is ``length`` consecutive bytes of a text. Windows are dealt to shards so that equal
windows meet: a window's anchor is the smallest hash among its ``GRAM``-byte strings, so equal windows
have equal anchors. Consecutive windows with one anchor are one segment of text, and each window
is in exactly one segment. Anchors with a single place in the whole table cannot hold an equal
pair, so only segments of repeated anchors leave their document.

A shard is a suffix array over its segments (induced sorting) with permuted common prefixes: a
window is repeated when the suffix before or after it in the array shares ``length`` bytes.
Segments of one anchor stay together; an anchor whose segments have more than ``HOT`` bytes is not put
into one task: its windows are counted by two independent 64-bit hashes instead, in an ordinary
aggregation.

Equal texts are one text here, named by 128 bits of hash: one of them is cut into segments, and what
is known from counting texts (all of a copy is repeated) needs no array.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; equal texts of
``length`` bytes or more lose everything, as do repeated rows; an empty table gives an empty result;
a null id is carried; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import suffix_array as A
from eventlens.llm import words as W
from eventlens.llm.common import arrow_map, materialize

LENGTH = 400
GRAM = 96
SHARD_BYTES = 4 << 20
HOT = 8 << 20
COMMON = 1_000  # a text that makes up more than this share of the table has rows in every task
_LETTER = np.random.default_rng(400).integers(1, 2**64, (2, 256), dtype=np.uint64)
_PLACE = 21


def _grams(raw: np.ndarray, size: int, table: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` bytes; at most ``W.PIECE`` places."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_LETTER[table][raw] * W._UP[:len(raw)], out=sums[1:])
        n = len(raw) - size + 1
        return W.finish((sums[size:] - sums[:-size]) * W._DOWN[:n])


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by minima from block borders both ways."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], onward[width - 1:n])


def anchors(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor, first, last, places) for runs of windows with one anchor in texts ending at ``ends``.

    ``ends`` holds, per byte, the end of its text. ``places`` is 2 when the anchor itself occurs at
    two places or more in the run.
    """
    if len(raw) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    hashes = _grams(raw, gram, 0)
    low = np.uint64((1 << _PLACE) - 1)
    smallest = _window_minimum((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64),
                               length - gram + 1)
    starts = np.flatnonzero(np.arange(len(smallest)) + length <= ends[:len(smallest)])
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    place = (smallest[starts] & low).astype(np.int64)
    anchor = hashes[place]
    new = np.flatnonzero(np.concatenate(
        [[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    stop = np.append(new[1:], len(starts)) - 1
    return (anchor[new], starts[new], starts[stop],
            np.where(place[new] != place[stop], 2, 1).astype(np.int64))


def _pieces(raw: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from, to): byte ranges of at most W.PIECE; windows of long texts
    are in exactly one of their overlapping ranges."""
    k, n = 0, len(bounds) - 1
    while k < n:
        low = int(bounds[k])
        upto = max(k + 1, int(np.searchsorted(bounds, low + W.PIECE, "right")) - 1)
        if bounds[upto] - low <= W.PIECE:
            yield k, upto, low, int(bounds[upto])
        else:
            step = W.PIECE - length + 1
            for at in range(low, int(bounds[upto]) - length + 1, step):
                yield k, k + 1, at, min(at + step + length - 1, int(bounds[upto]))
        k = upto


def _anchor_rows(length: int, gram: int):
    def of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raw, bounds = W.text_bytes(batch.column(2))
        keys, checks = (batch.column(k).to_numpy() for k in (0, 1))
        out = []
        for first, last, low, high in _pieces(raw, bounds, length):
            inner = np.clip(bounds[first:last + 1] - low, 0, high - low)
            ends = np.repeat(inner[1:], np.diff(inner))
            anchor, a, b, places = anchors(raw[low:high], ends, length, gram)
            if len(anchor):
                text = first + np.searchsorted(inner, a, "right") - 1
                text = np.minimum(text, last - 1)
                shift = low - bounds[text]
                out.append((keys[text], checks[text], anchor.view(np.int64), a + shift, b + shift,
                            places))
        if not out:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
            ["key", "check", "anchor", "a", "b", "places"])

    return of


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each of different segments, where windows start that also start elsewhere."""
    sizes = np.array([len(s) for s in segments])
    stops = np.cumsum(sizes + 1)
    raw = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    text = raw.astype(np.int64) + 2
    text[stops - 1] = 1  # a border, below every byte
    sa = A.induced_sort(np.append(text, 0))
    ends = np.repeat(stops - 1, sizes + 1)
    ends[stops - 1] = stops
    common, before = A.permuted_common_prefixes(raw, sa, ends)
    again = np.zeros(len(raw), bool)
    long = np.flatnonzero(common >= length)
    again[long] = True
    again[before[long]] = True
    starts = stops - sizes - 1
    return [np.flatnonzero(again[s:s + n]) for s, n in zip(starts, sizes, strict=True)]


def _runs(starts: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Maximal byte runs covered by windows at sorted ``starts``."""
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > length)
        yield from zip(starts[np.concatenate([[0], cut + 1])].tolist(),
                       (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True)


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        places: dict[bytes, set[tuple[int, int, int]]] = {}
        for *place, data in zip(*(table[c].to_pylist() for c in ("key", "check", "a", "data")),
                                strict=True):
            places.setdefault(data, set()).add(tuple(place))
        segments = list(places)
        found: list[tuple[int, int, int, int]] = []
        for data, starts in zip(segments, repeated_starts(segments, length), strict=True):
            at = places[data]
            if len(at) > 1:  # equal segments: each of their windows is repeated
                runs = [(0, len(data))]
            else:
                runs = list(_runs(starts, length))
            found += [(key, check, a + s, a + e) for key, check, a in at for s, e in runs]
        columns = zip(*found, strict=True) if found else ((),) * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["key", "check", "s", "e"])

    return run


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Segments of the texts of a batch: shard, key, check, a, data."""
    shard, keys, checks, begin, data = [], [], [], [], []
    for key, check, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        raw = text.encode()
        for part in parts:
            shard.append(part["shard"])
            keys.append(key)
            checks.append(check)
            begin.append(part["a"])
            data.append(raw[part["a"]:part["e"]])
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in (shard, keys, checks, begin)), pa.array(data, pa.binary())],
        ["shard", "key", "check", "a", "data"])


def _hot_windows(length: int):
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for key, check, a, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = np.frombuffer(data, np.uint8)
            for low in range(0, len(raw) - length + 1, W.PIECE - length + 1):
                piece = raw[low:low + W.PIECE]
                one, two = (_grams(piece, length, k).view(np.int64) for k in (0, 1))
                out.append((np.full(len(one), key), np.full(len(one), check),
                            a + low + np.arange(len(one)), one, two))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "check", "s", "h1", "h2"])

    return of


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """(key, check, runs) of different texts: byte runs that repeated windows cover.

    ``docs`` has ``key`` and ``check``, hashes of a text, and ``text``; rows may repeat.
    """
    name = ["key", "check"]
    # Rows of equal texts fold before they travel.
    texts = docs.select(*name, "text").filter(F.octet_length("text") >= length)
    segments = materialize(
        arrow_map(texts, _anchor_rows(length, gram),
                  "key bigint, check bigint, anchor bigint, a bigint, b bigint, places bigint",
                  text=2).distinct())
    counted = (segments.groupBy("anchor")
               .agg(F.sum("places").alias("places"),
                    F.sum(F.col("b") - F.col("a") + length).alias("bytes"))
               .filter("places > 1").select("anchor", (F.col("bytes") > hot).alias("hot")))
    repeated = materialize(segments.join(counted, "anchor")
                           .select(*name, "anchor", "hot", "a", (F.col("b") + length).alias("e")))
    total = repeated.filter("NOT hot").agg(F.sum(F.col("e") - F.col("a"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    shard = F.when(F.col("hot"), F.lit(-1)).otherwise(F.pmod("anchor", F.lit(shards)))
    per_text = repeated.groupBy(*name).agg(F.collect_list(
        F.struct(shard.cast("bigint").alias("shard"), "a", "e")).alias("parts"))  # of one text
    cut = arrow_map(texts.dropDuplicates(name).join(per_text, name).select(*name, "text", "parts"),
                    _cut, "shard bigint, key bigint, check bigint, a bigint, data binary", text=2)
    runs = (cut.filter("shard >= 0").groupBy("shard")
            .applyInArrow(_shard(length), "key bigint, check bigint, s bigint, e bigint"))
    if not repeated.filter("hot").isEmpty():
        windows = arrow_map(cut.filter("shard < 0").select(*name, "a", "data"), _hot_windows(length),
                            "key bigint, check bigint, s bigint, h1 bigint, h2 bigint",
                            text=3).distinct()
        twice = (windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        runs = runs.union(windows.join(twice, ["h1", "h2"], "left_semi")
                          .select(*name, "s", (F.col("s") + length).alias("e")))
    return runs.groupBy(*name).agg(F.collect_set(F.struct("s", "e")).alias("runs"))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _removed(length: int):
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, spans, digests, kept = [], [], [], [], []
        for text, copied, runs in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            raw = (text or "").encode()
            found = [(0, len(raw))] if copied and len(raw) >= length else merged(
                [(r["s"], r["e"]) for r in runs or ()])
            cuts = [0, *(x for run in found for x in run), len(raw)]
            left = b"".join(raw[cuts[k]:cuts[k + 1]] for k in range(0, len(cuts), 2))
            sizes.append(len(raw))
            removed.append(len(raw) - len(left))
            spans.append([{"s": s, "e": e} for s, e in found])
            digests.append(sha256(left).hexdigest())
            kept.append(left)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(list(map(len, spans)), pa.int64()), pa.array(digests, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
             pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return of


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """Per document: sizes, the removed spans, the bytes that are left and their digest."""
    name = ["key", "check"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("key"), F.xxhash64(F.lit(length), text).alias("check"))
    counted = materialize(rows.filter(F.octet_length("text") >= length).groupBy(*name)
                          .agg(F.count(F.lit(1)).alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    # At most COMMON texts; all of their rows are removed whole and need not meet.
    often = counted.filter((F.col("n") > 1) & (F.col("n") * COMMON > total)).select(*name)
    spans = repeated_spans(rows, length=length, gram=gram, hot=hot)
    known = spans.join(counted.filter("n > 1").select(*name, F.lit(True).alias("copied")), name,
                       "full_outer")
    here = (rows.join(F.broadcast(often), name, "left_semi")
            .select("doc_id", "text", F.lit(True).alias("copied"),
                    F.lit(None).cast("array<struct<s:bigint,e:bigint>>").alias("runs")))
    met = (rows.join(F.broadcast(often), name, "left_anti").join(known, name, "left")
           .select("doc_id", "text", "copied", "runs"))
    return arrow_map(
        here.union(met), _removed(length),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<s:bigint,e:bigint>>, kept binary", text=1)
