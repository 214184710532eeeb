"""Byte-level BPE as a streaming transducer with bounded lookahead.

``Merges.lookahead`` is computed from the merge list. Merging rule by rule, two texts that agree
up to byte n agree on all tokens up to a front that starts at n. Rule x+y can move the front left,
by len(x), only when y starts at the front; after that the tokens at the front start with x, so a
later rule x'+y' can move it again only when x is on the left spine of y' (y', its left part, the
left part of that, ...). The longest such chain of rising ranks bounds all movement: a token that
ends ``lookahead`` bytes before the end of what is known never changes. ``Encoder`` therefore
holds ``lookahead`` bytes and the open token, however long the text is.

A text goes through in windows that end where the tokenizer's own split certainly ends a piece. Most
pieces are shorter than the lookahead, so nothing in them is stable before their end: they are merged
whole, and remembered. A piece longer than a window goes through ``Encoder``. Ids and the bytes they
decode to enter their digests window by window.

Decoding is a state machine over bytes: complete characters leave at once, at most three bytes of
an open one are held, and bytes that cannot be UTF-8 become U+FFFD.

The tokenizer file is read once on the driver and broadcast (its size is checked); rows are
independent, so a lost executor costs its tasks only.

Defined results: a null text is empty (no tokens, hashes of the empty string); strings of added
tokens in a text are those tokens; ids outside the vocabulary are skipped in decoding; repeated
rows give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MAX_FILE_BYTES = 64 << 20
CACHED_PIECES = 1 << 16
CACHED_CHARS = 48
WINDOW = 1 << 14
SHORT = 64
ID_BITS = 24
NEVER = 1 << 40
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SAFE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in tokenizer files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """A byte-level merge list: ranks of pairs, ids of tokens, the sufficient lookahead."""

    def __init__(self, vocab: dict[str, int], merges: list, added: dict[str, int] | None = None):
        of = byte_alphabet()
        raw = lambda token: bytes(of[c] for c in token)
        self.ids = {raw(t): i for t, i in vocab.items() if all(c in of for c in t)}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.added = dict(added or {})
        self.tokens |= {i: t.encode() for t, i in self.added.items()}
        pairs = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in merges]
        self.lookahead = self._lookahead(pairs)
        self.bytes_ids = [self.ids[bytes([b])] for b in range(256)]
        self.made = [self.ids[x + y] for x, y in pairs]
        self.rank_of = {self.ids[x] << ID_BITS | self.ids[y]: rank
                        for rank, (x, y) in reversed(list(enumerate(pairs)))}

    @classmethod
    def from_json(cls, text: str) -> Merges:
        spec = json.loads(text)
        model, before = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"]
                or before["add_prefix_space"] or not before["use_regex"]):
            raise ValueError("not a byte-level BPE without normalizer")
        return cls(model["vocab"], model["merges"],
                   {t["content"]: t["id"] for t in spec["added_tokens"]})

    @staticmethod
    def _lookahead(pairs: list[tuple[bytes, bytes]]) -> int:
        left_part: dict[bytes, bytes] = {}  # of the rule that makes a token
        reach: dict[bytes, int] = {}        # the longest chain that ends with a rule's left token
        longest = 0
        for x, y in pairs:
            for part in (x, y):
                if len(part) > 1 and part not in left_part:
                    raise ValueError(f"the merge list uses {part!r} before it makes it")
            moved, spine = 0, y
            while True:
                moved = max(moved, reach.get(spine, 0))
                if spine not in left_part:
                    break
                spine = left_part[spine]
            chain = len(x) + moved
            reach[x] = max(reach.get(x, 0), chain)
            left_part.setdefault(x + y, x)
            longest = max(longest, chain)
        return longest

    def merge(self, data: bytes) -> list[int]:
        """Token ids of ``data``: pairs are merged lowest rank first, leftmost first."""
        parts = [self.bytes_ids[b] for b in data]
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank_of, made = self.rank_of, self.made
        ranks = [rank_of.get(a << ID_BITS | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) != NEVER:
            i = ranks.index(rank)
            parts[i:i + 2] = [token := made[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of.get(parts[i - 1] << ID_BITS | token, NEVER)
            if i < len(ranks):
                ranks[i] = rank_of.get(token << ID_BITS | parts[i + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[int | None]) -> list[int]:
        rank_of, made, n = self.rank_of, self.made, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1)
                if (r := rank_of.get(parts[i] << ID_BITS | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            left, j = parts[i], after[i]
            if left is None or j >= n or rank_of.get(left << ID_BITS | parts[j]) != rank:
                continue
            token = made[rank]
            parts[i], parts[j] = token, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get(token << ID_BITS | parts[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of.get(parts[h] << ID_BITS | token)) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]


class Encoder:
    """Token ids of one piece of text whose bytes arrive bit by bit."""

    def __init__(self, merges: Merges, step: int = 4096):
        self.merges, self.step, self.held = merges, step, bytearray()

    def feed(self, data: bytes) -> Iterator[int]:
        """Takes bytes; yields the tokens that no later byte can change."""
        for at in range(0, len(data), self.step):
            self.held += data[at:at + self.step]
            stable = len(self.held) - self.merges.lookahead
            if stable < self.step and len(self.held) < 2 * self.step:
                continue  # too little to be worth merging again
            done = 0
            for token in self.merges.merge(bytes(self.held)):
                if done + (n := len(self.merges.tokens[token])) > stable:
                    break
                done += n
                yield token
            del self.held[:done]

    def flush(self) -> Iterator[int]:
        yield from self.merges.merge(bytes(self.held))
        self.held.clear()


class Decoder:
    """Text of token ids that arrive one by one."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """The characters that these tokens complete."""
        return self.feed_bytes(b"".join([self.merges.tokens.get(i, b"") for i in ids]))

    def feed_bytes(self, data: bytes) -> str:
        """The same for tokens whose bytes are looked up already."""
        return self.state.decode(data)

    def flush(self) -> str:
        return self.state.decode(b"", True)


class _Pieces(dict):
    """For a piece of text: its ids as text, how many they are, their bytes.

    Two generations of ``CACHED_PIECES``: when the newer one is full the older one goes, and what is asked
    for again moves to the newer one, so common pieces stay.
    """

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.older = merges, {}

    def __missing__(self, piece: str) -> tuple[str, int, bytes]:
        found = self.older.get(piece) or shown(self.merges, self.merges.merge(piece.encode()))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


def shown(merges: Merges, ids: list[int]) -> tuple[str, int, bytes]:
    return ",".join(map(str, ids)), len(ids), b"".join([merges.tokens[i] for i in ids])


class Tokenizer:
    """Texts to ids and back, as streams: what is held beside a text does not grow with it."""

    def __init__(self, merges: Merges):
        self.merges, self.pieces = merges, _Pieces(merges)
        self.split = regex.compile(SPLIT)
        names = sorted(merges.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.named = {name: (str(number), 1, name.encode()) for name, number in merges.added.items()}

    def _found(self, text: str) -> Iterator[list[tuple[str, int, bytes]]]:
        """(ids as text, how many, their bytes) in the order of the text, some thousand at a time."""
        at = 0
        for name in self.added.finditer(text) if self.added else ():
            yield from self._between(text, at, name.start())
            yield [self.named[name[0]]]
            at = name.end()
        yield from self._between(text, at, len(text))

    def _between(self, text: str, low: int, high: int) -> Iterator[list[tuple[str, int, bytes]]]:
        """Window by window; a single space between two words always is where pieces meet."""
        while low < high:
            cut = SAFE.search(text, low + WINDOW, high) if high - low > 2 * WINDOW else None
            upto = cut.start() if cut else high
            window = text[low:upto]
            if len(window) <= 2 * WINDOW:
                yield list(map(self.pieces.__getitem__, self.split.findall(window)))
            else:
                for match in self.split.finditer(window):
                    piece = match[0]
                    yield from [[self.pieces[piece]]] if len(piece) <= WINDOW else self._long(piece)
            low = upto

    def _long(self, piece: str) -> Iterator[list[tuple[str, int, bytes]]]:
        """A long piece through the transducer: tokens leave once they are stable."""
        encoder = Encoder(self.merges)
        for at in range(0, len(piece), encoder.step):
            if ids := list(encoder.feed(piece[at:at + encoder.step].encode())):
                yield [shown(self.merges, ids)]
        if ids := list(encoder.flush()):
            yield [shown(self.merges, ids)]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for part in self._found(text or "") for found in part for i in found[0].split(",")]

    def decode(self, ids: Iterable[int]) -> str:
        decoder = Decoder(self.merges)
        return "".join(decoder.feed((i,)) for i in ids) + decoder.flush()

    def round_trip(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids joined by commas, SHA-256 of the decoded text.

        Both digests are fed as tokens leave; one decoder follows the whole stream.
        """
        n, ids, decoded, decoder = 0, sha256(), sha256(), Decoder(self.merges)
        for part in self._found(text or ""):
            ids.update(((b"," if n else b"") + ",".join([f[0] for f in part]).encode()))
            n += sum([f[1] for f in part])
            decoded.update(decoder.feed_bytes(b"".join([f[2] for f in part])).encode())
        decoded.update(decoder.flush().encode())
        return n, ids.hexdigest(), decoded.hexdigest()


_loaded: dict[str, Tokenizer] = {}


def _tokenizer(shared: tuple) -> Tokenizer:
    """The worker's tokenizer of a broadcast file; a worker keeps one."""
    key, file = shared
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizer(Merges.from_json(file.value))
    return _loaded[key]


def _share(df: DataFrame, path: str) -> tuple:
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_FILE_BYTES + 1)
    if len(text) > MAX_FILE_BYTES:
        raise ValueError("the tokenizer file is too large to broadcast")
    return (sha256(text.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(text))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: tokens, digest of the ids, digest of the text they decode to."""
    shared = _share(docs, path)
    names = [part.split()[0] for part in DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared)
        for batch in batches:
            found = [tokenizer.round_trip(t.as_py()) for t in batch.column(1)]
            n, ids, text = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(text, pa.string())], names)

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, DIGEST)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document the token ids themselves."""
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared)
        for batch in batches:
            ids = [tokenizer.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")
