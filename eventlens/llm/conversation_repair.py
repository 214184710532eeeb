"""Conversations with damaged structure: the cheapest edits that put their roles in order again.

A conversation is in order when the initials of its roles read ``(s?(ua)+)?``. Rows may be kept (0),
given the role user or assistant (3) or deleted (4, the only choice for a blank or duplicate row),
and rows with an empty text put in anywhere (3); a truncated row that is not deleted costs 3 more.
Of the cheapest ways the one whose edits, as initials (K, R, D, I), come first in ASCII is taken.

That is a Viterbi search over four states: what the output ends with so far. Its backpointers are a
tree; a node counts its references, from children and from the states that survive, and goes when
nothing refers to it any more. A state that costs more than another one would need to imitate it does
not survive. Once all survivors descend from one child of the root, that child's
edit is certain: it leaves the task and becomes the root. So a task holds the unresolved edits of one
conversation only, and ties are settled on these: survivors of equal cost are compared from their
last common ancestor on, in full.

Spark deals conversations out and sorts each by turn; rows stream through. What has to be looked up
elsewhere is whether role and text occur in an earlier turn: that is settled before, on digests, and
arrives as a mark in front of the turn's rows; repeats within a turn are neighbours. A conversation
is one stream by nature, since its digest is, so a very long one is one task of constant memory.

Defined results: a null role or text is one space; null turns come first, and the null ``conv_id`` is
a conversation; equal turns are ordered by role, then text; a role whose initial is not s, u or a can
only be changed or deleted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"
ENDS = ".!?"
CHANGE, DELETE, INSERT, CUT = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: What may follow a state, by the initial of the next role.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The roles to put in behind a state, without going in a circle, and the state they lead to.
INSERTS = {START: [((), START), (("user",), USER), (("user", "assistant"), ASSISTANT)],
           SYSTEM: [((), SYSTEM), (("user",), USER), (("user", "assistant"), ASSISTANT)],
           USER: [((), USER), (("assistant",), ASSISTANT)],
           ASSISTANT: [((), ASSISTANT), (("user",), USER)]}
#: The most that a state has to add to do what another one does from here on: behind a complete pair a
#: system row is deleted instead of kept, and one row put in changes the phase.
BEHIND = {START: {ASSISTANT: DELETE, USER: DELETE + INSERT}, SYSTEM: {ASSISTANT: 0, USER: INSERT},
          USER: {ASSISTANT: INSERT}, ASSISTANT: {USER: INSERT}}

EDITS = ("conv_id bigint, place bigint, edit string, turn bigint, said_by string, fault string, "
         "role string, text string, cost bigint")
_EDIT_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
    ("said_by", pa.string()), ("fault", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ("cost", pa.int64())])
ROWS_OUT, TEXT_OUT = 4096, 4 << 20


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str | None


class Edit(NamedTuple):
    """One edit; an inserted row has no source, a deleted one keeps its role."""

    letter: str
    role: str
    cost: int
    row: Row | None


class Node:
    """An edit behind another one; ``tips`` counts the states that survive with it as their last."""

    __slots__ = ("depth", "edit", "kids", "parent", "tips")

    def __init__(self, parent: Node | None, edit: Edit | None):
        self.parent, self.edit = parent, edit
        self.depth = parent.depth + 1 if parent else 0
        self.kids: dict[tuple[str, str], Node] = {}
        self.tips = 0

    def child(self, edit: Edit) -> Node:
        """The child with this edit; survivors that begin alike share it."""
        key = (edit.letter, edit.role)
        if key not in self.kids:
            self.kids[key] = Node(self, edit)
        return self.kids[key]


def release(node: Node) -> None:
    """Gives up one reference of a survivor; nodes that nothing refers to go, up the branch."""
    node.tips -= 1
    while node.tips == 0 and not node.kids and node.parent is not None:
        parent = node.parent
        del parent.kids[node.edit.letter, node.edit.role]
        node = parent


def letters_apart(a: Node, b: Node) -> tuple[str, str]:
    """The letters of two branches behind their last common ancestor."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit.letter)
            a = a.parent
        else:
            right.append(b.edit.letter)
            b = b.parent
    return "".join(reversed(left)), "".join(reversed(right))


class Way(NamedTuple):
    """A candidate for a state: the cost, the survivor it continues, and the edits it adds."""

    cost: int
    tip: Node
    edits: tuple[Edit, ...]

    def beats(self, other: Way) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        mine, its = ("", "") if self.tip is other.tip else letters_apart(self.tip, other.tip)
        return (mine + "".join(e.letter for e in self.edits)
                < its + "".join(e.letter for e in other.edits))


class Search:
    """One conversation: rows go in by turn, edits come out as soon as they are certain."""

    def __init__(self):
        self.root = Node(None, None)
        self.root.tips = 1
        self.survivors: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def add(self, row: Row) -> list[Edit]:
        initial, cut = row.role[:1], CUT if row.fault == "truncated" else 0
        best: dict[int, Way] = {}

        def offer(state: int, way: Way) -> None:
            if state not in best or way.beats(best[state]):
                best[state] = way

        for state, (cost, tip) in self.survivors.items():
            for roles, at in INSERTS[state]:
                before = tuple(Edit("I", r, INSERT, None) for r in roles)
                cost_at = cost + INSERT * len(roles)
                offer(at, Way(cost_at + DELETE, tip, (*before, Edit("D", row.role, DELETE, row))))
                if row.fault in ("blank", "duplicate"):
                    continue
                if initial in NEXT[at]:
                    offer(NEXT[at][initial], Way(cost_at + cut, tip, (*before, Edit("K", row.role, cut, row))))
                for role in ("user", "assistant"):
                    if role[0] in NEXT[at]:
                        change = Edit("R", role, CHANGE + cut, row)
                        offer(NEXT[at][role[0]], Way(cost_at + CHANGE + cut, tip, (*before, change)))
        self._survive(best)
        return self._certain()

    def finish(self) -> list[Edit]:
        best = None
        for state, (cost, tip) in self.survivors.items():
            for roles, at in INSERTS[state]:
                way = Way(cost + INSERT * len(roles), tip, tuple(Edit("I", r, INSERT, None) for r in roles))
                if at in FINAL and (best is None or way.beats(best)):
                    best = way
        self._survive({START: best})
        node, out = self.survivors[START][1], []
        while node is not self.root:
            out.append(node.edit)
            node = node.parent
        return out[::-1]

    def _survive(self, best: dict[int, Way]) -> None:
        old, self.survivors = self.survivors, {}
        for state, way in best.items():
            if any(to in best and way.cost > best[to].cost + more for to, more in BEHIND[state].items()):
                continue  # it can't be part of a cheapest way any more, not even of a tied one
            node = way.tip
            for edit in way.edits:
                node = node.child(edit)
            node.tips += 1
            self.survivors[state] = (way.cost, node)
        for _, tip in old.values():
            release(tip)

    def _certain(self) -> list[Edit]:
        """The edits all survivors share, cut off the root."""
        out = []
        while self.root.tips == 0 and len(self.root.kids) == 1:
            (self.root,) = self.root.kids.values()
            self.root.parent = None
            out.append(self.root.edit)
        return out

    def held(self) -> int:
        """How many edits are not certain yet."""
        stack, n = [self.root], -1
        while stack:
            node = stack.pop()
            n += 1
            stack.extend(node.kids.values())
        return n


def identity(conv_id: int | None, role: str, text: str) -> str:
    """A name of a row's conversation, role and text; ``_identity`` is the same as a Column."""
    whole = f"{' ' if conv_id is None else conv_id}:{len(role)}:{role}{text}"
    return hashlib.sha256(whole.encode()).hexdigest()


def _identity() -> F.Column:
    return F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                           F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)


def _plain(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


def repeated_later(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, key) of rows whose role and text occur in an earlier turn.

    Only digests travel, combined per task first, so a crowd of copies is a row for each turn.
    """
    seen = (rows.select("conv_id", "turn", "role", _identity().alias("key"))
            .groupBy("conv_id", "turn", "role", "key").agg(F.count(F.lit(1)).alias("n")))
    turns = (seen.groupBy("key").agg(F.min(F.struct("turn")).alias("low"), F.max(F.struct("turn")).alias("high"))
             .filter("low <> high").select("key", F.col("low.turn").alias("first")))
    return (seen.join(turns, "key").filter(~F.col("turn").eqNullSafe(F.col("first")))
            .select("conv_id", "turn", "role", "key"))


class _Out:
    """Edits on their way out, in batches of bounded size."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, conv_id: int | None, place: int, edit: Edit) -> None:
        row = edit.row
        text = None if edit.letter == "D" else row.text if row else ""
        self.rows.append((conv_id, place, edit.letter, row and row.turn, row and row.role,
                          row and row.fault, None if edit.letter == "D" else edit.role, text, edit.cost))
        self.size += len(text or "")

    def full(self) -> bool:
        return len(self.rows) >= ROWS_OUT or self.size >= TEXT_OUT

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_EDIT_TYPES)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _EDIT_TYPES, strict=True)], schema=_EDIT_TYPES)


def fault_of(row: tuple, before: tuple | None, marked: set[str]) -> str | None:
    """The first fault of (conv_id, turn, role, text), given the row before and its turn's marks."""
    conv_id, _, role, text = row
    body = text.rstrip(SPACES)
    if not body:
        return "blank"
    if row == before or marked and identity(conv_id, role, text) in marked:
        return "duplicate"
    return None if body[-1] in ENDS else "truncated"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of rows that come by conversation, turn, role, marks first, then text."""
    out, search, place, before, turn, marked = _Out(), None, 0, None, None, set()

    def leave(edits: list[Edit]) -> None:
        nonlocal place
        for edit in edits:
            out.add(turn[0], place, edit)
            place += 1

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for conv_id, at, role, key, text in zip(*columns, strict=True):
            if search is None or turn[0] != conv_id:
                if search is not None:
                    leave(search.finish())
                search, place, before = Search(), 0, None
            if turn != (conv_id, at, role):
                turn, marked = (conv_id, at, role), set()
            if key is not None:
                marked.add(key)
                continue
            row = (conv_id, at, role, text)
            leave(search.add(Row(at, role, text, fault_of(row, before, marked))))
            before = row
            if out.full():
                yield out.take()
    if search is not None:
        leave(search.finish())
    yield out.take()


def repair(conversations: DataFrame) -> DataFrame:
    """The edits of every conversation, in order, the rows of one after the other in a partition.

    ``edit`` is K, R, D or I; ``turn``, ``said_by`` and ``fault`` tell of the row it was made on,
    ``role`` and ``text`` of the row that is left (null when deleted).
    """
    rows = _plain(conversations)
    marks = repeated_later(rows).select("conv_id", "turn", "role", "key", F.lit(None).cast("string").alias("text"))
    both = rows.select("conv_id", "turn", "role", F.lit(None).cast("string").alias("key"), "text").union(marks)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role",
             F.col("key").desc_nulls_last(), "text"]
    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repaired, EDITS)


class _Digest:
    """Figures of one conversation from its edits, one at a time."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.low = self.high = None
        self.turns = self.cost = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit, self.sha = [], hashlib.sha256()
        self.said_by = self.left = None

    def add(self, edit: str, turn: int | None, said_by: str | None, fault: str | None,
            role: str | None, text: str | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None and turn != self.high:  # turns come in order
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            if fault:
                self.faults[fault] += 1
            if self.said_by is not None:
                self.illegal += self.said_by[:1] + said_by[:1] not in ("su", "ua", "au")
            self.said_by = said_by
        if edit != "D":
            self.sha.update(f"{'' if self.left is None else chr(10)}{role}:{text}".encode())
            self.left = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest())


SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
           "illegal bigint, cost bigint, audit string, repaired_sha256 string")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in SUMMARY.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    current, done = None, []
    for batch in batches:
        columns = {f.name: batch.column(k).to_pylist() for k, f in enumerate(batch.schema)}
        for k, conv_id in enumerate(columns["conv_id"]):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv_id)
            current.add(*(columns[c][k] for c in ("edit", "turn", "said_by", "fault", "role", "text", "cost")))
        if len(done) >= ROWS_OUT:
            yield table(done)
            done = []
    yield table(done + ([current.row()] if current is not None else []))


def summary(edits: DataFrame) -> DataFrame:
    """One row per conversation, of edits as ``repair`` returns them.

    Edits that were written and read again have to be dealt by ``conv_id`` and sorted by ``conv_id``
    and ``place`` first.
    """
    return edits.mapInArrow(_summed, SUMMARY)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoilt for a test of the repair, by the checksum of conversation and turn.

    One row in twenty is dropped, one emptied, one loses its sentence ends, one is repeated, and one
    gets the role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    return (_plain(conversations).withColumn("kind", kind).filter("kind <> 0")
            .withColumn("text", F.when(F.col("kind") == 1, "").when(
                F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                          .otherwise(F.array(F.lit(0)))))
            .drop("kind", "copy"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The summary of each conversation once damaged and repaired; of one without rows left, too."""
    found = summary(repair(damaged(conversations)))
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(found, F.col("id").eqNullSafe(found["conv_id"]), "left")
            .select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
