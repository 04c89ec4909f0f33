"""Operator 12, conversation structure repair: Viterbi over edits, with survivors that emit where they coalesce.

A conversation's rows, in order of turn, are edited so that its roles read: a system turn or none, then user and assistant in
turn, ending with the assistant; or nothing at all.  Edits: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an
empty user or assistant turn) 3; a truncated row that is not deleted costs 3 more; blank and duplicate rows must be deleted.
The cheapest edits win, of equal ones those whose initials come first in ASCII.

Roles so far put a conversation in one of four states, and from a state an edit's initial alone tells where it leads (only one
of user and assistant fits).  For each state the best edits so far survive, as nodes of a tree of backpointers that count what
still refers to them.  A node without references goes; as long as all survivors stand on the root's only branch, that
branch's edit is final: it is emitted with its row and the root moves on.  So memory holds the edits that survivors still
disagree on, and their rows.  Survivors that can't win any more go: whatever follows a system turn may follow an assistant's for
the same price, and whatever follows nothing too, but for a system turn that is deleted instead.  Survivors of equal cost are compared over all edits since they parted.  Of two equally dear
ways to one state none is the beginning of the other (what is more would be inserts, which cost), so the earlier one stays
earlier whatever follows.

Rows are dealt by conversation and sorted by turn; each task walks its rows in Arrow batches and carries survivors from
batch to batch, so a conversation of any length streams through bounded memory.  Which rows repeat an earlier one is found
before by grouped minima and a join.  The digest walks the edits in the same tasks.  A conversation is not split: its audit is
one value and its hash is one sequential run over its text, so that one task must see it in order anyway.

Edge cases: null roles and texts count as one space; null turns come first; a null conv_id is a conversation of its own.  Of one
turn, rows come in order of role and text, so equal ones are adjacent.  A role other than those three, or an empty one, fits
nowhere: such a row is reroled or deleted (roles are told by their first letter).  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by Rerole and Insert
NAMES = {USER: "user", ASSISTANT: "assistant"}
SHOWN = 4096  # rows of output in a batch


def faulty(rows: DataFrame) -> DataFrame:
    """rows: conv_id, turn, role, text.  conv_id, turn, role, text, fault (blank, truncated or null), late: whether an earlier turn has
    the same role and text."""
    plain = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    end = F.rtrim("text", F.lit(SPACES))
    fault = F.when(end == "", "blank").when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated")
    told = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), plain("role"), plain("text")).withColumn("fault", fault).withColumn("own", F.sha2("text", 256))
    at = F.struct(F.col("turn").isNotNull(), "turn")  # nulls first
    seen = told.groupBy("conv_id", "role", "own").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last")
    seen = seen.select(F.col("conv_id").alias("s_conv"), F.col("role").alias("s_role"), F.col("own").alias("s_own"), "first")
    met = told.join(seen, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("role") == F.col("s_role")) & (F.col("own") == F.col("s_own")), "left")
    return met.select("conv_id", "turn", "role", "text", "fault", F.coalesce(F.col("first") < at, F.lit(False)).alias("late"))


class Node:
    """An edit in the tree of backpointers; held: survivors that end here."""

    __slots__ = ("parent", "letter", "depth", "kids", "held")

    def __init__(self, parent: "Node | None", letter: str):
        self.parent, self.letter, self.kids, self.held = parent, letter, [], 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.kids.append(self)


def released(node: Node) -> None:
    """One survivor less; nodes that nothing refers to go."""
    node.held -= 1
    while not node.held and not node.kids and node.parent:
        above = node.parent
        above.kids.remove(node)
        node.parent, node = None, above


def before(x: tuple[Node, str], y: tuple[Node, str]) -> bool:
    """Whether the edits of x (a node and further letters) come before those of y in ASCII: all letters since they parted."""
    (a, more_a), (b, more_b) = x, y
    own, other = [more_a[::-1]], [more_b[::-1]]
    while a is not b:
        if a.depth >= b.depth:
            own.append(a.letter)
            a = a.parent
        else:
            other.append(b.letter)
            b = b.parent
    return "".join(own)[::-1] < "".join(other)[::-1]


class Survivors:
    """The best edits of one conversation so far, by state."""

    def __init__(self):
        self.root = self.last = Node(None, "")
        self.state = START  # at the root
        self.rows: deque = deque()  # that no final edit has taken
        self.best: dict[int, tuple[int, Node]] = {}
        self._settle({START: (0, self.root, "")})

    def _settle(self, found: dict[int, tuple[int, Node, str]]) -> None:
        """found: cost, node and further letters by state, to which inserts are added."""

        def offer(to: int, cost: int, node: Node, more: str) -> None:
            now = found.get(to)
            if now is None or cost < now[0] or cost == now[0] and before((node, more), now[1:]):
                found[to] = (cost, node, more)

        for state in (START, SYSTEM, ASSISTANT, USER):  # whatever leads to user comes before what follows from user
            if state in found:
                cost, node, more = found[state]
                offer(GIVEN[state], cost + COST[INSERT], node, more + INSERT)
        if ASSISTANT in found:
            done, *way = found[ASSISTANT]
            if SYSTEM in found and (found[SYSTEM][0] > done or found[SYSTEM][0] == done and before(tuple(way), found[SYSTEM][1:])):
                del found[SYSTEM]
            if START in found and found[START][0] > done + COST[DELETE]:
                del found[START]
        old, self.best = self.best, {}
        for state, (cost, node, more) in found.items():
            for letter in more:
                node = next((k for k in node.kids if k.letter == letter), None) or Node(node, letter)
            node.held += 1
            self.best[state] = (cost, node)
        for _, node in old.values():
            released(node)

    def take(self, row: tuple) -> Iterator[tuple]:
        """row: turn, role, text, fault.  Edits that have become final."""
        _, role, _, fault = row
        found: dict[int, tuple[int, Node, str]] = {}

        def offer(to: int, cost: int, node: Node, letter: str) -> None:
            now = found.get(to)
            if now is None or cost < now[0] or cost == now[0] and before((node, letter), now[1:]):
                found[to] = (cost, node, letter)

        more = TRUNCATED if fault == "truncated" else 0
        for state, (cost, node) in self.best.items():
            offer(state, cost + COST[DELETE], node, DELETE)
            if fault not in ("blank", "duplicate"):
                offer(GIVEN[state], cost + COST[REROLE] + more, node, REROLE)
                if (to := KEPT.get((state, role[:1]))) is not None:
                    offer(to, cost + more, node, KEEP)
        self.rows.append(row)
        self._settle(found)
        return self._final()

    def end(self) -> Iterator[tuple]:
        """All edits that are left, once the best survivor of those that may end is known."""
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        best = min(c for c, _ in ends)
        won = [n for c, n in ends if c == best]
        won = won[1] if len(won) > 1 and before((won[1], ""), (won[0], "")) else won[0]
        for _, node in self.best.values():
            if node is not won:
                released(node)
        self.best = {}
        return self._final()

    def _final(self) -> Iterator[tuple]:
        """letter, turn, old role, fault, role, text, cost of the edits on the root's only branch."""
        while not self.root.held and len(self.root.kids) == 1:
            node = self.root.kids.pop()
            node.parent, self.root = None, node
            letter, state = node.letter, self.state
            turn, role, text, fault = (None, None, "", None) if letter == INSERT else self.rows.popleft()
            if letter != DELETE:
                self.state = KEPT[state, role[:1]] if letter == KEEP else GIVEN[state]
            cost = COST[letter] + (TRUNCATED if fault == "truncated" and letter != DELETE else 0)
            now = None if letter == DELETE else role if letter == KEEP else NAMES[self.state]
            yield letter, turn, role, fault, now, None if letter == DELETE else text, cost


EDITS = "nth long, edit string, turn long, old_role string, fault string, role string, text string, cost long"


def repaired(rows: DataFrame) -> DataFrame:
    """rows: conv_id, turn, role, text.  One row per edit, in order within its conversation, all of one partition: conv_id, nth (from 0),
    edit (K, R, D, I), turn, old_role and fault (blank, duplicate, truncated) of the row edited, role and text after the edit
    (null if deleted), cost."""
    dealt = faulty(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = arrow_schema(rows, "conv_id", EDITS)
    names = [f.name for f in schema]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        conv = last = survivors = None
        nth, out = 0, []

        def shown() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def given(edits: Iterator[tuple]) -> None:
            nonlocal nth
            for letter, *rest in edits:
                out.append((conv, nth, letter, *rest))
                nth += 1

        for batch in batches:
            kind = batch.column("conv_id").type
            for own, turn, role, text, fault, late in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "late")]):
                if survivors is None or own != conv:
                    if survivors:
                        given(survivors.end())
                    conv, last, survivors, nth = own, None, Survivors(), 0
                if fault != "blank" and (late or (turn, role, text) == last):
                    fault = "duplicate"
                last = (turn, role, text)
                given(survivors.take((turn, role, text, fault)))
                if len(out) >= SHOWN:
                    yield shown()
        if survivors:
            given(survivors.end())
            yield shown()

    return dealt.mapInArrow(walk, schema)


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = ("su", "ua", "au")


class Digest:
    """What is told of one conversation, from its edits in order."""

    def __init__(self):
        self.hash, self.said, self.audit, self.cost, self.illegal = hashlib.sha256(), False, [], 0, 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.low = self.high = self.initial = None
        self.turns = 0

    def take(self, edit: str, turn: int | None, old: str | None, fault: str | None, role: str | None, text: str | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if fault:
            self.faults[fault] += 1
        if edit != INSERT:
            if self.initial is not None and self.initial + old[:1] not in LEGAL:
                self.illegal += 1
            self.initial = old[:1]
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if edit != DELETE:
            self.hash.update((("\n" if self.said else "") + f"{role}:{text}").encode())
            self.said = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def digested(edits: DataFrame) -> DataFrame:
    """edits: as `repaired` gives them, not shuffled since.  One row per conversation that has rows: conv_id, gaps in turns, rows by
    fault, illegal adjacent roles before repair, cost, audit (the edits' initials), repaired_sha256."""
    schema = arrow_schema(edits, "conv_id", DIGEST)
    names = [f.name for f in schema]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = conv = digest = None

        def shown(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(names), kinds)], names=names)

        for batch in batches:
            out, kind = [], batch.column("conv_id").type
            for own, *edit in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "old_role", "fault", "role", "text", "cost")]):
                if digest is None or own != conv:
                    if digest:
                        out.append((conv, *digest.row()))
                    conv, digest = own, Digest()
                digest.take(*edit)
            yield shown(out)
        if digest:
            yield shown([(conv, *digest.row())])

    return edits.mapInArrow(walk, schema)


def with_all(conversations: DataFrame, told: DataFrame) -> DataFrame:
    """A row of `digested` for every conv_id of a table, zeros and empty texts for those without rows."""
    ids = conversations.select(F.col("conv_id").alias("every")).distinct()
    met = ids.join(told, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return met.select(F.col("every").alias("conv_id"), *[F.coalesce(F.col(c), empty.get(c, F.lit(0))).alias(c) for c in told.columns if c != "conv_id"])


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults that depend on conversation and turn alone; nulls are one space (in the key too)."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn"))) % 20
    text: Column = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    role = F.when(kind == 4, "user").otherwise(plain("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"), kind.alias("kind")).where("kind <> 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("conv_id", "turn", "role", "text")
