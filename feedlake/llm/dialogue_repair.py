"""Conversation structure repair with a suffix-shared automaton (DAWG).

Rows of a conversation, in the order of their turns, are kept, given another role,
deleted or preceded by an inserted row, at least cost, so that the initials of the
roles read ``(s?(ua)+)?``.  Blank rows and rows whose role and text came before must
go; a kept row with a cut-off end costs 1.

1. Rows are damaged, hashed and marked with native functions.  Equal rows of a turn
   combine before any shuffle, and repeats are found by a group of row hashes.
2. A conversation becomes its signature, one letter a row.  Different signatures are
   sorted from their ends, so that those with a common end come in a row, and walk
   one automaton: a node is a suffix.  Per node and grammar state, the cost to go and
   the best next edits are computed once and shared by every conversation that ends
   so.  Nodes with equal costs and order of their audits are one class, and the step
   from a class by a letter is worked out once per worker; audits are read along the
   nodes, not stored in them.
3. The audits meet the rows in a sorted stream, which is hashed as it passes.

A conversation's texts are never gathered: steps 2 and 3 stream sorted rows and hold
one letter a row, as its audit does.  SHA-256 over a whole conversation is a chain,
so its rows pass through one task in step 3, whatever their number.

Rows come by turn (nulls first); rows of one turn by role, then by a hash of
conversation, role and text; equal rows are copies of each other.  Null roles and
texts count as one space, a null conversation id is an id of its own.  A row may
stand several times or not at all (``times_col``); conversations without any row
have zeros, an empty audit and the hash of nothing.  Empty input gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import join_groups, stage

WHITE = " \t\n\x0b\x0c\r"

# Letters of a signature: the role's initial, as a capital where the end is cut off; GONE must be deleted.
GONE = "-"
START, SYSTEM, USER, ASSISTANT = range(4)                   # grammar states, by the row before
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
ROLE = {USER: "user", ASSISTANT: "assistant"}


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times of the rows after damage by crc32(conv_id:turn) mod 20."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"))


class Solver:
    """Costs to go and best edits per class of automaton nodes and grammar state.

    A class holds, per state, the cost above the least of them and the rank of the
    best audit among the four; that is all that nodes further to the front need.
    """

    def __init__(self):
        self.classes: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int, list]] = {}
        # At the end: nothing, or what completes the last pair.
        self.end, self.end_cost, _ = self._class([(0, "", 0), (4, "II", 0), (2, "I", 0), (0, "", 0)])

    def _class(self, best: list[tuple]) -> tuple[int, int, list]:
        """(class, cost taken out of it, edits) of per-state (cost, edits, rank of what follows)."""
        least = min(c for c, _, _ in best)
        order = sorted({b[1:] for b in best})
        key = tuple((c - least, order.index((e, r))) for c, e, r in best)
        if key not in self.ids:
            self.ids[key] = len(self.classes)
            self.classes.append(key)
        return self.ids[key], least, [e for _, e, _ in best]

    def step(self, after: int, letter: str) -> tuple[int, int, list]:
        """(class, cost, per state (edits, next state)) of the node that reads ``letter`` and goes on to ``after``."""
        known = self.steps.get((after, letter))
        if known is None:
            rest, best, goes = self.classes[after], [], []
            for state in range(4):
                cost, edits, rank, to = min((cost + rest[to][0], edits, rest[to][1], to) for cost, edits, to in _options(state, letter))
                best.append((cost, edits, rank))
                goes.append((edits, to))
            node, least, _ = self._class(best)
            known = self.steps[after, letter] = node, least, goes
        return known


def _options(state: int, letter: str) -> Iterator[tuple[int, str, int]]:
    """(cost, edits, next state) of every way to pass a row, with at most one row inserted before it.

    Two inserted rows in a row never pay: they lead to a state that allows no more than the one before.
    """
    for cost, edits, at in ((0, "", state), (2, "I", _NEXT[state])):
        yield cost + 3, edits + "D", at
        if letter != GONE:
            cost += letter.isupper()
            for to in (SYSTEM, _NEXT[at]) if at == START else (_NEXT[at],):
                if letter.lower() == _INITIAL[to]:
                    yield cost, edits + "K", to
            yield cost + 2, edits + "R", _NEXT[at]


class Automaton:
    """The path of nodes from the end to the front of the signature read last.

    Signatures that come sorted from their ends share the nodes of their common suffix.
    """

    def __init__(self, solver: Solver | None = None):
        self.solver = solver or Solver()
        self.read, self.nodes, self.costs, self.made = "", [self.solver.end], [self.solver.end_cost], 0

    def solve(self, signature: str) -> tuple[int, str]:
        """(least cost, ASCII-least audit of that cost)."""
        backward = signature[::-1]
        same = _common(backward, self.read)
        del self.nodes[same + 1:], self.costs[same + 1:]
        for letter in backward[same:]:
            node, cost, _ = self.solver.step(self.nodes[-1], letter)
            self.nodes.append(node)
            self.costs.append(self.costs[-1] + cost)
        self.made += len(backward) - same
        self.read = backward
        audit, state = [], START
        for k in range(len(signature), 0, -1):
            edits, state = self.solver.step(self.nodes[k - 1], backward[k - 1])[2][state]
            audit.append(edits)
        audit.append({START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state])
        return self.costs[-1] + self.solver.classes[self.nodes[-1]][START][0], "".join(audit)


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    x, y = (np.frombuffer(s.encode("ascii"), dtype=np.uint8)[:min(len(a), len(b))] for s in (a, b))
    apart = np.flatnonzero(x != y)
    return int(apart[0]) if len(apart) else len(x)


def _identity(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null"))


def _rows(rows: DataFrame, times_col: str | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, role, text, times and key, a hash of conversation, role and text."""
    times = F.col(times_col).cast("long") if times_col else F.lit(1).cast("long")
    own = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                      F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), times.alias("times"))
    whole = F.concat(_identity(F.col("conv_id")), F.lit(":"), F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return own.withColumn("key", F.unhex(F.sha2(whole.cast("binary"), 256)))


def _marked(rows: DataFrame) -> DataFrame:
    """One row per different row of a turn: copies, and whether it is blank, a repeat, cut off."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    same = stage(rows.select("conv_id", "turn", "role", "key", "times", (bare == "").alias("blank"),
                             (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
                 .groupBy("conv_id", "turn", "role", "key")
                 .agg(F.sum("times").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut")), "rows")
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    repeats = stage(same.where("copies > 0 and not blank").groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows"))
                    .where("rows > 1"), "repeats")
    found = join_groups(same, repeats, "key", "rows", same.count(), "left")
    return found.withColumn("again", F.coalesce(place > F.col("first"), F.lit(False)) & ~F.col("blank")).drop("first", "rows")


def _facts(marked: DataFrame) -> DataFrame:
    """Per conversation: gaps and the faults, each row by its first one."""
    there, copies = F.col("copies") > 0, F.col("copies")
    turn = F.when(there, F.col("turn"))
    sound = there & ~F.col("blank") & ~F.col("again")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return marked.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        total(F.when(F.col("blank"), copies)).alias("blank"),
        total(F.when(there & ~F.col("blank"), F.when(F.col("again"), copies).otherwise(copies - 1))).alias("duplicate"),
        total(F.when(sound & F.col("cut"), 1)).alias("truncated"))


def _runs(column: pa.Array) -> Iterator[tuple[object, int, int]]:
    """(value, from, to) of equal neighbours."""
    coded = pc.run_end_encode(column)
    at = 0
    for value, end in zip(coded.values.to_pylist(), coded.run_ends.to_pylist(), strict=True):
        yield value, at, end
        at = end


_LEGAL = {"su", "ua", "au"}


def _signatures(marked: DataFrame) -> DataFrame:
    """(conv_id, signature, illegal) of every conversation; sorted rows stream by."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(F.col("blank") | F.col("again"), F.lit(GONE)).when(F.col("cut"), F.upper(initial)).otherwise(initial)
    rows = (marked.select("conv_id", "turn", "role", "key", "copies", initial.alias("initial"), letter.alias("letter"))
            .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "key")
            .select("conv_id", "copies", "initial", "letter"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, parts, illegal, last = None, None, 0, ""
        for b in batches:
            done = []
            copies, initials, letters = (b.column(c).to_pylist() for c in ("copies", "initial", "letter"))
            for value, lo, hi in _runs(b.column("conv_id")):
                if parts is None or value != conv:
                    if parts is not None:
                        done.append((conv, "".join(parts), illegal))
                    conv, parts, illegal, last = value, [], 0, ""
                for i in range(lo, hi):
                    n = copies[i]
                    if n:
                        parts.append(letters[i] + GONE * (n - 1))
                        # No initial may follow itself.
                        illegal += n - 1 + bool(last and last + initials[i] not in _LEGAL)
                        last = initials[i]
            if len(parts or ()) > 1:
                parts = ["".join(parts)]
            yield _records(done, b.schema.field("conv_id").type)
            held = b.schema.field("conv_id").type
        if parts is not None:
            yield _records([(conv, "".join(parts), illegal)], held)

    def _records(done: list, kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                                          names=["conv_id", "signature", "illegal"])

    return rows.mapInArrow(read, f"conv_id {kind}, signature string, illegal long")


def _solved(signatures: DataFrame) -> DataFrame:
    """(signature, rows, cost, audit) of every different signature, sorted from the end."""
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for b in batches:
            found = [automaton.solve(s) for s in b.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("signature"), b.column("rows"), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([a for _, a in found], pa.string())], names=["signature", "rows", "cost", "audit"])

    ordered = (signatures.groupBy("signature").agg(F.count(F.lit(1)).alias("rows")).withColumn("backward", F.reverse("signature"))
               .repartitionByRange("backward").sortWithinPartitions("backward").drop("backward"))
    return ordered.mapInArrow(solve, "signature string, rows long, cost long, audit string")


class _Repair:
    """Hash of one repaired conversation, fed with its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.begun = audit, 0, START, hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode("utf-8", "replace"))
        self.begun = True

    def _inserted(self) -> None:
        while self.audit.startswith("I", self.at):
            self.at += 1
            self.state = _NEXT[self.state]
            self._write(ROLE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = SYSTEM if self.state == START and role[:1] == "s" else _NEXT[self.state]
            self._write(role, text)
        elif edit == "R":
            self.state = _NEXT[self.state]
            self._write(ROLE[self.state], text)

    def finish(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def _hashed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's audit, then its rows, stream by in order."""
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "key", "text", "times")]
    lines = audits.select("conv_id", *none, "audit").unionByName(
        rows.where("times > 0").select("conv_id", "turn", "role", "key", "text", "times", F.lit(None).cast("string").alias("audit")))
    ordered = (lines.repartition("conv_id")
               .sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "key")
               .select("conv_id", "role", "text", "times", "audit"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now, held = None, None, None
        for b in batches:
            held, ids, hashes = b.schema.field("conv_id").type, [], []
            for value, role, text, times, audit in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if audit is not None:
                    if now:
                        ids.append(conv)
                        hashes.append(now.finish())
                    conv, now = value, _Repair(audit)
                else:
                    for _ in range(times):
                        now.row(role, text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, held), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([conv], held), pa.array([now.finish()], pa.string())], names=["conv_id", "repaired_sha256"])

    return ordered.mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, *, times_col: str | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    own = _rows(rows, times_col, conv_col, turn_col, role_col, text_col)
    marked = stage(_marked(own), "marked")
    signatures = stage(_signatures(marked), "signatures")
    solved = stage(_solved(signatures), "solved")
    audits = stage(join_groups(signatures, solved, "signature", "rows", signatures.count())
                   .select("conv_id", "illegal", "cost", "audit"), "audits")
    out = audits
    for part in (_facts(marked), _hashed(own, audits)):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, out["conv_id"].eqNullSafe(part["_conv"])).drop("_conv")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
