"""Conversation structure repair by a run-length min-plus program.

Turns are kept, given another role, deleted or inserted so that their role
initials read ``(s?(ua)+)?``, at the least cost; among edits of equal cost those
whose initials, in order, are least in ASCII order (Delete, Insert, Keep,
Rerole).  A turn's first fault counts: ``blank`` (nothing but U+0020 and U+0009
to U+000D), ``duplicate`` (role and text seen earlier in the conversation),
``truncated`` (the last character that is no blank is not one of ``.!?``).

1. Each turn becomes a symbol of its role's initial and its fault; a turn that
   must go is one symbol whatever its role.  The program's four states are what
   may follow: the start, after a system turn, after a user, after an
   assistant.  A symbol is a 4 x 4 matrix of least costs (inserts before the
   turn, then its edit).
2. A task streams the symbols of its conversations in order and keeps them as
   runs of equal ones.  From the end, each run advances the vector of costs to
   the finish by its matrix to the power of its length, a product of cached
   binary powers.
3. From the start the choices are unrolled: a run's vectors are taken ``CHUNK``
   turns at a time, the far end of each again by powers, and at every turn the
   first edit in ASCII order that keeps to the least cost is the one.
4. The audits then meet the turns in the same order, and the repaired turns
   stream out, or the SHA-256 of their lines.

Conversations are dealt by id; a task streams its turns in sorted order, which
spills, and holds of a conversation only its runs, its audit (a letter an edit)
and the vectors of one chunk.  One conversation is read by one task, as the one
digest of all its turns needs; its texts are never gathered.

Defined results: turns are taken in order of turn (nulls first), then role,
then text; null roles and texts are one blank; equal rows are duplicates of
each other; a role whose initial is not s, u or a, or without one, cannot be
kept; gaps ignore null turns and are 0 if all are null; rows with a null
conv_id are one conversation; rows that are not ``present`` are no turns, but
their conversation is in the result, with zeros, an empty audit and the digest
of the empty text if it has no other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import prepare, written

# What the edits cost, and the roles.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = ("system", "user", "assistant")
BLANKS = "\\x20\\x09-\\x0D"

CHUNK = 4096            # runs, and turns of a run, whose vectors are held at once

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)            # what an inserted or reroled turn becomes in each state
OTHER = 3                                       # the class of a role that cannot be kept; else its place in ROLES
NEVER = 1 << 60
GONE = 0                                        # the symbol of a turn that must be deleted

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def symbol(role: int, truncated: bool) -> int:
    return 1 + 2 * role + truncated


def kept_state(state: int, role: int) -> int | None:
    """The state after a kept turn of this role class, or None where it may not stand."""
    allowed = (SYSTEM, USER) if state == START else (NEXT[state],)
    return role + 1 if role != OTHER and role + 1 in allowed else None


def apply(matrix: Matrix, vector: Vector) -> Vector:
    return tuple(min(m + v for m, v in zip(row, vector)) for row in matrix)


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(zip(*(apply(a, column) for column in zip(*b))))


def _inserts() -> Matrix:
    """Least cost from state to state by inserts alone: two reach every state that inserts can."""
    rows = [[0 if p == q else NEVER for q in range(4)] for p in range(4)]
    for p in range(4):
        first = NEXT[p]
        rows[p][first] = min(rows[p][first], INSERT)
        rows[p][NEXT[first]] = min(rows[p][NEXT[first]], 2 * INSERT)
    return tuple(map(tuple, rows))


INSERTS = _inserts()
FINISH = apply(INSERTS, (0, NEVER, NEVER, 0))       # nothing at all, or after an assistant


def row_edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of what may be done with a turn, by initial."""
    edits = [("D", DELETE, state)]
    if sym != GONE:
        role, extra = (sym - 1) // 2, TRUNCATED * ((sym - 1) % 2)
        if (after := kept_state(state, role)) is not None:
            edits.append(("K", extra, after))
        edits.append(("R", REROLE + extra, NEXT[state]))
    return edits


@lru_cache(maxsize=None)
def power(sym: int, exponent: int) -> Matrix:
    """The symbol's transition to the power of 2 ** exponent."""
    if exponent:
        half = power(sym, exponent - 1)
        return product(half, half)
    turn = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in row_edits(sym, state):
            turn[state][after] = min(turn[state][after], cost)
    return product(INSERTS, tuple(map(tuple, turn)))


def advance(sym: int, length: int, costs: Vector) -> Vector:
    """Costs to the finish before a run, from those after it."""
    exponent = 0
    while length:
        if length & 1:
            costs = apply(power(sym, exponent), costs)
        length >>= 1
        exponent += 1
    return costs


class Runs:
    """The symbols of a conversation, equal neighbours as one."""

    def __init__(self) -> None:
        self.symbols, self.lengths = array("b"), array("q")

    def add(self, sym: int) -> None:
        if self.symbols and self.symbols[-1] == sym:
            self.lengths[-1] += 1
        else:
            self.symbols.append(sym)
            self.lengths.append(1)

    def before(self, blocks: range, costs: Vector) -> Iterator[Vector]:
        """The costs after each of these runs, last first, and then those before the first."""
        for r in reversed(blocks):
            yield costs
            costs = advance(self.symbols[r], self.lengths[r], costs)
        yield costs

    def plan(self) -> tuple[int, str]:
        """Least cost and audit."""
        blocks = [range(at, min(at + CHUNK, len(self.symbols))) for at in range(0, len(self.symbols), CHUNK)]
        ends, costs = [], FINISH
        for block in reversed(blocks):
            ends.append(costs)
            for costs in self.before(block, costs):
                pass
        total, state, audit = costs[START], START, []
        for block in blocks:
            after = list(self.before(block, ends.pop()))[-2::-1]
            for r, costs in zip(block, after):
                state = self._unroll(r, state, costs, audit)
        while FINISH[state]:
            audit.append("I")
            state = NEXT[state]
        return total, "".join(audit)

    def _unroll(self, run: int, state: int, end: Vector, audit: list[str]) -> int:
        sym, left = self.symbols[run], self.lengths[run]
        letters = []
        while left:
            size = min(left, CHUNK)
            left -= size
            vectors = [advance(sym, left, end)]
            for _ in range(size):
                vectors.append(apply(power(sym, 0), vectors[-1]))
            while len(vectors) > 1:
                state = _turn(sym, state, vectors.pop(), vectors[-1], letters)
        audit.append("".join(letters))
        return state


def _turn(sym: int, state: int, here: Vector, after: Vector, letters: list[str]) -> int:
    """The state after a turn, its edits added to ``letters``."""
    while True:
        choices = [(letter, cost + after[then], then, True) for letter, cost, then in row_edits(sym, state)]
        choices.insert(1, ("I", INSERT + here[NEXT[state]], NEXT[state], False))
        letter, _, state, done = next(c for c in choices if c[1] == here[state])
        letters.append(letter)
        if done:
            return state


def _ordered(turns: DataFrame, *first: Column) -> DataFrame:
    """Conversations together, their turns in order."""
    return turns.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.asc_nulls_first("turn"), "role", "text")


def _turns(talks: DataFrame, present: str | None) -> DataFrame:
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return talks.select("conv_id", F.col("turn").cast("long").alias("turn"), value("role").alias("role"),
                        value("text").alias("text"), here.alias("present"))


def _role_class(role: Column) -> Column:
    out = F.lit(OTHER)
    for place, name in enumerate(ROLES):
        out = F.when(F.substring(role, 1, 1) == name[0], place).otherwise(out)
    return out


FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FAULTS = ("", "blank", "duplicate", "truncated")
LEGAL = {(0, 1), (1, 2), (2, 1)}                # su, ua, au


class _Conversation:
    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.runs = Runs()
        self.faults = [0] * len(FAULTS)
        self.illegal, self.role = 0, None
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn: int | None, role: int, fault: int) -> None:
        self.faults[fault] += 1
        if self.role is not None and (self.role, role) not in LEGAL:
            self.illegal += 1
        self.role = role
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        self.runs.add(GONE if FAULTS[fault] in ("blank", "duplicate") else symbol(role, FAULTS[fault] == "truncated"))

    def row(self) -> tuple:
        cost, audit = self.runs.plan()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, audit)


def audits(talks: DataFrame, present: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of (conv_id, turn, role, text).

    ``present`` names a boolean column, false where a row only says that its conversation exists.
    """
    prepare(talks.sparkSession)
    turns = _turns(talks, present).repartition("conv_id")
    # no further shuffle: what is dealt by conversation serves its parts too
    same = Window.partitionBy("conv_id", "present", "role", F.sha2("text", 256)).orderBy(F.asc_nulls_first("turn"))
    text = F.col("text")
    fault = (F.when(~text.rlike(f"[^{BLANKS}]"), 1).when(F.col("seen") > 1, 2)
             .when(~text.rlike(f"[.!?][{BLANKS}]*\\z"), 3).otherwise(0))
    ordered = (turns.withColumn("seen", F.row_number().over(same))
               .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text"))
    narrow = ordered.select("conv_id", "turn", F.when(F.col("present"), _role_class(F.col("role"))).alias("role"),
                            fault.alias("fault"))
    conv_type = talks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema = None, None
        for batch in batches:
            schema, done = batch.schema, []
            for conv_id, turn, role, fault in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                if role is not None:
                    now.add(turn, role, fault)
            if done:
                yield _table(done, schema)
        if now is not None:
            yield _table([now.row()], schema)

    return narrow.mapInArrow(run, f"conv_id {conv_type}, {', '.join(f'{c} long' for c in FACTS)}, audit string")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], schema.field(0).type), *(pa.array(c, pa.int64()) for c in columns[1:-1]),
                                       pa.array(columns[-1], pa.string())], ["conv_id", *FACTS, "audit"])


class _Editor:
    """Follows an audit through the turns of its conversation."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns put in before the next one."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "I", ROLES[self.state - 1], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = NEXT[self.state]
            yield "R", ROLES[self.state - 1], text
        elif letter == "K":
            self.state = [r[0] for r in ROLES].index(role[0]) + 1
            yield "K", role, text


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, list[tuple[str, str, str]]]]:
    """(facts, turns) pieces: facts where a conversation begins, else None; turns as (edit, role, text)."""
    editor = None
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            row = dict(zip(names, row))
            if row["audit"] is not None:
                if editor is not None:
                    yield None, list(editor.inserted())
                editor = _Editor(row["audit"])
                yield tuple(row[c] for c in ("conv_id", *FACTS, "audit")), []
            else:
                yield None, list(editor.turn(row["role"], row["text"]))
    if editor is not None:
        yield None, list(editor.inserted())


def _with_audits(talks: DataFrame, audited: DataFrame, present: str | None) -> DataFrame:
    """Each conversation's audit, then its turns in order."""
    turns = _turns(talks, present).where("present").select("conv_id", "turn", "role", "text")
    both = turns.unionByName(audited, allowMissingColumns=True)
    return _ordered(both, F.col("audit").isNull())


def repair(talks: DataFrame, present: str | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired turns, position from 1, edit K, R or I."""
    audited = written(audits(talks, present), "audits")
    conv_type = talks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        conv_id, position, kind = None, 0, None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def table() -> pa.RecordBatch:
            columns = list(zip(*held))
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["conv_id", "position", "edit", "role", "text"])

        for facts, turns in _edited(watched()):
            if facts is not None:
                conv_id, position = facts[0], 0
            for edit, role, text in turns:
                position += 1
                held.append((conv_id, position, edit, role, text))
            if len(held) >= 500:
                yield table()
                held = []
        if held:
            yield table()

    return _with_audits(talks, audited, present).mapInArrow(
        run, f"conv_id {conv_type}, position long, edit string, role string, text string")


def digests(talks: DataFrame, present: str | None = None) -> DataFrame:
    """``audits`` with ``repaired_sha256``: of the repaired ``role:text`` lines, joined by newlines."""
    audited = written(audits(talks, present), "audits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts, lines, done, kind = None, hashlib.sha256(), [], None
        first = True

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def table() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [kind, *[pa.int64()] * len(FACTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["conv_id", *FACTS, "audit", "repaired_sha256"])

        for begun, turns in _edited(watched()):
            if begun is not None:
                if facts is not None:
                    done.append((*facts, lines.hexdigest()))
                facts, lines, first = begun, hashlib.sha256(), True
            for _, role, text in turns:
                lines.update((role if first else f"\n{role}").encode())
                lines.update(b":")
                lines.update(text.encode())
                first = False
            if len(done) >= 500:
                yield table()
                done = []
        if facts is not None:
            done.append((*facts, lines.hexdigest()))
        if done:
            yield table()

    return _with_audits(talks, audited, present).mapInArrow(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in audited.schema) + ", repaired_sha256 string")
