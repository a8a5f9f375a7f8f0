"""Conversation structure repair: the cheapest edits that make every conversation well formed.

A row is kept, given another role or deleted, or an empty turn is put before it, so
that the roles read: an optional system turn, then user and assistant in turn, ending
with the assistant. What an edit costs depends only on the row's symbol (its role's
initial and its fault) and on the state that the repaired part before it left, so a
row is a 4 by 4 matrix of costs and a conversation is their min-plus product. Equal
rows in succession collapse to a run; a run is applied by binary powers of its
matrix, which are cached. The choices are unrolled from the costs behind each row,
halving a run until a row is left, so memory follows the logarithm of its length.

At scale rows are sorted over all conversations at once, in ranges, with their number
as the last key: a conversation or a set of equal rows with much of the table is cut
over many tasks. Texts move once for that and once to meet their edits. Only symbols,
one letter a row, meet in the task that solves a conversation; its result, the audit,
is one value with a letter for each row and cannot be smaller.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import slices
from tagloom.sources.storage import materialise

#: Characters that a text is blank without.
BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
#: A null role or text, and a null part of a row's name.
NULL = " "
#: Costs of the edits; KEEP is 0. TRUNCATED is added for a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States by what the repaired part ends with: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn leads to: the one that is wanted next.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Symbol of a row that must go; others are s, u, a or o by their role, upper case if truncated.
DEAD = "d"
NEVER = 1 << 60
LEGAL = ("su", "ua", "au")
#: Rows of 2 to this power numbers in succession meet their edits in one group.
PART_BITS = 17
#: Rows of a segment, at most.
SEGMENT_ROWS = 1 << 16
#: Conversations whose solution a task remembers, and their longest symbols.
MEMO, MEMO_ROWS = 50_000, 64
Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# --- costs -----------------------------------------------------------------


def kept_state(symbol: str, state: int) -> int | None:
    """State behind a row that is kept, None if its role does not fit."""
    initial = symbol.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    if initial in "ua" and NEXT[state] == (USER if initial == "u" else ASSISTANT):
        return NEXT[state]
    return None


def times(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b, strict=True))
    return tuple(tuple(min(map(int.__add__, row, column)) for column in columns) for row in a)


def applied(a: Matrix, costs: Vector) -> Vector:
    return tuple(min(map(int.__add__, row, costs)) for row in a)


@lru_cache(maxsize=1)
def insertions() -> Matrix:
    """Costs of going from state to state by empty turns alone; three reach every state that any number does."""
    costs = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
    for state in range(4):
        at = state
        for turns in range(1, 4):
            at = NEXT[at]
            costs[state][at] = min(costs[state][at], INSERT * turns)
    return tuple(map(tuple, costs))


@lru_cache(maxsize=4096)
def power(symbol: str, exponent: int) -> Matrix:
    """Costs of 2**exponent rows of a symbol, empty turns before each included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    costs = [[NEVER] * 4 for _ in range(4)]
    extra = TRUNCATED if symbol.isupper() else 0
    for state in range(4):
        costs[state][state] = DELETE
        if symbol != DEAD:
            costs[state][NEXT[state]] = min(costs[state][NEXT[state]], REROLE + extra)
            kept = kept_state(symbol, state)
            if kept is not None:
                costs[state][kept] = min(costs[state][kept], extra)
    return times(insertions(), tuple(map(tuple, costs)))


def before(symbol: str, rows: int, behind: Vector) -> Vector:
    """Costs from before a run to the end, from those behind it."""
    for exponent in range(rows.bit_length()):
        if rows >> exponent & 1:
            behind = applied(power(symbol, exponent), behind)
    return behind


def behind_each(symbol: str, rows: int, behind: Vector) -> Iterator[Vector]:
    """Costs behind each row of a run, the first row's first."""
    if rows == 1:
        yield behind
        return
    half = rows // 2
    yield from behind_each(symbol, rows - half, before(symbol, half, behind))
    yield from behind_each(symbol, half, behind)


END: Vector = tuple(min(cost + (0 if at in (START, ASSISTANT) else NEVER) for at, cost in enumerate(row)) for row in insertions())


def solve(symbols: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair: I for each empty turn, D, K or R for each row.

    Of the cheapest audits this is the one whose letters come first in ASCII.
    """
    runs = [(m.group()[0], len(m.group())) for m in re.finditer(r"(.)\1*", symbols)]
    costs = [END]
    for symbol, rows in reversed(runs):
        costs.append(before(symbol, rows, costs[-1]))
    costs.reverse()
    state, made = START, []
    for number, (symbol, rows) in enumerate(runs):
        extra = TRUNCATED if symbol.isupper() else 0
        for behind in behind_each(symbol, rows, costs[number + 1]):
            left = applied(power(symbol, 0), behind)[state]
            while DELETE + behind[state] != left and _insert_pays(symbol, behind, NEXT[state], left):
                made.append("I")
                state, left = NEXT[state], left - INSERT
            kept = kept_state(symbol, state)
            if DELETE + behind[state] == left:
                made.append("D")
            elif kept is not None and extra + behind[kept] == left:
                made.append("K")
                state = kept
            else:
                made.append("R")
                state = NEXT[state]
    while state not in (START, ASSISTANT):
        made.append("I")
        state = NEXT[state]
    return costs[0][START], "".join(made)


def edits_of_rows(symbols: str, audit: str) -> Iterator[tuple[int, str]]:
    """(state before a row, its edits) in order; the last row has the empty turns behind it as well."""
    state, last = START, len(symbols) - 1
    for number, found in enumerate(re.finditer(r"I*[DKR]", audit)):
        edits = found.group() if number < last else audit[found.start() :]
        yield state, edits
        for edit in edits:
            if edit == "K":
                state = kept_state(symbols[number], state)
            elif edit != "D":
                state = NEXT[state]


def _insert_pays(symbol: str, behind: Vector, state: int, left: int) -> bool:
    return INSERT + applied(power(symbol, 0), behind)[state] == left


# --- rows in order ---------------------------------------------------------


def in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A written table (c, t, r, x, n): the rows of each conversation in order, numbered over all.

    Turns go up, nulls first; rows of one turn go by role, then by text (by its
    first 100 characters, then by a digest). Null roles and texts are one space.
    Equal rows are told apart by their place in the input, so that ranges can part
    them; ``n`` orders all rows.
    """
    plain = rows.select(
        F.col(conv).alias("c"), F.col(turn).cast("bigint").alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit(NULL)).alias("r"),
        F.coalesce(F.col(text).cast("string"), F.lit(NULL)).alias("x"),
    )
    keyed = plain.select(
        "*", F.substring("x", 1, 100).alias("start"), F.unhex(F.md5("x")).alias("digest"), F.monotonically_increasing_id().alias("place")
    )
    order = ["c", F.asc_nulls_first("t"), "r", "start", "digest", "place"]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(sorted_rows.select("c", "t", "r", "x", "digest", F.monotonically_increasing_id().alias("n")), "turns")


def _fault_columns() -> list[Column]:
    last = F.substring(F.rtrim("x", F.lit(BLANKS)), -1, 1)
    return [
        F.substring("r", 1, 1).alias("i"), (last == "").alias("blank"),
        (~last.isin(list(ENDS))).alias("cut"),
    ]


@dataclass
class Segment:
    """Successive rows of one conversation in one task: symbols and what its neighbours must know."""

    conv: object
    start: int
    symbols: list[str] = field(default_factory=list)
    first: str | None = None
    last: str | None = None
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])  # blank, duplicate, truncated, illegal
    least: int | None = None
    most: int | None = None
    turns: int = 0

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, new: bool) -> None:
        if blank or not new:
            self.counts[0 if blank else 1] += 1
            self.symbols.append(DEAD)
        else:
            self.counts[2] += cut
            letter = initial if initial in ("s", "u", "a") else "o"
            self.symbols.append(letter.upper() if cut else letter)
        if self.last is None:
            self.first = initial
        else:
            self.counts[3] += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1


SEGMENT = "n bigint, symbols string, first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, least bigint, most bigint, turns bigint"


def segments(turns: DataFrame, most: int = SEGMENT_ROWS) -> DataFrame:
    """(c, n, symbols, ...): the rows of ``in_order`` by task, without their texts.

    Which rows are the first of their role and text is found by one minimum a
    group; those numbers then meet the rows in a sort by number. No row is joined
    by a key that others share.
    """
    kind = turns.schema["c"].dataType.simpleString()
    firsts = turns.groupBy("c", "r", "digest").agg(F.min("n").alias("n"))
    rows = turns.select("n", F.lit(True).alias("row"), "c", "t", *_fault_columns())
    marks = firsts.select("n", F.lit(False).alias("row"))
    met = rows.unionByName(marks, allowMissingColumns=True).repartitionByRange("n").sortWithinPartitions("n", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        typed = Typed(batches, 2)
        at, marked, done = None, None, []
        for n, row, conv, *faults in typed:
            if not row:
                marked = n
                continue
            if at is None or at.conv != conv or at.start + len(at.symbols) != n or len(at.symbols) == most:
                done += [at] if at else []
                at = Segment(conv, n)
                if len(done) == 4096:
                    yield _batch(SEGMENT, _records(done), typed.kind)
                    done = []
            at.add(*faults, marked == n)
        if at is not None:
            yield _batch(SEGMENT, _records([*done, at]), typed.kind)

    return met.mapInArrow(run, f"c {kind}, {SEGMENT}")


def _records(done: list[Segment]) -> list[tuple]:
    return [(s.conv, s.start, "".join(s.symbols), s.first, s.last, *s.counts, s.least, s.most, s.turns) for s in done]


# --- solutions -------------------------------------------------------------

AUDIT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def plan(turns: DataFrame, segment_rows: int = SEGMENT_ROWS, part_bits: int = PART_BITS) -> DataFrame:
    """A written table of two kinds of rows: one for each conversation (n null) and one for each row.

    The first hold (c, gaps, blank, duplicate, truncated, illegal, cost, audit),
    the others (c, n, state, edits, whole): a row's number, the state before it,
    its edits, and whether the conversation lies in one part of 2**``part_bits`` numbers.
    """
    parts = segments(turns, segment_rows)
    kind = parts.schema["c"].dataType.simpleString()
    # By conversation and in order; a conversation of many rows brings symbols alone.
    met = parts.repartition("c").sortWithinPartitions("c", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, str]] = {}
        typed, rows = Typed(batches), []
        for row in chain.from_iterable(_solved(group, memo, part_bits) for group in _conversations(typed)):
            rows.append(row)
            if len(rows) == 8192:
                yield _batch(PLAN, rows, typed.kind)
                rows = []
        if rows:
            yield _batch(PLAN, rows, typed.kind)

    return materialise(met.mapInArrow(run, f"c {kind}, {PLAN}"), "plan")


PLAN = f"n bigint, state int, edits string, whole boolean, {AUDIT}"


class Typed:
    """Rows of Arrow batches as tuples; ``kind`` is the type of the column ``at``, known once a row is out."""

    def __init__(self, batches: Iterator[pa.RecordBatch], at: int = 0):
        self.batches, self.at, self.kind = batches, at, None

    def __iter__(self) -> Iterator[tuple]:
        for batch in slices(self.batches, 1024):
            self.kind = batch.schema.field(self.at).type
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _conversations(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Segments of one conversation after another."""
    group: list[tuple] = []
    for row in rows:
        if group and group[0][0] != row[0]:
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _solved(group: list[tuple], memo: dict[str, tuple[int, str]], part_bits: int) -> Iterator[tuple]:
    """Rows of ``plan`` for the segments of one conversation, in order."""
    conv, symbols = group[0][0], "".join(s[2] for s in group)
    found = memo.get(symbols)
    if found is None:
        found = solve(symbols)
        if len(symbols) <= MEMO_ROWS:
            if len(memo) >= MEMO:
                memo.clear()
            memo[symbols] = found
    cost, audit = found
    blank, duplicate, truncated, illegal = (sum(s[k] for s in group) for k in range(5, 9))
    illegal += sum(a[4] + b[3] not in LEGAL for a, b in zip(group, group[1:], strict=False))
    dated = [s for s in group if s[9] is not None]
    turns = sum(s[11] for s in dated) - sum(a[10] == b[9] for a, b in zip(dated, dated[1:], strict=False))
    gaps = dated[-1][10] - dated[0][9] + 1 - turns if dated else 0
    yield conv, None, None, None, None, gaps, blank, duplicate, truncated, illegal, cost, audit
    whole = group[0][1] >> part_bits == (group[-1][1] + len(group[-1][2]) - 1) >> part_bits
    numbers = chain.from_iterable(range(s[1], s[1] + len(s[2])) for s in group)
    for n, (state, edits) in zip(numbers, edits_of_rows(symbols, audit), strict=True):
        yield conv, n, state, edits, whole, *[None] * 7


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(fields: str, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """Rows whose first column is the conversation, of type ``kind``, the others as in ``fields``."""
    names, types = zip(*(part.split() for part in fields.split(", ")), strict=True)
    columns = zip(zip(*rows, strict=True), [kind, *(ARROW[t] for t in types)], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["c", *names])


TURN = "n bigint, k int, edit string, r string, x string, whole boolean"


def repaired_rows(turns: DataFrame, planned: DataFrame, part_bits: int = PART_BITS) -> DataFrame:
    """(c, n, k, edit, r, x, whole): the repaired rows, k counting those that one row made; edit is I, K or R.

    A part of a conversation (2**``part_bits`` numbers of rows) is in one task, in
    order; ``whole`` says that the conversation has no other.
    """
    kind = turns.schema["c"].dataType.simpleString()
    edits = planned.filter(F.col("n").isNotNull()).select("c", "n", F.lit(False).alias("row"), "state", "edits", "whole")
    rows = turns.select("c", "n", F.lit(True).alias("row"), "r", "x")
    met = rows.unionByName(edits, allowMissingColumns=True).withColumn("part", F.shiftright("n", part_bits))
    met = met.repartition("c", "part").sortWithinPartitions("c", "n", "row").drop("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, edits, whole = START, "", False
        for batch in slices(batches):
            made: list[tuple] = []
            for conv, n, row, role, text, *edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row:
                    made += [(conv, n, k, *turn, whole) for k, turn in enumerate(_replayed(role, text, state, edits))]
                else:
                    state, edits, whole = edit
            if made:
                yield _batch(TURN, made, batch.schema.field(0).type)

    return met.mapInArrow(run, f"c {kind}, {TURN}")


def _replayed(role: str, text: str, state: int, edits: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that a row's edits leave."""
    for edit in edits:
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else NEXT[state]
            yield edit, role, text
        elif edit != "D":
            state = NEXT[state]
            yield edit, ROLE[state], "" if edit == "I" else text


class Hasher:
    """SHA-256 of the ``role:text`` lines of one conversation after another."""

    def __init__(self):
        self.conv, self.digest = None, None

    def add(self, conv, role: str, text: str) -> list[tuple]:
        """The conversation before, if this line begins another."""
        done = []
        if self.digest is None or conv != self.conv:
            done = self.end()
            self.conv, self.digest = conv, hashlib.sha256()
        else:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        return done

    def end(self) -> list[tuple]:
        return [(self.conv, self.digest.hexdigest())] if self.digest else []


LINE = "sha256 string, n bigint, k int, r string, x string"


def digests(repaired: DataFrame) -> DataFrame:
    """(c, sha256) of the conversations that have repaired rows: ``role:text`` joined by newlines.

    Whole conversations are hashed where they lie. The parts of others are written
    and streamed in order through one task each, in the memory of one row: a
    SHA-256 has no other order.
    """
    kind = repaired.schema["c"].dataType.simpleString()

    def hash_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, arrow = Hasher(), None
        for batch in slices(batches):
            arrow, made = batch.schema.field(0).type, []
            for conv, n, k, _, role, text, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if whole:
                    made += [(*done, None, None, None, None) for done in hasher.add(conv, role, text)]
                else:
                    made.append((conv, None, n, k, role, text))
            if made:
                yield _batch(LINE, made, arrow)
        if last := hasher.end():
            yield _batch(LINE, [(*last[0], None, None, None, None)], arrow)

    found = materialise(repaired.mapInArrow(hash_whole, f"c {kind}, {LINE}"), "digests")
    rest = found.filter(F.col("sha256").isNull()).repartition("c").sortWithinPartitions("c", "n", "k").select("c", "r", "x")

    def hash_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        typed, hasher = Typed(batches), Hasher()
        for line in typed:
            if done := hasher.add(*line):
                yield _batch("sha256 string", done, typed.kind)
        if last := hasher.end():
            yield _batch("sha256 string", last, typed.kind)

    streamed = rest.mapInArrow(hash_rest, f"c {kind}, sha256 string")
    return found.filter(F.col("sha256").isNotNull()).select("c", "sha256").unionByName(streamed)


# --- the operator ----------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    """What a repair gives: ``audits``, one row a conversation, and ``rows``, the repaired turns."""

    audits: DataFrame
    rows: DataFrame


def repair(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment_rows: int = SEGMENT_ROWS, part_bits: int = PART_BITS,
) -> Repair:
    """The cheapest repair of every conversation.

    ``audits`` has (conv, gaps, blank, duplicate, truncated, illegal, cost, audit)
    for every conversation of ``rows``, a null one among them. ``rows`` has (conv,
    position, part, edit, role, text, whole): ``position`` and then ``part`` order
    the turns of a conversation.

    A row's first fault counts: blank (nothing but blanks), duplicate (its role and
    text were seen in an earlier row), truncated (the last character that is no
    blank is none of ``.!?``). Gaps are the turn numbers missing between the
    smallest and the largest, nulls left out; illegal is the number of neighbours
    whose roles' initials are not su, ua or au. A role counts by its initial. Rows
    of one turn go by role, then text; null turns come first; null roles and texts
    are one space. The audit has an edit's initial for each row (Delete, Keep,
    Rerole) and each Insert; of the cheapest, the one first in ASCII. An empty
    table gives empty results.
    """
    turns = in_order(rows, conv, turn, role, text)
    planned = plan(turns, segment_rows, part_bits)
    named = F.col("c").alias(conv)
    audits = planned.filter(F.col("n").isNull()).select(named, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    made = repaired_rows(turns, planned, part_bits)
    final = made.select(named, F.col("n").alias("position"), F.col("k").alias("part"), "edit", F.col("r").alias("role"), F.col("x").alias("text"), "whole")
    return Repair(audits, final)


def repaired_digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, repaired_sha256) of the conversations that have repaired rows."""
    columns = {"c": conv, "n": "position", "k": "part", "edit": "edit", "r": "role", "x": "text", "whole": "whole"}
    plain = repaired.select(*[F.col(name).alias(short) for short, name in columns.items()])
    return digests(plain).select(F.col("c").alias(conv), F.col("sha256").alias("repaired_sha256"))


def damaged(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults made by the crc32 of ``conv:turn`` modulo 20; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4
    makes its role ``user``.
    """
    plain = [F.coalesce(F.col(name).cast("string"), F.lit(NULL)) for name in (conv, turn, role, text)]
    kind = F.crc32(F.concat(plain[0], F.lit(":"), plain[1]).cast("binary")) % 20
    named = rows.select(F.col(conv).alias("c"), F.col(turn).alias("t"), plain[2].alias("r"), plain[3].alias("x"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    made = named.filter(F.col("kind") != 0).select("*", F.explode(copies).alias("copy"))
    return made.select(
        F.col("c").alias(conv), F.col("t").alias(turn),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("r")).alias(role),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("x", "[.!?]", "")).otherwise(F.col("x")).alias(text),
    )
