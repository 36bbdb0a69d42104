"""Repair of the order of roles in conversations by the cheapest edits.

The roles of a well-formed conversation are a sentence of GRAMMAR, which an LR automaton reads. Rows may be kept, given another
role, deleted, and others inserted, so the automaton runs generalised: over a graph of stacks in which equal stacks after
equal rows are one node, of the least cost and, among equal costs, the least audit. The graph is grown from the last row to
the first, a node knowing the cost of what is left to read. Every edit of a node has an initial of its own, so reading the
graph from the first row by the least initial among the cheapest edits gives the least audit.

A conversation may be larger than a task: it is dealt out in parts by range, each part is summed up as least costs from stack
to stack, and only those small tables are folded along a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meterline.llm.common import stored

#: `(s?(ua)+)?` by the initials of system, user and assistant.
GRAMMAR = (("P", ""), ("P", "T"), ("P", "sT"), ("T", "ua"), ("T", "Tua"))

ROLES = {"u": "user", "a": "assistant"}
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: A cost that nothing reaches.
NEVER = 1 << 60

#: What doesn't count as content.
SPACE = " \t\n\x0b\x0c\r"

#: Rows and characters of a part.
ROWS, CHARACTERS = 1024, 1 << 20

#: How a row is flawed, the first that holds.
FINE, CUT, GONE = 0, 1, 2


def _closure(items: frozenset) -> frozenset:
    items = set(items)
    while True:
        wanted = {GRAMMAR[rule][1][dot] for rule, dot in items if dot < len(GRAMMAR[rule][1])}
        more = {(k, 0) for k, (left, _) in enumerate(GRAMMAR) if left in wanted} - items
        if not more:
            return frozenset(items)
        items |= more


def _advance(items: frozenset, symbol: str) -> frozenset:
    return _closure(frozenset((r, d + 1) for r, d in items if GRAMMAR[r][1][d : d + 1] == symbol))


def _stacks() -> tuple[list[dict[str, int]], list[bool]]:
    """For every stack that the automaton can have: the stack after each role, and whether the sentence may end there.

    The grammar is left-recursive, so what has been read is reduced at once and there are few stacks.
    """
    start = _closure(frozenset((k, 0) for k, (left, _) in enumerate(GRAMMAR) if left == "P"))
    known, moves, at = [(start,)], [], 0
    while at < len(known):
        moves.append({})
        for role in INITIALS:
            stack = known[at]
            shifted = _advance(stack[-1], role)
            if not shifted:
                continue
            stack = (*stack, shifted)
            while len(stack[-1]) == 1:
                ((rule, dot),) = stack[-1]
                left, right = GRAMMAR[rule]
                if dot < len(right) or left == "P":
                    break
                stack = stack[: len(stack) - dot]
                stack = (*stack, _advance(stack[-1], left))
            if stack not in known:
                known.append(stack)
            moves[at][role] = known.index(stack)
        at += 1
    ends = [any(GRAMMAR[r][0] == "P" and d == len(GRAMMAR[r][1]) for r, d in s[-1]) for s in known]
    return moves, ends


MOVES, ENDS = _stacks()
N = len(MOVES)

#: An edit: its initial, the initial of the role that is written or "", and the stack after it.
Edit = tuple[str, str, int]


def _with_inserts(cost: list[int], edit: list[Edit | None]) -> None:
    """Let each node also be left by an insertion. Of equal costs the edit with the least initial stays."""
    for _ in range(N):
        for x in range(N):
            for role in ROLES:
                y = MOVES[x].get(role)
                if y is None or cost[y] >= NEVER:
                    continue
                found = cost[y] + INSERT
                if found < cost[x] or (found == cost[x] and edit[x] is not None and "I" < edit[x][0]):
                    cost[x], edit[x] = found, ("I", role, y)


def _end() -> tuple[tuple[int, ...], tuple[Edit | None, ...]]:
    cost, edit = [0 if e else NEVER for e in ENDS], [None] * N
    _with_inserts(cost, edit)
    return tuple(cost), tuple(edit)


#: After the last row: what each stack still costs, and the insertion that it needs next, if any.
END_COST, END_EDIT = _end()

_steps: dict[tuple, tuple] = {}


def _step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], tuple[Edit | None, ...]]:
    """Nodes before a row, from the costs of the nodes after it: their costs and edits. Costs are known up to a constant."""
    least = min(after)
    key = (tuple(c - least if c < NEVER else NEVER for c in after), code)
    if key not in _steps:
        initial, flaw = INITIALS[code % 4 : code % 4 + 1], code // 4
        extra = TRUNCATED if flaw == CUT else 0
        cost, edit = [], []
        for x in range(N):
            ways = [(key[0][x] + DELETE, "D", "", x)]
            if flaw != GONE:
                if initial in MOVES[x] and initial:
                    ways.append((key[0][MOVES[x][initial]] + extra, "K", initial, MOVES[x][initial]))
                ways += [(key[0][y] + extra + REROLE, "R", r, y) for r, y in MOVES[x].items() if r in ROLES]
            best = min(ways)
            cost.append(min(best[0], NEVER))
            edit.append(best[1:] if best[0] < NEVER else None)
        _with_inserts(cost, edit)
        _steps[key] = tuple(cost), tuple(edit)
    cost, edit = _steps[key]
    return tuple(c + least if c < NEVER else NEVER for c in cost), edit


def _grow(codes: bytes, copies: list[int], after: tuple[int, ...]) -> tuple[tuple[int, ...], list[tuple]]:
    """The graph over the rows of a part: costs before the first row, and the edits before each row.

    A row's further copies have to be deleted, which is always among the cheapest there and has the least initial.
    """
    edits = []
    for code, n in zip(reversed(codes), reversed(copies), strict=True):
        after = tuple(c + DELETE * (n - 1) if c < NEVER else NEVER for c in after)
        after, edit = _step(after, code)
        edits.append(edit)
    edits.reverse()
    return after, edits


def _read(edits: list[tuple], copies: list[int], at: int, last: bool) -> tuple[str, list[tuple[int, str]], int]:
    """Audit, what is written as (row or -1, initial), and the stack after the rows, starting from a stack."""
    audit, written = [], []
    for k, edit in enumerate(edits):
        while True:
            name, role, to = edit[at]
            audit.append(name)
            at = to
            if name == "I":
                written.append((-1, role))
                continue
            if name != "D":
                written.append((k if name == "K" else -2 - k, role))
            break
        if copies[k] > 1:
            audit.append("D" * (copies[k] - 1))
    while last and END_EDIT[at]:
        name, role, at = END_EDIT[at]
        audit.append(name)
        written.append((-1, role))
    return "".join(audit), written, at


def _flaw(text: str) -> int:
    solid = text.rstrip(SPACE)
    return GONE if not solid else FINE if solid[-1] in ".!?" else CUT


class _Part:
    """Rows of one conversation that follow each other."""

    def __init__(self) -> None:
        self.codes, self.copies, self.roles, self.texts, self.size = bytearray(), [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, n: int, late: bool) -> None:
        flaw = _flaw(text)
        if flaw == GONE:
            self.blank += n
        elif late:
            self.duplicate += n
            flaw = GONE
        else:
            self.duplicate += n - 1
            self.truncated += flaw == CUT
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in LEGAL
        self.illegal += n - 1
        if turn is not None:
            self.n_turns += turn != self.last_turn
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        initial = INITIALS.find(role[:1]) if role else 3
        self.codes.append(flaw * 4 + (initial if initial >= 0 else 3))
        self.copies.append(n)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def row(self, conv_id, part: int, closed: bool) -> dict:
        costs = None
        if not closed:
            ends = [tuple(0 if x == y else NEVER for x in range(N)) for y in range(N)]
            costs = [c for end in ends for c in _grow(bytes(self.codes), self.copies, end)[0]]
        return {"conv_id": conv_id, "part": part, "closed": closed, "costs": costs} | {
            k: bytes(v) if k == "codes" else v for k, v in vars(self).items() if k != "size"
        }


_SUMS = "blank long, duplicate long, truncated long, illegal long, n_turns long"


def _parts(rows: DataFrame, most: int) -> DataFrame:
    """Parts of at most so many different rows, in order of `part`; `closed` ones are a whole conversation."""
    turn, conv = (rows.schema[c].dataType.simpleString() for c in ("turn", "conv_id"))
    schema = (
        f"conv_id {conv}, part long, closed boolean, costs array<long>, codes binary, copies array<long>, "
        f"roles array<string>, texts array<string>, {_SUMS}, first_turn {turn}, last_turn {turn}"
    )
    arrow = _arrow(rows.sparkSession, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, used, out = TaskContext.get().partitionId() << 33, 0, []
        here, part, whole = None, None, False  # whole: the conversation began behind this one's first

        def done(closed: bool) -> None:
            nonlocal used
            out.append(part.row(here, base + used, closed))
            used += 1

        for batch in batches:
            for conv_id, turn, role, text, n, late in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part is None:
                    here, part = conv_id, _Part()
                elif conv_id != here:
                    done(whole)
                    here, part, whole = conv_id, _Part(), True
                elif len(part.codes) >= most or part.size >= CHARACTERS:
                    done(False)
                    part, whole = _Part(), False
                part.add(turn, role, text, n, late)
            yield from _batches(out, arrow)
            out = []
        if part is not None:
            done(False)
            yield from _batches(out, arrow)

    return rows.mapInArrow(cut, schema)


def _arrow(spark: SparkSession, schema: str) -> pa.Schema:
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 256):
        yield pa.RecordBatch.from_pylist(rows[a : a + 256], schema)


def _walked(parts: DataFrame, schema: str, walk: Callable[[Iterator[dict]], Iterator[dict]], descending: bool = False) -> DataFrame:
    """What `walk` yields for each conversation from its parts in order. A task holds one batch of parts at a time."""
    order = F.desc("part") if descending else F.asc("part")
    arrow = _arrow(parts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        found = (out for _, own in groupby(rows, key=lambda row: row["conv_id"]) for out in walk(own))
        while out := list(islice(found, 64)):
            yield pa.RecordBatch.from_pylist(out, arrow)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, schema)


def _costs_after(parts: Iterator[dict]) -> Iterator[dict]:
    """Costs after each part, from the last to the first."""
    after, last = END_COST, True
    for row in parts:
        yield {"part": row["part"], "after": list(after), "last": last}
        table, last = row["costs"], False
        after = tuple(min(min(table[y * N + x] + after[y] for y in range(N)), NEVER) for x in range(N))


def _starts(parts: Iterator[dict]) -> Iterator[dict]:
    """The stack before each part, from the first to the last."""
    at = 0
    for row in parts:
        yield {"part": row["part"], "start": at}
        at = row["ends"][at]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stack after a part for each stack before it."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            before, edits = _grow(row["codes"], row["copies"], tuple(row["after"]))
            ends = [_read(edits, row["copies"], x, False)[2] if before[x] < NEVER else 0 for x in range(N)]
            out.append({"conv_id": row["conv_id"], "part": row["part"], "ends": ends})
        yield pa.RecordBatch.from_pylist(out, pa.schema([batch.schema.field("conv_id"), ("part", pa.int64()), ("ends", pa.list_(pa.int32()))]))


def repair(rows: DataFrame, most: int = ROWS) -> DataFrame:
    """Rows (conv_id, part, closed, audit, cost, turns, blank, duplicate, truncated, illegal, n_turns, first_turn, last_turn,
    first_role, last_role) of the conversations (conv_id, turn, role, text): parts in the order of `part`.

    Most conversations are one `closed` part. Long ones, and at most two for each task, are several or are not closed;
    `summary` adds those up. `turns` holds the repaired rows (role, text), `audit` the initials of the edits in order: keep
    0, rerole 1, delete 2, insert 5, and 5 for each truncated row that is not deleted. Blank rows and duplicates are deleted.

    Rows are taken by turn, nulls first, then by role and text, so equal turns have an order too. Null roles and texts are
    one space; rows without conv_id are one conversation. Repeated rows are duplicates: only the first may stay.
    Roles other than system, user and assistant count by their first letter, or as none of them. An empty table gives no
    rows; other columns are not read. A part has at most `most` different rows.
    """
    filled = rows.select(
        "conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    )
    # a row that is there many times, or a text that a conversation repeats often, is counted before it travels
    once = filled.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    said = filled.withColumn("said", F.sha2("text", 256)).groupBy("conv_id", "role", "said")
    said = said.agg(F.max(F.col("turn").isNull()).alias("unset"), F.min("turn").alias("first"), F.max("turn").alias("last"))
    again = stored(said.where("first < last or (unset and first is not null)").drop("last"), "said-again")
    late = F.when(F.col("unset"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    a, b = once.withColumn("said", F.sha2("text", 256)).alias("a"), again.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.said") == F.col("b.said"))
    marked = a.join(b, same, "left").select("a.conv_id", "turn", "a.role", "text", "copies", F.coalesce(late, F.lit(False)).alias("late"))
    order = ["conv_id", "turn", "role", "text"]
    parts = stored(_parts(marked.repartitionByRange(*order).sortWithinPartitions(*order), most), "conversation-parts")

    open_ = parts.where(~F.col("closed")).select("conv_id", "part", "codes", "copies", "costs")
    after = _walked(open_.select("conv_id", "part", "costs"), "part long, after array<long>, last boolean", _costs_after, True)
    after = stored(after, "conversation-costs")
    conv = rows.schema["conv_id"].dataType.simpleString()
    ends = open_.join(after, "part").mapInArrow(_ends, f"conv_id {conv}, part long, ends array<int>")
    starts = stored(_walked(ends, "part long, start int", _starts), "conversation-starts")

    whole = parts.where("closed").withColumns({"after": F.array(*map(F.lit, END_COST)).cast("array<long>"), "last": F.lit(True), "start": F.lit(0)})
    known = parts.where("not closed").join(after, "part").join(starts, "part").select(whole.columns)
    schema = (
        f"conv_id {conv}, part long, closed boolean, audit string, cost long, turns array<struct<role:string,text:string>>, "
        f"{_SUMS}, first_turn {rows.schema['turn'].dataType.simpleString()}, last_turn {rows.schema['turn'].dataType.simpleString()}, "
        "first_role string, last_role string"
    )
    arrow = _arrow(rows.sparkSession, schema)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                before, edits = _grow(row["codes"], row["copies"], tuple(row["after"]))
                audit, written, to = _read(edits, row["copies"], row["start"], row["last"])
                left = 0 if row["last"] else row["after"][to]
                turns = [
                    {"role": row["roles"][k] if k >= 0 else ROLES[r], "text": "" if k == -1 else row["texts"][k if k >= 0 else -2 - k]}
                    for k, r in written
                ]
                solved = {"audit": audit, "cost": before[row["start"]] - left, "turns": turns}
                out.append(row | solved | {"first_role": row["roles"][0], "last_role": row["roles"][-1]})
            yield from _batches([{k: r[k] for k in arrow.names} for r in out], arrow)

    return whole.unionByName(known).mapInArrow(solve, schema)


def _summed(parts: Iterator[dict]) -> Iterator[dict]:
    """One row for a conversation of several parts."""
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "n_turns"), 0)
    digest, begun, audit = hashlib.sha256(), False, []
    first = last = role = None
    for row in parts:
        for name in sums:
            sums[name] += row[name]
        for turn in row["turns"]:
            digest.update(f"{chr(10) if begun else ''}{turn['role']}:{turn['text']}".encode())
            begun = True
        if role is not None:
            sums["illegal"] += role[:1] + row["first_role"][:1] not in LEGAL
        role = row["last_role"]
        if row["first_turn"] is not None:
            sums["n_turns"] -= row["first_turn"] == last
            first, last = row["first_turn"] if first is None else first, row["last_turn"]
        audit.append(row["audit"])
    ends = {"conv_id": row["conv_id"], "first_turn": first, "last_turn": last}
    yield sums | ends | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def summary(parts: DataFrame) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one for each conversation of
    `repair`. The last is the SHA-256 of its repaired rows as `role:text`, joined by line ends. gaps are turns that are
    missing between the first and the last.

    A hash runs over its text in order, so a conversation of several parts passes one task, part by part.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    whole = parts.where("closed").withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256))
    kind = parts.schema["first_turn"].dataType.simpleString()
    conv = parts.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, {_SUMS}, cost long, audit string, first_turn {kind}, last_turn {kind}, repaired_sha256 string"
    both = _walked(parts.where("not closed"), schema, _summed).unionByName(whole.select(*_names(schema)))
    gaps = F.coalesce(F.expr("cast(last_turn as long) - first_turn + 1 - n_turns"), F.lit(0)).alias("gaps")
    return both.select("conv_id", gaps, *counts, "repaired_sha256")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]
