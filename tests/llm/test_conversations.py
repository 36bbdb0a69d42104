"""Conversation repair against a search over all edits, on one conversation at a time."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from meterline.llm import conversations
from meterline.llm.queries import QUERIES
from tests.conftest import SMALL

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def best_edits(rows):
    """(cost, audit, lines) of the cheapest repair: Dijkstra over (rows read, state), paths compared as (cost, audit)."""
    seen, flaws = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        flaws.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines, flaws
        if (i, state) in done:
            continue
        done.add((i, state))
        for new, name in (("u", "user"), ("a", "assistant")):
            to = after.get((state, new))
            if to:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*lines, f"{name}:")))
                if i < len(rows) and flaws[i] in ("", "truncated"):
                    more = 5 if flaws[i] else 0
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*lines, f"{name}:{rows[i][1]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            to = after.get((state, rows[i][0][:1]))
            if to and flaws[i] in ("", "truncated"):
                heapq.heappush(heap, (cost + (5 if flaws[i] else 0), audit + "K", i + 1, to, (*lines, f"{rows[i][0]}:{rows[i][1]}")))


def summed(rows):
    """What the summary says of rows (turn, role, text)."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r))
    cost, audit, lines, flaws = best_edits([r[1:] for r in rows])
    turns = {r[0] for r in rows} - {None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(flaws.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


SCHEMA = "conv_id long, turn long, role string, text string, part string, cost int"


def check(spark, by_conv, most):
    data = [(c, *row, "x", 1) for c, rows in by_conv.items() for row in rows]
    random.Random(1).shuffle(data)
    parts = conversations.repair(spark.createDataFrame(data, SCHEMA).repartition(3), most)
    got = {r[0]: tuple(r[1:]) for r in conversations.summary(parts).collect()}
    assert got.keys() == by_conv.keys()
    for c, rows in by_conv.items():
        assert got[c] == summed(rows), (c, rows)


def talk(rng, n):
    """Rows of a conversation with every kind of flaw, ties, repeated rows and unknown roles."""
    roles = ["user", "assistant"] * 3 + ["system", "tool", "u", "", None, "Assistant"]
    texts = ["Yes.", "No!", "why", "", " \t", None, "Done? ", "é.", ";\n."]
    rows = [(rng.choice([i, i, i, i // 2, None]), rng.choice(roles), rng.choice([*texts, f"{i}.", f"{i}.", f"{i}?", f"{i}"])) for i in range(n)]
    return [r for r in rows for _ in range(rng.choice([1, 1, 1, 1, 2, 5]))]


@pytest.mark.parametrize("most", [conversations.ROWS, 1, 3])
def test_random_conversations(spark, most):
    rng = random.Random(most)
    check(spark, {i if i else None: talk(rng, rng.randint(1, 14)) for i in range(120)}, most)


def test_a_conversation_larger_than_a_part(spark):
    """One conversation has nearly all rows, many of them the same row or the same text, and is dealt out over parts."""
    rng = random.Random(9)
    rows = talk(rng, 400) + [(7, "user", "Same.")] * 300 + [(k, "assistant", "Again.") for k in range(300)]
    rows += [(5, "user", f"{k}?") for k in range(50)]
    check(spark, {1: talk(rng, 5), 2: rows, 3: talk(rng, 6)}, 16)


def test_audits_with_ties():
    for rows, audit in (
        ([("assistant", "A.")], "D"), ([("user", "A.")], "D"), ([("system", "A.")], "D"), ([], ""),
        ([("user", "A."), ("user", "B.")], "KR"), ([("system", "S."), ("user", "A."), ("assistant", "B")], "KDD"),
    ):
        part = conversations._Part()
        for k, (role, text) in enumerate(rows):
            part.add(k, role, text, 1, False)
        cost, edits = conversations._grow(bytes(part.codes), part.copies, conversations.END_COST)
        got = conversations._read(edits, part.copies, 0, True)[0]
        assert (cost[0], got) == best_edits(rows)[:2]
        if audit != "KDD":
            assert got == audit


def test_turns_are_returned(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Yes."), (1, 2, "user", ""), (1, 3, "user", "And?")]
    parts = conversations.repair(spark.createDataFrame(rows, "conv_id int, turn short, role string, text string")).collect()
    assert [(t.role, t.text) for p in sorted(parts, key=lambda p: p.part) for t in p.turns] == [("user", "Yes."), ("assistant", "And?")]
    assert "".join(p.audit for p in sorted(parts, key=lambda p: p.part)) == "DKDR" and sum(p.cost for p in parts) == 5


def test_empty_table(spark):
    parts = conversations.repair(spark.createDataFrame([], SCHEMA))
    assert parts.isEmpty() and conversations.summary(parts).isEmpty()


def test_registered_query(spark, tmp_path):
    """The damage, conversations that lose all rows, and nulls, against brute force."""
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    given += [(None, None, None, None), (None, 3, "user", "a."), (10**6, None, "system", "x."), (10**6 + 1, 1, "user", None)]
    given += [(10**7 + k, 0, "user", "Only.") for k in range(60)]  # some of which are dropped
    spark.createDataFrame(given, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {c: [] for c, *_ in given}
    for conv_id, turn, role, text in given:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want[conv_id] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got == {c: summed(rows) for c, rows in want.items()}
    assert any(not rows for rows in want.values())
