"""Conversation repair against plain search."""

from __future__ import annotations

import heapq
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

from pyspark.sql import functions as F

from billmodel.llm import conversation_repair, registry
from billmodel.llm.conversation_repair import Costs, Moves, Parse, Tables, repair_conversations

ROLE = {"u": "user", "a": "assistant"}
LEGAL = re.compile("(s?(ua)+)?")
#: The role grammar as states: (state, initial) -> state; 0 and 3 accept.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def fault_of(role: str, text: str, seen: set) -> str:
    bare = re.sub(r"[\x20\x09-\x0D]", "", text)
    again = (role, text) in seen
    seen.add((role, text))
    return "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else ""


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, str]:
    """(cost, letters, text) by states, row after row."""

    def inserted(states: dict) -> dict:
        todo = list(states)
        while todo:
            state = todo.pop()
            cost, letters, lines = states[state]
            for r in "ua":
                to, value = NEXT.get((state, r)), (cost + 3, letters + "I", (*lines, ROLE[r] + ":"))
                if to is not None and (to not in states or value < states[to]):
                    states[to] = value
                    todo.append(to)
        return states

    states = {0: (0, "", ())}
    for role, text, fault in rows:
        out: dict = {}
        for state, (cost, letters, lines) in inserted(states).items():
            offers = [(state, (cost + 4, letters + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                offers.append((NEXT.get((state, role[:1])), (cost + more, letters + "K", (*lines, f"{role}:{text}"))))
                offers += [(NEXT.get((state, r)), (cost + 3 + more, letters + "R", (*lines, f"{ROLE[r]}:{text}"))) for r in "ua"]
            for to, value in offers:
                if to is not None and (to not in out or value < out[to]):
                    out[to] = value
        states = out
    cost, letters, lines = min(v for s, v in inserted(states).items() if s in (0, 3))
    return cost, letters, "\n".join(lines)


def searched(rows: list[tuple[str, str, str]]) -> tuple[int, str, str]:
    """The same by trying edit lists in the order of cost and letters; nothing merged."""
    heap = [(0, "", 0, "", ())]
    while True:
        cost, letters, at, initials, lines = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(initials):
            return cost, letters, "\n".join(lines)
        for r in "ua":
            heapq.heappush(heap, (cost + 3, letters + "I", at, initials + r, (*lines, ROLE[r] + ":")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, letters + "D", at + 1, initials, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + more, letters + "K", at + 1, initials + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for r in "ua":
                    heapq.heappush(heap, (cost + 3 + more, letters + "R", at + 1, initials + r, (*lines, f"{ROLE[r]}:{text}")))


def expected(rows: list[tuple]) -> Counter:
    """(conv, turn, role, text, present) rows -> the operator's result."""
    by_conv = defaultdict(list)
    for conv, turn, role, text, present in rows:
        by_conv[conv].append((turn is not None, turn or 0, role, text, turn) if present else None)
    out = Counter()
    for conv, some in by_conv.items():
        some = sorted(x for x in some if x)
        turns = {x[4] for x in some} - {None}
        seen, cut = set(), []
        for _, _, role, text, _ in some:
            cut.append((role, text, fault_of(role, text, seen)))
        faults = Counter(f for _, _, f in cut)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(cut, cut[1:]))
        cost, letters, text = cheapest(cut)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, sha256(text.encode()).hexdigest()] += 1
    return out


def damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text, kind != 0)] * (2 if kind == 3 else 1)
    return out


def plain(df) -> Counter:
    return Counter(map(tuple, df.drop("repaired").collect()))


def test_op13_equals_the_definition(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert plain(registry.op13_conversation_repair(spark, f"/root/testdata/{sf}")) == expected(damage(rows))


def test_every_short_conversation_is_repaired_at_least_cost():
    r, moves = random.Random(3), Moves(Tables(conversation_repair.GRAMMAR), Costs())
    for _ in range(400):
        rows = [(r.choice(["system", "user", "assistant", "tool", ""]), f"t{n}", r.choice(["", "", "", "truncated", "blank"])) for n in range(r.randrange(6))]
        parse = Parse(moves, True)
        for role, text, fault in rows:
            parse.add(role, text, fault == "blank", fault == "truncated")
        cost, letters, digest, text = parse.result()
        # a tool's initial is no role of the grammar
        assert (cost, letters, text) == searched(rows) == cheapest(rows)
        assert digest == sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    r = random.Random(8)
    pick = lambda *x: r.choice(x)
    rows = [(pick(None, 1, 2, 3, -4, 5), pick(None, 0, 1, 2, 3, 9), pick(None, "system", "user", "assistant", "", "Émile"),
             pick(None, "", "Hi.", "Hi", " ", " \t\n", "é!\n", "long. " * 30_000)) for _ in range(150)]
    rows += [(77, t, "user", "x.") for t in range(4)] + rows[:20]
    frame = spark.createDataFrame([(*x, "z", 1, True) for x in rows],
                                  "conv_id long, turn long, role string, text string, fault string, copy int, present boolean")
    got = plain(repair_conversations(frame))
    assert got == expected([(c, t, " " if x is None else x, " " if y is None else y, True) for c, t, x, y in rows])
    whole = registry.damaged(frame.drop("present", "copy"))
    assert plain(repair_conversations(whole, present=F.col("present"))) == expected(damage(rows))


def test_dropped_conversation_empty_table_and_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Oh"), (2, 0, "user", "x")], schema)
    got = {r.conv_id: r for r in repair_conversations(frame, present=F.col("conv_id") == 1, with_text=True).collect()}
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest(), "")
    assert got[1].repaired == "user:Hi.\nassistant:Oh" and got[1].audit == "KR" and got[1].cost == 6
    assert repair_conversations(spark.createDataFrame([], schema)).count() == 0


def test_a_conversation_of_any_length(spark):
    """One conversation of all rows, whose two best ways never meet."""
    n = 30_000
    frame = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "concat('t', id, '.') AS text")
    (got,) = repair_conversations(frame).collect()
    assert tuple(got)[:9] == next(iter(expected([(1, i, "user", f"t{i}.", True) for i in range(n)])))
