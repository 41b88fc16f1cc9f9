"""Repair of conversations: the cheapest edits after which the roles follow a
grammar.

Rows of a conversation stand by turn (nulls first; rows of one turn by role and
text, so that copies are neighbours). A row's first fault counts: ``blank`` (no
character but white space), ``duplicate`` (role and text as in an earlier row),
``truncated`` (the last character that is no white space does not end a
sentence). Edits are Keep (0), Rerole to user or assistant, Delete (the only one
for blank and duplicate rows) and Insert of an empty turn anywhere; a truncated
row that stays costs extra. Of the cheapest edit lists the one whose letters
(K, R, D, I in order) come first counts.

The search is a generalised LR parse of the rows. The tables are built from the
role grammar. A stack is a chain of table states with a shared tail, so all
stacks together are a graph; a row extends every stack by every edit it allows
(a reduction is free), and stacks with equal tops and tails become one, that of
least (cost, letters). What a row of some kind does to a stack is worked out once
and kept. Merging is exact: of two lists of one cost for the same rows neither
begins with the other (the rest would be inserts, which cost), so what follows
cannot change their order.

Conversations are dealt by id, sorted inside their partitions and read as a
stream. A conversation of any length needs a few stacks and one letter a row:
every stack carries the running digest of its repaired text, so texts are not
held (``with_text`` holds them). The digest of one conversation is one sequence
of bytes and cannot be divided between tasks.

Nulls: a null role or text is one space (a role that is none, a blank text), a
null id one more conversation, a null turn stands first. Repeated rows are
duplicates. Other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from billmodel.llm.common import BLANK, arrow_rows, partitions, ship_package

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, repaired string")
#: Roles by the letter that the grammar knows them by.
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Roles that may be given to a row or inserted.
FREE = ("u", "a")
#: ``(s?(ua)+)?`` with rules that forget, after every turn pair, how it began.
GRAMMAR = (("C", ""), ("C", "B"), ("B", "ua"), ("B", "sua"), ("B", "Bua"))
#: Neighbours that are legal.
LEGAL = ("su", "ua", "au")
#: Letters of a stack's edit list that are held in one string.
HELD = 4096
#: More different stacks than this come from a grammar that is not left-linear.
MOST_STACKS = 10_000
ROWS = 1000


@dataclass(frozen=True)
class Costs:
    delete: int = 4
    rerole: int = 3
    insert: int = 3
    truncated: int = 3


# --- tables -----------------------------------------------------------------------


class Tables:
    """LR(0) states of a grammar whose first rule's left side is the start."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]):
        self.start = grammar[0][0]
        heads = {left for left, _ in grammar}

        def closed(items: set[tuple[str, str, int]]) -> frozenset:
            todo = list(items)
            while todo:
                _, right, dot = todo.pop()
                if dot < len(right) and right[dot] in heads:
                    new = {(a, b, 0) for a, b in grammar if a == right[dot]} - items
                    items |= new
                    todo += new
            return frozenset(items)

        states = [closed({(a, b, 0) for a, b in grammar if a == self.start})]
        self.go: list[dict[str, int]] = []
        for items in states:  # grows as it is walked
            moves = {}
            for symbol in sorted({b[d] for _, b, d in items if d < len(b)}):
                target = closed({(a, b, d + 1) for a, b, d in items if d < len(b) and b[d] == symbol})
                if target not in states:
                    states.append(target)
                moves[symbol] = states.index(target)
            self.go.append(moves)
        #: Rules that end in a state, and whether the start does.
        self.ends = [[(a, len(b)) for a, b, d in sorted(items) if d == len(b) and a != self.start] for items in states]
        self.accepts = [any(a == self.start and d == len(b) for a, b, d in items) for items in states]

    def reduced(self, stack: tuple) -> list[tuple]:
        """The stack and all that reductions make of it, without those that
        neither shift nor accept."""
        out, todo = [], [stack]
        while todo:
            at = todo.pop()
            if at in out:
                continue
            out.append(at)
            for left, size in self.ends[at[0]]:
                below = at
                for _ in range(size):
                    below = below[1]
                if left in self.go[below[0]]:
                    todo.append((self.go[below[0]][left], below))
        return [s for s in out if self.go[s[0]] or self.accepts[s[0]]]

    def shifted(self, stack: tuple, symbol: str) -> list[tuple]:
        to = self.go[stack[0]].get(symbol)
        return [] if to is None else self.reduced((to, stack))


class Moves:
    """What a row does to one stack: the least (cost, letters, roles) for each
    stack that follows. ``roles`` are those written, ``None`` for the row's own
    text under its own role, a pair for its text under another."""

    def __init__(self, tables: Tables, costs: Costs):
        self.tables, self.costs = tables, costs
        self.rows: dict[tuple, list] = {}
        self.ends: dict[tuple, tuple | None] = {}

    def inserted(self, stack: tuple) -> dict[tuple, tuple]:
        """Stacks that inserts lead to, fewest first."""
        out = {stack: (0, "", ())}
        todo = [stack]
        for at in todo:  # grows as it is walked
            cost, letters, roles = out[at]
            for role in FREE:
                for s in self.tables.shifted(at, role):
                    if s not in out:
                        out[s] = (cost + self.costs.insert, letters + "I", (*roles, role))
                        todo.append(s)
            if len(out) > MOST_STACKS:
                raise ValueError("the role grammar must be left-linear")
        return out

    def row(self, stack: tuple, letter: str, must_go: bool, cut: bool) -> list[tuple]:
        key = stack, letter, must_go, cut
        if (known := self.rows.get(key)) is not None:
            return known
        best: dict[tuple, tuple] = {}

        def offer(s: tuple, value: tuple) -> None:
            if s not in best or value < best[s]:
                best[s] = value

        extra = self.costs.truncated if cut else 0
        for s, (cost, letters, roles) in self.inserted(stack).items():
            offer(s, (cost + self.costs.delete, letters + "D", roles))
            if must_go:
                continue
            for t in self.tables.shifted(s, letter):
                offer(t, (cost + extra, letters + "K", (*roles, "=")))
            for role in FREE:
                for t in self.tables.shifted(s, role):
                    offer(t, (cost + self.costs.rerole + extra, letters + "R", (*roles, "=" + role)))
        self.rows[key] = out = [(s, *value) for s, value in best.items()]
        return out

    def end(self, stack: tuple) -> tuple | None:
        """The least inserts after which the stack accepts."""
        if stack not in self.ends:
            done = [v for s, v in self.inserted(stack).items() if self.tables.accepts[s[0]]]
            self.ends[stack] = min(done, default=None)
        return self.ends[stack]


# --- parsing ----------------------------------------------------------------------


class Head:
    """A stack's way so far: its cost, its letters (those of ``past``, then
    ``tail``), the digest of what it wrote. ``rank`` is the order of the pasts,
    which are of one length; heads of one rank have one past."""

    __slots__ = ("cost", "rank", "past", "tail", "digest", "wrote", "text")

    def __init__(self, cost: int, rank: int, past: tuple | None, tail: str, digest, wrote: bool, text: tuple | None):
        self.cost, self.rank, self.past, self.tail = cost, rank, past, tail
        self.digest, self.wrote, self.text = digest, wrote, text


class Parse:
    """The parse of one conversation, row by row."""

    def __init__(self, moves: Moves, with_text: bool):
        self.moves, self.with_text = moves, with_text
        self.heads = {s: Head(0, 0, None, "", sha256(), False, None) for s in moves.tables.reduced((0, None))}

    def follow(self, best: dict[tuple, tuple], role: str, text: str) -> dict[tuple, Head]:
        """New heads from (cost, rank, letters, roles, old head)."""
        out = {}
        for stack, (cost, rank, tail, roles, old) in best.items():
            digest, wrote, kept = old.digest, old.wrote, old.text
            if roles:
                parts = []
                for r in roles:
                    if r[0] == "=":
                        parts.append(f"{ROLES[r[1]] if len(r) > 1 else role}:{text}")
                    else:
                        parts.append(f"{ROLES[r]}:")
                line = ("\n" if wrote else "") + "\n".join(parts)
                digest, wrote = digest.copy(), True
                digest.update(line.encode("utf-8", "surrogatepass"))
                if self.with_text:
                    kept = (line, kept)
            out[stack] = Head(cost, rank, old.past, tail, digest, wrote, kept)
        return out

    def add(self, role: str, text: str, must_go: bool, cut: bool) -> None:
        best: dict[tuple, tuple] = {}
        letter, row = role[:1], self.moves.row
        for stack, h in self.heads.items():
            for to, cost, letters, roles in row(stack, letter if letter in ROLES else "", must_go, cut):
                value = h.cost + cost, h.rank, h.tail + letters, roles, h
                if (have := best.get(to)) is None or value[:4] < have[:4]:
                    best[to] = value
        self.heads = self.follow(best, role, text)
        if len(next(iter(self.heads.values())).tail) > HELD:
            self.cut()

    def cut(self) -> None:
        """Moves letters, as many of every head, to the pasts and ranks them."""
        size = min(len(h.tail) for h in self.heads.values())
        order = sorted(self.heads.values(), key=lambda h: (h.rank, h.tail[:size]))
        last, rank, past = None, -1, None
        for h in order:
            front = h.rank, h.tail[:size]
            if front != last:
                last, rank, past = front, rank + 1, (front[1], h.past)
            h.rank, h.past, h.tail = rank, past, h.tail[size:]

    def result(self) -> tuple[int, str, str, str | None]:
        """(cost, letters, digest, text)"""
        best: dict[tuple, tuple] = {}
        for stack, h in self.heads.items():
            if (end := self.moves.end(stack)) is not None:
                value = h.cost + end[0], h.rank, h.tail + end[1], end[2], h
                if (have := best.get(())) is None or value[:4] < have[:4]:
                    best[()] = value
        h = self.follow(best, "", "")[()]
        return h.cost, "".join(chain_of(h.past) + [h.tail]), h.digest.hexdigest(), "".join(chain_of(h.text)) if self.with_text else None


def chain_of(cell: tuple | None) -> list[str]:
    out = []
    while cell is not None:
        out.append(cell[0])
        cell = cell[1]
    return out[::-1]


class Conversation:
    """Counts and parse of the conversation that is being read."""

    def __init__(self, conv_id: int | None, moves: Moves, with_text: bool):
        self.conv_id, self.parse = conv_id, Parse(moves, with_text)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        if fault:
            self.faults[fault] += 1
        self.parse.add(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        cost, letters, digest, text = self.parse.result()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, cost, letters, digest, text)


def _repair(grammar: tuple[tuple[str, str], ...], costs: Costs, with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = Moves(Tables(grammar), costs)
        now: Conversation | None = None
        out = []
        for batch in batches:
            for conv_id, turn, role, text, fault, present in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.row())
                    now = Conversation(conv_id, moves, with_text)
                if present:
                    now.add(turn, role, text, fault)
            if len(out) >= ROWS:
                yield from arrow_rows(RESULT, out).to_batches()
                out = []
        if now is not None:
            out.append(now.row())
        yield from arrow_rows(RESULT, out).to_batches()

    return run


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         present: Column | None = None, grammar: tuple[tuple[str, str], ...] = GRAMMAR, costs: Costs = Costs(),
                         with_text: bool = False) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, repaired) for every conversation. ``gaps`` are the turns
    missing between the first and the last, ``illegal`` the neighbours that don't
    belong together, ``audit`` the edits' letters; ``repaired`` (null unless
    ``with_text``) is the text of ``role:text`` lines. Rows that are not ``present``
    only name their conversation."""
    spark = rows.sparkSession
    ship_package(spark)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    turns = rows.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"), there.alias("present"))
    turns = turns.select("conv_id", "turn", F.when(F.col("present"), F.col("role")).otherwise("").alias("role"),
                         F.when(F.col("present"), F.col("text")).otherwise("").alias("text"), "present")
    # one exchange: the window and the stream both work on the conversations' partitions
    dealt = turns.repartition(partitions(spark), "conv_id")
    copy = F.row_number().over(W.partitionBy("conv_id", "present", "role", "text").orderBy("turn"))
    bare = F.regexp_extract("text", rf"([^{BLANK}])[{BLANK}]*\z", 1)
    fault = (F.when(bare == "", "blank").when(F.col("copy") > 1, "duplicate").when(~bare.isin(".", "!", "?"), "truncated").otherwise(""))
    marked = dealt.withColumn("copy", copy).select("conv_id", "turn", "role", "text", fault.alias("fault"), "present")
    ordered = marked.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_repair(grammar, costs, with_text), RESULT)
