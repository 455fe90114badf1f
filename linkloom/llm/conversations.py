"""Repair of conversation structure by generalised LR parsing with edits.

The roles of a repaired conversation, by their first characters, must form a sentence of :data:`GRAMMAR`, that is
``(s?(ua)+)?``. The parser keeps all stacks of LR states that some edits of the rows read so far lead to. A stack is a node
(state, node below), and equal nodes are one object, so the stacks form a graph with shared lower parts. Rows may be kept,
re-roled or deleted, and user or assistant turns without text inserted; stacks that become equal are merged by the
smallest (cost, audit). That loses nothing: two audits that end with the same row are never prefixes of each
other, so what follows cannot change their order.

The parser's memory is one entry per live stack: its cost above the cheapest, its place in the order of audits, the
running hash of its repaired text and its audit so far, which shares its past with the others. So a conversation streams through
its task in the order of its turns, and no text is held, however long the conversation. Spark shuffles each row once, by
conversation, and sorts it twice (copies of a row, then turns), which spills. One conversation stays in one task, because its
digest is a hash over its whole repaired text in order.

Defined cases: a null role or text is one space, a null conversation id is a conversation of its own. Rows with equal turns
are ordered by role and text, rows without a turn come first. Equal rows of one conversation are repeats: all but the
first are duplicates. A role is judged by its first character; an empty one fits nowhere. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Role grammar: start symbol first. ``s``, ``u`` and ``a`` are the initials of system, user and assistant.
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("exchanges",)),
    ("exchanges", ("u", "a")),
    ("exchanges", ("s", "u", "a")),
    ("exchanges", ("exchanges", "u", "a")),
)
#: Roles that an edit can give, by initial.
GIVEN = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: Added when a truncated row stays.
TRUNCATED_COST = 3
#: A stack that is dearer than the cheapest by more cannot win: whatever row follows, the cheapest can go the same way after
#: two insertions (to the end of an exchange) and one deletion (of a system row that only an empty stack takes).
SLACK = 2 * COST[INSERT] + COST[DELETE]
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\v\f\r"

Item = tuple[int, int]  # rule and place of the dot
Stack = tuple  # (state, stack below); () at the bottom
Tops = tuple[tuple[Stack, int], ...]  # stack and cost above the cheapest, in the order of audits


class LRTable:
    """LR(0) automaton of a grammar. Both ways are followed where a state can shift and reduce."""

    def __init__(self, grammar: tuple[tuple[str, tuple[str, ...]], ...]):
        self.grammar, self.start = grammar, grammar[0][0]
        self.rules = {name: [i for i, (n, _) in enumerate(grammar) if n == name] for name, _ in grammar}
        self.states: list[frozenset[Item]] = [self._closed({(i, 0) for i in self.rules[self.start]})]
        self.goto: list[dict[str, int]] = []
        while len(self.goto) < len(self.states):
            moves: dict[str, set[Item]] = {}
            for rule, dot in self.states[len(self.goto)]:
                body = grammar[rule][1]
                if dot < len(body):
                    moves.setdefault(body[dot], set()).add((rule, dot + 1))
            row = {}
            for symbol, items in sorted(moves.items()):
                target = self._closed(items)
                if target not in self.states:
                    self.states.append(target)
                row[symbol] = self.states.index(target)
            self.goto.append(row)
        done = [[rule for rule, dot in s if dot == len(grammar[rule][1])] for s in self.states]
        self.reduces = [[grammar[r] for r in rules if grammar[r][0] != self.start] for rules in done]
        self.accepts = [any(grammar[r][0] == self.start for r in rules) for rules in done]
        self.bottom: Stack = (0, ())
        self._nodes: dict[Stack, Stack] = {self.bottom: self.bottom}
        self._steps: dict[tuple[Stack, str], tuple[Stack, ...]] = {}

    def _closed(self, items: set[Item]) -> frozenset[Item]:
        open_items, found = list(items), set(items)
        while open_items:
            rule, dot = open_items.pop()
            body = self.grammar[rule][1]
            for other in self.rules.get(body[dot], ()) if dot < len(body) else ():
                if (other, 0) not in found:
                    found.add((other, 0))
                    open_items.append((other, 0))
        return frozenset(found)

    def _push(self, stack: Stack, symbol: str) -> Stack | None:
        state = self.goto[stack[0]].get(symbol)
        return None if state is None else self._nodes.setdefault((state, stack), (state, stack))

    def step(self, stack: Stack, symbol: str) -> tuple[Stack, ...]:
        """Stacks after shifting a symbol and every chain of reductions that may follow."""
        key = (stack, symbol)
        if key not in self._steps:
            top = self._push(stack, symbol)
            found = [] if top is None else [top]
            for node in found:
                for name, body in self.reduces[node[0]]:
                    below = node
                    for _ in body:
                        below = below[1]
                    found.append(self._push(below, name))
            # A state that can only reduce is no place to wait for the next symbol.
            self._steps[key] = tuple(n for n in found if self.goto[n[0]] or not self.reduces[n[0]])
        return self._steps[key]


TABLE = LRTable(GRAMMAR)


@dataclass(frozen=True)
class Move:
    """How a stack came about: from which of the stacks before, by which edits, with which roles inserted, and the role given
    to the row (None: its own, or deleted)."""

    parent: int
    edits: str
    inserted: tuple[str, ...] = ()
    given: str | None = None


@cache
def _inserted(stack: Stack) -> tuple[tuple[Stack, tuple[str, ...]], ...]:
    """Stacks that insertions lead to, with the roles inserted; fewest first, the stack itself included."""
    found = {stack: ()}
    for now in (waiting := [stack]):
        for symbol, role in GIVEN.items():
            for after in TABLE.step(now, symbol):
                if after not in found:
                    found[after] = (*found[now], role)
                    waiting.append(after)
    return tuple(found.items())


@lru_cache(maxsize=1 << 16)
def advance(tops: Tops, initial: str, fault: str) -> tuple[Tops, tuple[Move, ...], int]:
    """The stacks after one more row, how each came about, and the cost that all have in common."""
    best: dict[Stack, tuple[int, int, str, Move]] = {}

    def offer(stack: Stack, cost: int, move: Move) -> None:
        way = (cost, move.parent, move.edits, move)
        if stack not in best or way[:3] < best[stack][:3]:
            best[stack] = way

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for i, (top, spent) in enumerate(tops):
        # An insertion before a deletion is never least: it can come after it.
        offer(top, spent + COST[DELETE], Move(i, DELETE))
        for stack, roles in _inserted(top) if fault not in (BLANK, DUPLICATE) else ():
            cost, edits = spent + COST[INSERT] * len(roles) + extra, INSERT * len(roles)
            for after in TABLE.step(stack, initial):
                offer(after, cost + COST[KEEP], Move(i, edits + KEEP, roles))
            for symbol, role in GIVEN.items():
                for after in TABLE.step(stack, symbol):
                    offer(after, cost + COST[REROLE], Move(i, edits + REROLE, roles, role))
    least = min(way[0] for way in best.values())
    live = sorted((way[1], way[2], stack, way[0] - least, way[3]) for stack, way in best.items() if way[0] - least <= SLACK)
    return tuple((x[2], x[3]) for x in live), tuple(x[4] for x in live), least


Past = tuple  # (past before, edits); () at the start


class Repair:
    """The repair of one conversation whose rows arrive in order."""

    def __init__(self) -> None:
        self.tops: Tops = ((TABLE.bottom, 0),)
        self.cost = 0
        self.audit = ""
        self._pasts: list[Past] = [()]
        self._hashes: list = [None]  # None: nothing repaired yet

    def add(self, role: str, text: str, fault: str) -> None:
        self.tops, moves, cost = advance(self.tops, role[:1], fault)
        self.cost += cost
        self._pasts = [(self._pasts[m.parent], m.edits) for m in moves]
        own = text.encode()
        self._hashes = [self._hashed(m, None if m.edits == DELETE else (m.given or role).encode() + b":" + own) for m in moves]

    def finish(self) -> str:
        """Ends the conversation and returns the hash of the repaired text; ``cost`` and ``audit`` are final then."""
        ends = [
            (cost + COST[INSERT] * len(roles), i, INSERT * len(roles), roles)
            for i, (top, cost) in enumerate(self.tops)
            for stack, roles in _inserted(top)
            if TABLE.accepts[stack[0]]
        ]
        cost, i, edits, roles = min(ends)
        self.cost += cost
        past, parts = self._pasts[i], [edits]
        while past:
            past, edits = past
            parts.append(edits)
        self.audit = "".join(reversed(parts))
        digest = self._hashed(Move(i, "", roles), None)
        return (digest or hashlib.sha256()).hexdigest()

    def _hashed(self, move: Move, own: bytes | None):
        digest = self._hashes[move.parent]
        for turn in (*(f"{role}:".encode() for role in move.inserted), *((own,) if own is not None else ())):
            digest = digest.copy() if digest else None
            if digest is None:
                digest = hashlib.sha256(turn)
            else:
                digest.update(b"\n")
                digest.update(turn)
        return digest


def applied(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns: (role, text) rows with the edits of an audit."""
    rows, stack = iter(rows), TABLE.bottom
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit != KEEP:
            # The grammar leaves one choice at any place.
            role = next(GIVEN[s] for s in GIVEN if TABLE.step(stack, s))
        (stack,) = TABLE.step(stack, role[:1])
        yield role, text


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with one in five rows damaged, by a checksum of id and turn: dropped (``dropped``, kept as a row so that
    no conversation is lost), emptied, without sentence ends, repeated, or given to the user. Nulls become one space."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20).alias("_hit"),
    )
    hit, text = F.col("_hit"), F.col("text")
    return rows.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (hit == 0).alias("dropped"),
        F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def _fault(text: Column, repeat: Column) -> Column:
    solid = F.rtrim(text, F.lit(SPACE))
    return (
        F.when(solid == "", BLANK)
        .when(repeat > 1, DUPLICATE)
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise("")
    )


def judged_rows(conversations: DataFrame) -> DataFrame:
    """Rows with their ``fault``, each conversation in one partition and in order. ``dropped`` rows, if the input has that
    column, take no part beyond naming their conversation."""
    gone = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(~gone, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(~gone, F.coalesce("text", F.lit(" "))).alias("text"),
    ).repartition("conv_id")
    # The partitioning by conversation serves this window too.
    copies = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    judged = rows.withColumn("fault", _fault(F.col("text"), copies))
    return judged.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
_COLUMNS = [c.split()[0] for c in REPORT.split(", ")]
_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
ROWS_AT_ONCE, BYTES_AT_ONCE = 1024, 1 << 20


def _conversations(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """The conversations of a sorted partition and their rows, as a stream."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *columns))))
    return groupby(rows, key=lambda row: row[0])


def _reported(conv_id: int | None, rows: Iterator[tuple]) -> tuple:
    repair, faults = Repair(), {"": 0, BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
    first = last = before = None
    turns = illegal = 0
    for _, turn, role, text, fault in rows:
        if role is None:
            continue
        faults[fault] += 1
        if turn is not None and turn != last:
            first = turn if first is None else first
            last, turns = turn, turns + 1
        illegal += before is not None and before + role[:1] not in LEGAL
        before = role[:1]
        repair.add(role, text, fault)
    digest = repair.finish()
    gaps = 0 if first is None else last - first + 1 - turns
    return conv_id, gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, repair.cost, repair.audit, digest


def _batches(rows: Iterable[tuple], sizes: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches; ``sizes`` is the place of the column that may be large."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sizes])
        if len(held) >= ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id``: gaps between turns, faults, illegal neighbours, the cost of the cheapest repair, its edits
    (``audit``: Keep, Rerole, Delete, Insert by initial) and the SHA-256 of the repaired conversation. A conversation whose rows
    are all dropped has zeros, no edits and the hash of nothing."""
    text_columns = ("audit", "repaired_sha256")
    schema = pa.schema([(c, pa.string() if c in text_columns else pa.int64()) for c in _COLUMNS])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_reported(conv, rows) for conv, rows in _conversations(batches, "turn", "role", "text", "fault"))
        yield from _batches(found, _COLUMNS.index("audit"), schema)

    return judged_rows(conversations).mapInArrow(report, REPORT)


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, position`` (from 0), ``role, text``. The edits are known after one pass over a
    conversation and applied in a second one, so both stream."""
    audits = repair_report(conversations).select(F.col("conv_id").alias("_conv"), "audit")
    rows = judged_rows(conversations).where("role is not null")
    rows = rows.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv")), "right")
    rows = rows.select(F.col("_conv").alias("conv_id"), "turn", "role", "text", "audit")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, group in _conversations(batches, "role", "text", "audit"):
                _, role, text, audit = next(group)
                given = chain([(role, text)], ((r[1], r[2]) for r in group))
                for i, turn in enumerate(applied(given, audit)):
                    yield conv, i, *turn

        yield from _batches(found(), 3, _TURNS)

    return rows.mapInArrow(turns, "conv_id long, position long, role string, text string")
