"""Conversation repair against a shortest-path search, and the whole query against plain Python."""

import hashlib
import heapq
import itertools
import random
import re
import time
import zlib

import duckdb

from linkloom.llm import conversations as C
from linkloom.llm.queries import op12_conversation_repair

SMALL = "/root/testdata/sf0.001"
#: Role sequences so far, up to what decides how they may go on.
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "ua"}, "ua": {"u": "u"}}
ENDS = {"", "ua"}


def plain_repair(rows):
    """Cheapest edits of (role, text, fault) rows, ties ASCII-least: Dijkstra over (rows used, roles so far)."""
    heap, done, seen = [(0, "", 0, "", ())], None, set()
    while heap:
        cost, audit, used, state, turns = heapq.heappop(heap)
        if (used, state) in seen:
            continue
        seen.add((used, state))
        if used == len(rows) and state in ENDS:
            done = cost, audit, "\n".join(f"{r}:{t}" for r, t in turns)
            break
        for initial, role in (("u", "user"), ("a", "assistant")):
            if initial in NEXT[state]:
                heapq.heappush(heap, (cost + 3, audit + "I", used, NEXT[state][initial], (*turns, (role, ""))))
        if used < len(rows):
            role, text, fault = rows[used]
            heapq.heappush(heap, (cost + 4, audit + "D", used + 1, state, turns))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] in NEXT[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", used + 1, NEXT[state][role[:1]], (*turns, (role, text))))
                for initial, given in (("u", "user"), ("a", "assistant")):
                    if initial in NEXT[state]:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", used + 1, NEXT[state][initial], (*turns, (given, text))))
    return done


def parsed(rows):
    repair = C.Repair()
    for row in rows:
        repair.add(*row)
    digest = repair.finish()
    text = "\n".join(f"{r}:{t}" for r, t in C.applied([r[:2] for r in rows], repair.audit))
    assert digest == hashlib.sha256(text.encode()).hexdigest()
    return repair.cost, repair.audit, text


def test_every_short_conversation():
    choices = [(role, "x", fault) for role in ("system", "user", "assistant", "tool") for fault in ("", "blank", "truncated")]
    for n in range(4):
        for rows in itertools.product(choices, repeat=n):
            assert parsed(rows) == plain_repair(rows)


def test_random_long_conversations():
    rng = random.Random(5)
    for _ in range(300):
        rows = [
            (rng.choice(["system", "user", "user", "assistant", "assistant", "", "éa"]), f"t{i}", rng.choice(["", "", "", "blank", "duplicate", "truncated"]))
            for i in range(rng.randrange(60))
        ]
        assert parsed(rows) == plain_repair(rows)


def test_few_live_stacks_and_linear_time():
    rng, repair = random.Random(1), C.Repair()
    roles = [rng.choice(["system", "user", "assistant"]) for _ in range(30_000)] + ["tool"] * 30_000 + ["user"] * 30_000
    faults = [rng.choice(["", "", "blank", "truncated"]) for _ in range(60_000)] + ["duplicate"] * 30_000
    started = time.time()
    for role, fault in zip(roles, faults):
        repair.add(role, "x", fault)
        assert len(repair.tops) <= 6
    repair.finish()
    assert len(repair.audit) >= 90_000 and C.advance.cache_info().currsize < 5000 and time.time() - started < 30


def test_table_has_the_role_grammar():
    for n in range(6):
        for roles in itertools.product("sua", repeat=n):
            stacks = {C.TABLE.bottom}
            for r in roles:
                stacks = {after for s in stacks for after in C.TABLE.step(s, r)}
            assert any(C.TABLE.accepts[s[0]] for s in stacks) == bool(re.fullmatch("(s?(ua)+)?", "".join(roles)))


def plain_report(conversations):
    """The whole contract over (conv_id, turn, role, text) rows in plain Python."""
    groups = {}
    for conv, turn, role, text in conversations:
        kept = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in rows:
            solid = text.rstrip(C.SPACE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, repaired = plain_repair(judged)
        turns = {t for t, _, _ in rows if t is not None}
        faults = [f for _, _, f in judged]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])),
            cost, audit, hashlib.sha256(repaired.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_plain_python(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall()
    assert rows_of(op12_conversation_repair(spark, SMALL)) == plain_report(rows)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, fault string, dropped boolean"
    rng = random.Random(3)
    rows = [
        (rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, 0, 1, 2, 5, -3]), rng.choice([None, "", "user", "assistant", "system", "x"]),
         rng.choice([None, "", " \t\n", "Hi.", "Hi", "é! \v", "a.b", "?"]), "clash", None)
        for _ in range(150)
    ]
    rows += rows[:20]
    rows.append((9, 0, "user", "Long. " * 200_000, "", None))
    df = spark.createDataFrame(rows, schema)
    assert rows_of(C.repair_report(C.damaged(df))) == plain_report([r[:4] for r in rows])
    empty = spark.createDataFrame([], schema)
    assert C.repair_report(C.damaged(empty)).count() == C.repaired_conversations(empty).count() == 0
    # Every row of conversation 9:… dropped: zeros and the hash of nothing.
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = C.repair_report(C.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.", "", None)], schema))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Go on."), (2, 0, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(map(tuple, C.repaired_conversations(df).collect()))
    assert found == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Go on."), (2, 0, "user", ""), (2, 1, "assistant", "Yes.")]


def test_one_shuffle(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    plan = C.repair_report(C.damaged(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
