from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from accountloom.llm import turns
from accountloom.llm.queries import op11_conversation_repair
from tests.llm.support import SF

ROWS = "conv_id long, turn long, role string, text string"
WORD = re.compile("[^\x20\x09-\x0d]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [row] * {0: 0, 3: 2}.get(kind, 1)
    return out


def in_order(rows):
    """By turn, nulls first; of one turn by role, then by digest."""

    def key(row):
        conv, turn, role, text = row
        name = f"{'' if conv is None else conv}:{len(role.encode())}:{role}{text}".encode()
        return (turn is not None, turn or 0, role.encode(), hashlib.sha256(name).digest())

    return sorted(rows, key=key)


def plain(conv, rows):
    """The row of the query for one conversation, trying every edit at every row."""
    rows = in_order([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    seen, faults = set(), []
    for _, _, role, text in rows:
        found = WORD.findall(text)
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def add(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def inserted(now):
        for _ in range(4):
            for state, (cost, audit, lines) in list(now.items()):
                for role in ("user", "assistant"):
                    if role[0] in follows[state]:
                        add(now, role[0], (cost + 2, audit + "I", (*lines, f"{role}:")))
        return now

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            add(after, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            if role[:1] and role[0] in follows[state]:
                add(after, role[0], (more, audit + "K", (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if new[0] in follows[state]:
                    add(after, new[0], (more + 2, audit + "R", (*lines, f"{new}:{text}")))
        best = after
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in ("", "a"))
    numbers = [t for _, t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, names):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return sorted((plain(c, groups[c]) for c in names), key=str)


def conversation(rng, conv, size):
    text = lambda: rng.choice(["", " \t", "Yes.", "no", "What?", "é!", "so on ", "a. b", None])
    role = lambda: rng.choice(["user", "assistant"] * 5 + ["system", "tool", "", "User", "admin", None])
    turn = lambda i: rng.choice([i, i, i, i + 1, 3 * i, None])
    return [(conv, turn(i), role(), text()) for i in range(size)]


def conversations(seed, count=60, most=14):
    rng = random.Random(seed)
    return [row for c in range(count) for row in conversation(rng, c, rng.randint(1, most))]


def answer(repairs):
    return sorted((tuple(r) for r in turns.audited(repairs).collect()), key=str)


@pytest.mark.parametrize("block_rows", [1, 2, 5, 1000])
def test_against_brute_force_however_cut(spark, block_rows):
    rows = conversations(block_rows)
    df = spark.createDataFrame(rows, ROWS)
    assert answer(turns.Repairs(df, block_rows=block_rows)) == expected(rows, {r[0] for r in rows})


def test_damage_and_whole_conversations_lost(spark):
    rows = conversations(9, 150, 3) + [(None, 1, "user", "a."), (None, None, "assistant", "b"), (None, 1, "user", "a.")]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS at", "1 AS codes", "2 AS digest", "3 AS n", "4 AS code")
    left = damage(rows)
    assert {r[0] for r in left} < {r[0] for r in rows}
    assert answer(turns.Repairs(turns.damaged(df), df)) == expected(left, {r[0] for r in rows})


def test_one_long_conversation_spread_over_blocks(spark):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(40)}.") for i in range(3000)]
    rows += [(1, 70, "user", "same.")] * 200 + [(2, 1, "user", "Hi.")]
    repairs = turns.Repairs(spark.createDataFrame(rows, ROWS).repartition(16))
    assert answer(repairs) == expected(rows, {1, 2})
    sizes = [len(r.codes) for r in repairs._blocks.collect()]
    assert max(sizes) <= 64 and sum(sizes) == len(rows)


def test_turns_are_those_of_the_digest(spark):
    rows = [(1, 0, "assistant", "Hm."), (1, 1, "assistant", "So"), (1, 2, "user", " "), (3, 1, "system", "s.")]
    found = turns.Repairs(spark.createDataFrame(rows, ROWS))
    lines = sorted((r.conv_id, r.block, r.place, r.role, r.text) for r in found.turns().collect())
    assert [(c, role, text) for c, _, _, role, text in lines] == [(1, "user", "Hm."), (1, "assistant", "So")]
    assert {r.conv_id: (r.audit, r.cost) for r in found.audits().collect()} == {1: ("RKD", 6), 3: ("D", 3)}


def test_ids_of_another_type_and_a_very_long_text(spark):
    rows = [("a", 1, "user", "x" * 3_000_000 + "."), ("a", 2, "assistant", "y."), (None, 1, "user", "z.")]
    df = spark.createDataFrame(rows, ROWS.replace("conv_id long", "conv_id string"))
    assert answer(turns.Repairs(df)) == expected(rows, {"a", None})


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert answer(turns.Repairs(empty)) == []
    repairs = turns.Repairs(empty, spark.createDataFrame([(4,)], "conv_id long"))
    assert answer(repairs) == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_whole_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in op11_conversation_repair(spark, SF).collect()), key=str)
    assert found == expected(damage(rows), {r[0] for r in rows}) and sum(r[6] for r in found) > 0
