"""Repairs against all edits of a conversation tried one after another."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product as choices

import pytest

from tidewake.llm import conversation_repair as cr

from .conftest import SF

EMPTY = hashlib.sha256(b"").hexdigest()


def brute_damage(rows):
    out = []
    said = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        fate, role, text = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20, said(role), said(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def best_edits(facts):
    """Shortest paths by plain relaxation over (row, state), audits kept whole."""
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {0: (0, "", ())}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found
            return True
        return False

    def insert(table):
        moved = True
        while moved:
            moved = False
            for state, (cost, audit, roles) in list(table.items()):
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (x, state) in step:
                        moved |= better(table, step[x, state], (cost + 5, audit + "I", (*roles, (name, None))))

    for i, (initial, must_go, truncated) in enumerate(facts):
        insert(best)
        after = {}
        for state, (cost, audit, roles) in best.items():
            better(after, state, (cost + 2, audit + "D", roles))
            if not must_go:
                more = cost + (5 if truncated else 0)
                if (initial, state) in step:
                    better(after, step[initial, state], (more, audit + "K", (*roles, (None, i))))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (x, state) in step:
                        better(after, step[x, state], (more + 1, audit + "R", (*roles, (name, i))))
        best = after
    insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows, convs):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = []
    for conv in convs:
        mine = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0))
        turns = {r[1] for r in mine if r[1] is not None}
        counts, facts, seen = [0, 0, 0], [], set()
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:], strict=False))
        cost, audit, roles = best_edits(facts)
        text = "\n".join(f"{name or mine[i][2]}:{mine[i][3] if i is not None else ''}" for name, i in roles)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", *cr.RESULT).collect()), key=repr)


def _conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "s", ""])
            text = rng.choice(["Yes.", "No!", "why", " \n", "", f"number {turn}.", f"open {turn}", "a.\x0b ", "ß?"])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, text))
    seen, out = set(), []
    for r in rows:
        if r[:2] not in seen:
            seen.add(r[:2])
            out.append(r)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted(brute(brute_damage(rows), {r[0] for r in rows}), key=repr)
    assert _rows(cr.op13_conversation_repair(spark, SF)) == want


@pytest.mark.parametrize("long_rows,block,fan", [(20_000, 1024, 4), (2, 1, 1), (3, 2, 2), (0, 4, 1)])
def test_random_conversations_within_and_across_tasks(spark, monkeypatch, long_rows, block, fan):
    rng = random.Random(long_rows)
    monkeypatch.setattr(cr, "LONG_ROWS", long_rows)
    monkeypatch.setattr(cr, "BLOCK", block)
    monkeypatch.setattr(cr, "FAN_IN_BITS", fan)
    rows = _conversations(rng, 60, 14) + [(1000, t, rng.choice(["user", "assistant"]), f"{t % 7}.") for t in range(90)]
    want = sorted(brute(rows, {r[0] for r in rows}), key=repr)
    assert _rows(cr.repaired(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (5, None, "user", "first."), (5, 0, None, "x."), (5, 1, "assistant", None), (6, 1, "user", "same."), (6, 1, "user", "same."), (6, 2, "assistant", "fine."), (7, None, None, None), (8, 2, "user", "x" * 5000)]
    for damage in (False, True):
        table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", block string, first int")
        got = _rows(cr.repaired(cr.damaged(table), "present") if damage else cr.repaired(table))
        plain = brute_damage(rows) if damage else [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows]
        assert got == sorted(brute(plain, {r[0] for r in rows}), key=repr)


def test_empty_and_lost(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert _rows(cr.repaired(none)) == [] and _rows(cr.repaired(cr.damaged(none), "present")) == []
    lost = spark.createDataFrame([(1, 1, "user", "a.", False), (2, 1, "user", "a.", None)], SCHEMA + ", present boolean")
    assert _rows(cr.repaired(lost, "present")) == [(c, 0, 0, 0, 0, 0, 0, "", EMPTY) for c in (1, 2)]


def test_product_is_associative_and_closed_under_insertions():
    rng = random.Random(1)
    turns = [cr.turn_matrix(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(12)]
    left = turns[0]
    for m in turns[1:]:
        left = cr.product(left, m)
    assert left == cr.multiplied(turns) == cr.product(cr.multiplied(turns[:5]), cr.multiplied(turns[5:]))
    assert cr.product(cr.INSERTIONS, cr.INSERTIONS) == cr.INSERTIONS
    assert all(cr.product(t, cr.INSERTIONS) == t for t in turns)


def test_every_short_conversation():
    for size in range(4):
        for roles in choices("suax", repeat=size):
            for bad in choices((0, 1, 2), repeat=size):
                facts = [(r, b == 1, b == 2) for r, b in zip(roles, bad, strict=True)]
                matrices = [cr.turn_matrix(*f) for f in facts]
                assert cr.cheapest(cr.multiplied(matrices) if matrices else None) == best_edits(facts)[:2]
