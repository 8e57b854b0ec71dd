"""Conversation repair against a search over all edits, whole and in pieces."""

from __future__ import annotations

import hashlib
import heapq
import os
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daystar.llm import conversations, turn_alignment
from daystar.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit int"


def cheapest(initials, required, extra):
    """(cost, audit) by trying all edits in the order of their cost, then of their letters."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, said = heapq.heappop(heap)
        # What may follow depends on the turn, on the last role, and on whether a system turn stands alone.
        state = (at, said[-1:], said == "s")
        if state in seen or not re.fullmatch(r"s?(ua)*u?", said):
            continue
        seen.add(state)
        if at == len(initials) and re.fullmatch(r"(s?(ua)+)?", said):
            return cost, audit
        if at < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, said))
            if not required[at]:
                more = cost + extra[at]
                heapq.heappush(heap, (more, audit + "K", at + 1, said + (initials[at] or "?")))
                for role in "ua":
                    heapq.heappush(heap, (more + 1, audit + "R", at + 1, said + role))
        for role in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", at, said + role))


def contract(rows):
    """{conv_id: columns of op13} of rows (conv_id, turn, role, text), by its wording."""
    found, kept = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv] += []
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(shown).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in kept.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        faults, seen = [], set()
        for _, role, text in turns:
            bare = text.strip(BLANK)
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = cheapest(
            initials, [f in ("blank", "duplicate") for f in faults], [5 * (f == "truncated") for f in faults]
        )
        lines, at = [], 0
        for edit in audit:
            after = {"": "user", "s": "user", "a": "user", "u": "assistant"}[lines[-1][0] if lines else ""]
            if edit == "I":
                lines.append(f"{after}:")
                continue
            _, role, text = turns[at]
            at += 1
            if edit != "D":
                lines.append(f"{role if edit == 'K' else after}:{text}")
        numbers = {t[0] for t in turns if t[0] is not None}
        found[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def talk(seed=1):
    """Conversations with missing, repeated and awkward turns, one of them without an id."""
    draw, rows = random.Random(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    for conv in [*range(40), None]:
        for turn in range(draw.randint(0, 14) if conv is not None else 60):
            role = roles[turn % 2] if draw.random() < 0.7 else draw.choice(roles)
            role = "system" if turn == 0 and draw.random() < 0.4 else role
            text = draw.choice([f"text {turn}.", f"text {turn}.", "again!", f"cut {turn}", " \t", "", None, "tail? \x0b"])
            rows.append((conv, None if draw.random() < 0.1 else turn + draw.randint(0, 1), role, text, 7))
    return rows + rows[:5]


def of(rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[name] for name in names) for r in rows}


def repaired(df):
    return conversations.report(conversations.repair(conversations.damaged(df), present=~F.col("dropped")))


def test_alignment_of_random_turns():
    draw = random.Random(4)
    for _ in range(1500):
        initials = [draw.choice(["s", "u", "a", "u", "a", "x", ""]) for _ in range(draw.randint(0, 12))]
        required = [draw.random() < 0.2 for _ in initials]
        extra = [0 if must or draw.random() < 0.8 else 5 for must in required]
        found = turn_alignment.transitions(
            initials, required, extra, (turn_alignment.START,), (turn_alignment.START, turn_alignment.ANSWERED)
        )
        wanted = cheapest(initials, required, extra)
        assert min(found.values()) == wanted
        chain, at = turn_alignment.Chain(), 0
        while at < len(initials):
            end = at + draw.randint(1, 4)
            chain.add(turn_alignment.transitions(initials[at:end], required[at:end], extra[at:end]))
            at = end
        cost, parts = chain.best()
        assert (cost, "".join(audit for audit, _ in parts)) == wanted


@pytest.mark.parametrize("pieces", [False, True], ids=["whole", "in-pieces"])
def test_repair(spark, monkeypatch, pieces):
    if pieces:
        monkeypatch.setattr(conversations, "LONG_TURNS", 3)
        monkeypatch.setattr(conversations, "PIECE_TURNS", 4)
    rows = talk()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = repaired(df).collect()
    wanted = contract([row[:4] for row in rows])
    assert len(found) == len(wanted) and of(found) == wanted


def test_pieces_by_characters(spark, monkeypatch):
    rows = talk(2)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(conversations, "LONG_CHARS", 20)
    monkeypatch.setattr(conversations, "PIECE_CHARS", 15)
    parts = conversations.repair(df).collect()
    assert max(row.pieces for row in parts) > 3
    assert all(len(row.audit) < 12 for row in parts if row.pieces > 1)
    assert of(repaired(df).collect()) == contract([row[:4] for row in rows])


def test_nothing_left_and_no_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "x.", 1)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert of(repaired(df).collect()) == {lost: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert repaired(df.limit(0)).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi.", 0), (1, 1, "user", "Hi.", 0), (1, 2, "user", "Well.", 0), (2, 0, "user", "Hm.", 0)]
    found = {r.conv_id: r for r in conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (found[1].audit, [tuple(t) for t in found[1].turns]) == ("KDR", [("user", "Hi."), ("assistant", "Well.")])
    assert (found[2].audit, found[2].cost, found[2].turns) == ("D", 2, [])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op13_turns"](spark, SF_DIR).collect()
    wanted = contract([tuple(row) for row in rows])
    assert len(found) == len(wanted) and of(found) == wanted
