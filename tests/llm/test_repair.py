"""Conversation repair against plain dynamic programming, with chunks so small that conversations span many."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from quayside.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(letters):
    """Least cost and ASCII-least edits for ``(initial, fault)`` rows, from the end on; insertions up to two in a row."""
    best = {0: (0, ""), 3: (0, ""), 2: (2, "I"), 1: (4, "II")}
    for start, fault in reversed(letters):
        more = fault == "truncated"
        over = {}
        for q in AFTER:
            ways = [(3 + best[q][0], "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                fresh = AFTER[q]["a" if q == 2 else "u"]
                ways.append((2 + more + best[fresh][0], "R" + best[fresh][1]))
                if start in AFTER[q]:
                    to = AFTER[q][start]
                    ways.append((more + best[to][0], "K" + best[to][1]))
            over[q] = min(ways)
        for _ in range(3):
            for q in AFTER:
                to = AFTER[q]["a" if q == 2 else "u"]
                over[q] = min(over[q], (2 + over[to][0], "I" + over[to][1]))
        best = over
    return best[0]


def plain(rows):
    """``rows`` are (conv, turn, role, text) as given; null roles and texts are a space."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (*r[:3], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = {t for known, t, _, _ in talk if known}
        seen, letters = set(), []
        for _, _, role, text in talk:
            words = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            letters.append((role[:1], fault))
        cost, audit = cheapest(letters)
        state, left, lines = 0, iter(zip(talk, letters, strict=True)), []
        for edit in audit:
            fresh = "a" if state == 2 else "u"
            (_, _, role, text), (start, _) = ((0, 0, "", ""), ("", "")) if edit == "I" else next(left)
            if edit == "D":
                continue
            mark = start if edit == "K" else fresh
            lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[mark]}:{text}")
            state = AFTER[state][mark]
        faults = [f for _, f in letters]
        wrong = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), wrong, cost, audit, digest)
    return out


def found(rows):
    mended = repair.repair_conversations(rows)
    digests = {r["conv"]: r["digest"] for r in repair.conversation_digests(mended.rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*list(r)[1:], digests.get(r["conv"], empty)) for r in mended.summary.collect()}


def test_auction_finds_the_cheapest_and_least_edits():
    draw = random.Random(4)
    words = ["".join(w) for n in range(4) for w in product("suaUA?!x", repeat=n)]
    words += ["".join(draw.choices("suaSUA?!x", k=draw.randint(4, 40))) for _ in range(600)]
    words += ["u" * 64, "a" * 64, "s" * 64, "x" * 64, "ua" * 32, "au" * 32]
    for word in words:
        faults = [("" if c in "?!" else c.lower(), "blank" if c == "x" else "truncated" if c.isupper() or c == "!" else None) for c in word]
        assert repair.traces(word, repair.ENDS)[0][:2] == cheapest(faults), word


def test_costs_between_states():
    for word, closing in product(("", "u", "x", "uUa?", "asxu!"), (True, False)):
        matrix = repair.costs(word, closing)
        for target in range(4):
            exits = tuple(0 if q == target else None for q in range(4))
            found = repair.traces(word, exits, tuple(range(4)), closing)
            assert [f and f[0] for f in found] == [row[target] for row in matrix]
    assert repair.costs("")[2][0] is None and repair.costs("")[3] == (None, None, 2, 0)
    assert repair.costs("", False)[3] == (None, None, None, 0) and repair.costs("u", False)[2] == (None, None, 2, 2)


def talks(seed, count, longest):
    draw, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "x. \n", "tail.\x0b", None, "é", "a.b", ".", "end…"]
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"])
            rows.append((conv if conv else None, None if draw.random() < 0.1 else turn * draw.choice([1, 1, 2]), role, draw.choice(texts) if draw.random() < 0.4 else f"{draw.random()}{draw.choice('.!?x')}"))
    return rows


@pytest.mark.parametrize("chunk,scan,longest", [(64, 256, 9), (3, 3, 30)])
def test_repair_equals_plain_search(spark, monkeypatch, chunk, scan, longest):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "SCAN", scan)
    rows = talks(chunk, 8 if chunk < 9 else 25, longest)
    rows += rows[:7]  # repeated rows
    clash = {n: F.lit(1) for n in ("conv", "chunk", "rn", "at", "fault", "hash", "blank", "_part", "rows", "word")}
    assert found(spark.createDataFrame(rows, SCHEMA).withColumns(clash)) == plain(rows)


def test_one_hot_conversation_and_very_long_text(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", f"{i}.") for i in range(300)] + [(8, 0, "user", "w " * 500_000), (8, 1, "assistant", " " * 300_000 + "x.")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_damage_keeps_every_conversation(spark):
    rows = talks(9, 60, 2)
    out = {r["conv_id"]: tuple(r)[1:] for r in queries.repair_damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(out) == {r[0] for r in rows}
    left = [tuple(r) for r in queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    expected = plain(left)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert out == {conv: expected.get(conv, nothing) for conv in out}
    assert nothing in out.values()


def test_empty_table(spark):
    assert queries.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []
