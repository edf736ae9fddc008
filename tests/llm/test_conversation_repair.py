"""Repairs against trying every sequence of edits, whole and cut into blocks."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest_llm import key
from velomart.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, ck string, kind int, pos long, code string"


def repairs(rows):
    """(cost, audit, lines) of the cheapest, ASCII-least repair of (role, text, fault),
    by keeping the best of every state; audits are compared as whole strings."""
    best = {0: (0, "", ())}
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    names = {2: "user", 3: "assistant"}

    def inserted(states):
        out = dict(states)
        for state, (cost, audit, lines) in states.items():
            for count in (1, 2):
                for _ in range(1):
                    state = follow[state]
                    cost, audit, lines = cost + 3, audit + "I", (*lines, names[state] + ":")
                if state not in out or (cost, audit) < out[state][:2]:
                    out[state] = (cost, audit, lines)
        return out

    for role, text, fault in rows:
        new = {}

        def offer(state, cost, audit, lines, new=new):
            if state not in new or (cost, audit) < new[state][:2]:
                new[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in inserted(best).items():
            offer(state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            offer(follow[state], cost + 3 + more, audit + "R", (*lines, f"{names[follow[state]]}:{text}"))
            after = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(state)
            if after:
                offer(after, cost + more, audit + "K", (*lines, f"{role}:{text}"))
        best = new
    ends = [inserted(best)[q][:3] for q in (0, 3) if q in inserted(best)]
    return min(ends)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows, every):
    """Reports of the rows (conv_id, turn, role, text), by conv_id."""
    out = {}
    for conv in every:
        digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (key(r[1]), digest(r)))
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, lines = repairs([(r[2], r[3], f) for r, f in zip(mine, faults, strict=True)])
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def conversations(seed, count, longest=9):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(count)]:
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "üser"])
            text = rnd.choice(["Hello.", "Yes!", "no end", "why?", "", " \n", None, "été.", "a.b", "x . \t"]) if rnd.random() < 0.7 else f"text {rnd.random()}."
            rows.append((conv, None if rnd.random() < 0.1 else turn * rnd.choice([1, 1, 1, 2]), role, text))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(parts)


def compare(spark, rows):
    df = frame(spark, rows)
    every = {r[0] for r in rows}
    got = {r.conv_id: tuple(r) for r in C.repair(C.damage(df), of=df).collect()}
    assert got == brute(damaged(rows), every)
    got = {r.conv_id: tuple(r) for r in C.repair(df).collect()}
    plain = [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows]
    assert got == brute(plain, every)


def test_odd_conversations(spark):
    compare(spark, conversations(1, 60))


@pytest.mark.parametrize("log2", [0, 1, 2])
def test_conversations_over_many_blocks(spark, monkeypatch, log2):
    monkeypatch.setattr(C, "BLOCK_LOG2", log2)
    rows = conversations(2, 12) + [(7, 100 + t, random.Random(t).choice(["user", "assistant"]), f"t{t % 40}" + "." * (t % 3)) for t in range(300)]
    compare(spark, rows)


def test_one_hot_conversation(spark):
    rnd = random.Random(4)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"said {t}.", "again.", "cut", ""])) for t in range(9000)]
    compare(spark, rows + conversations(3, 5))


def test_every_short_sequence():
    """Hirschberg's steps against whole audits, for all sequences of four classes."""
    faults, roles = ["", "blank", "duplicate", "truncated"], ["s", "u", "a", "t"]
    for n in (1, 2, 3):
        for codes in itertools.product(range(16), repeat=n):
            if 3 * n > 6 and random.Random(str(codes)).random() > 0.25:
                continue
            tables = [C.ROW_TABLES[c] for c in codes]
            last = C.last_state(tables)
            audit = "".join(C.STEPS[s] for s in C.steps_of(bytes(codes), C.START, last)) + "I" * C.TAIL[last]
            assert audit == repairs([(roles[c // 4], "", faults[c % 4]) for c in codes])[1]


def test_tables_in_any_grouping():
    rnd = random.Random(6)
    for _ in range(300):
        tables = [C.ROW_TABLES[rnd.randrange(16)] for _ in range(rnd.randint(2, 12))]
        cut = rnd.randint(1, len(tables) - 1)
        halves = [C.combined(tables[:cut]), C.combined(tables[cut:])]
        whole = C.combined(tables)
        joined = C.combined(halves)
        assert joined[0] == whole[0]
        for before in range(4):
            states = C.crossings(tables, before, 3)
            if whole[0][4 * before + 3] < C.FAR:
                assert C.crossings(halves, before, 3)[1] == states[cut]


def test_repaired_turns(spark):
    rows = conversations(8, 20)
    df = frame(spark, rows)
    lines = {}
    for r in C.repaired_turns(df).orderBy("line").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in C.repair(df).collect():
        mine = lines.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(mine).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in mine))


def test_empty_table(spark):
    df = frame(spark, [(1, 1, "user", "x")]).where("false")
    assert C.repair(C.damage(df), of=df).count() == 0
