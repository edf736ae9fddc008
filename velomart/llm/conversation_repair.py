"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is edited at least cost into turns whose role initials read
``(s?(ua)+)?``.  That pattern has four states (nothing yet, after s, after u, after a), so
any stretch of rows is a 4 x 4 table: the least cost from each state before it to each
state after it.  To find the edits, the cost vector of the first half (forward) and that of
the second half (backward) meet in the middle; the state in which the cheapest repair
crosses is chosen and both halves are solved alone.  No table of all rows by states is held.

* Ties go to the ASCII-least audit.  A stretch's audits end with the letter that takes its
  last row, so none is the beginning of another, and it is enough to know the order of the
  four states' least audits (their ranks): the crossing of least rank is that of the least
  audit.  Tables of cost and rank can be put together in any grouping.
* Rows are sorted by ranges of (conversation, turn), so a conversation that holds a third
  of all rows is cut over many tasks.  Blocks of ``BLOCK`` sorted rows give tables; the
  tables of a conversation that goes over several blocks are put together in two levels
  (``BLOCK`` tables, then all), and the crossings go the same way back down.
* Only class codes of rows (a byte each) take part so far.  Last, each conversation's codes
  and edits, then its rows, stream through one task in order, because a SHA-256 of the
  repaired text has no parts; a byte a row is held there, and the audit has as many.

Defined cases: null texts and roles are one space; rows of one turn are taken by a digest
of role and text (equal ones lie side by side); a role whose first letter is not s, u or a,
or an empty one, cannot be kept as it is; null conversation ids are one conversation; null
turns come first and count for no gap; a conversation without rows has zeros, an empty
audit and the hash of the empty string; other columns are ignored.  Rows are read twice as
they are stored; rows of another origin than a stored table are to be written first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, ship_package

BLOCK_LOG2 = 12
BLOCK = 1 << BLOCK_LOG2
FAR = 1 << 50  # the cost of what cannot be
SPACES = " \t\n\x0b\x0c\r"

S, U, A, OTHER = range(4)  # initials
WHOLE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults
INSERT, DELETE, REROLE, CUT = 3, 4, 3, 3  # costs; CUT for a truncated row that stays
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # states
NEXT_BY_EDIT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # of an inserted or reroled turn
KEPT = {(START, S): AFTER_S, (START, U): AFTER_U, (AFTER_S, U): AFTER_U, (AFTER_A, U): AFTER_U, (AFTER_U, A): AFTER_A}
TAIL = (0, 2, 1, 0)  # inserts after the last row
ROLE_OF = {AFTER_U: "user", AFTER_A: "assistant"}
#: The ways to take a row, in the order of their letters: inserts before it, then the edit.
STEPS = sorted("I" * inserts + edit for inserts in range(3) for edit in "DKR")

Table = tuple[tuple[int, ...], tuple[int, ...]]  # costs and ranks by (before, after)


def _row_table(code: int) -> tuple[Table, tuple[int, ...]]:
    """Costs and ranks of a row of this class, and its cheapest least steps."""
    initial, fault = divmod(code, 4)
    costs, ranks, steps = [FAR] * 16, [0] * 16, [-1] * 16
    for before in range(4):
        for number, step in enumerate(STEPS):
            state, cost = before, 0
            for _ in step[:-1]:
                state, cost = NEXT_BY_EDIT[state], cost + INSERT
            if step[-1] == "D":
                cost += DELETE
            elif fault in (BLANK, DUPLICATE):
                continue
            else:
                cost += CUT if fault == TRUNCATED else 0
                if step[-1] == "R":
                    state, cost = NEXT_BY_EDIT[state], cost + REROLE
                elif (state, initial) in KEPT:
                    state = KEPT[state, initial]
                else:
                    continue
            at = 4 * before + state
            if cost < costs[at]:
                costs[at], ranks[at], steps[at] = cost, number, number
    return (tuple(costs), tuple(ranks)), tuple(steps)


_ROWS = [_row_table(code) for code in range(16)]
ROW_TABLES = [table for table, _ in _ROWS]
ROW_STEPS = [steps for _, steps in _ROWS]


@lru_cache(1 << 16)
def _forward(costs: tuple[int, ...], ranks: tuple[int, ...], table: Table) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """Costs and ranks after a stretch; costs are given less their least, which comes first."""
    out, order = [], []
    for after in range(4):
        cost, rank, before = min((costs[b] + table[0][4 * b + after], ranks[b], b) for b in range(4))
        out.append(cost)
        order.append((cost >= FAR, rank, table[1][4 * before + after], after))
    places = {key[-1]: place for place, key in enumerate(sorted(order))}
    least = min(out)
    return least, tuple(min(c - least, FAR) for c in out), tuple(places[q] for q in range(4))


@lru_cache(1 << 16)
def _backward(costs: tuple[int, ...], table: Table) -> tuple[int, tuple[int, ...]]:
    out = [min(table[0][4 * before + after] + costs[after] for after in range(4)) for before in range(4)]
    least = min(out)
    return least, tuple(min(c - least, FAR) for c in out)


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if q == state else FAR for q in range(4))


def ahead(tables: list[Table], first: int, end: int, before: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The cost vector after tables first to end from one state, as a base, what each
    state costs beyond it, and the states' ranks."""
    base, costs, ranks = 0, _only(before), (0, 0, 0, 0)
    for table in tables[first:end]:
        more, costs, ranks = _forward(costs, ranks, table)
        base += more
    return base, costs, ranks


def crossings(tables: list[Table], before: int, after: int) -> list[int]:
    """The states between the stretches, from ``before`` to ``after`` with both ends."""
    states = [before] + [-1] * (len(tables) - 1) + [after] if tables else [before]

    def solve(first: int, end: int) -> None:
        if end - first < 2:
            return
        middle = (first + end) // 2
        _, costs, ranks = ahead(tables, first, middle, states[first])
        back = _only(states[end])
        for table in reversed(tables[middle:end]):
            _, back = _backward(back, table)
        states[middle] = min(range(4), key=lambda q: (costs[q] + back[q], ranks[q]))
        solve(first, middle)
        solve(middle, end)

    solve(0, len(tables))
    return states


def last_state(tables: list[Table]) -> int:
    """The state after the last row of the cheapest, least repair from the start."""
    _, costs, ranks = ahead(tables, 0, len(tables), START)
    return min(range(4), key=lambda q: (costs[q] + INSERT * TAIL[q], ranks[q]))


def combined(tables: list[Table]) -> Table:
    """The table of consecutive stretches."""
    costs, ranks = [], []
    for before in range(4):
        base, more, order = ahead(tables, 0, len(tables), before)
        costs += [min(base + c, FAR) for c in more]
        ranks += order
    return tuple(costs), tuple(ranks)


def steps_of(codes: bytes, before: int, after: int) -> bytes:
    """The number of each row's step."""
    states = crossings([ROW_TABLES[c] for c in codes], before, after)
    return bytes(ROW_STEPS[c][4 * p + q] for c, p, q in zip(codes, states[:-1], states[1:], strict=True))


_TABLE = pa.list_(pa.int64())


def _segments(key: tuple, rows: pa.Table) -> pa.Table:
    """A block's stretches of one conversation each.  The inner ones are whole and are
    solved here; the outer two may go on, and give their table."""
    rows = rows.sort_by("pos")
    keys = rows.column("ck").to_pylist()
    codes = bytes(rows.column("code").to_pylist())
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    out: dict[str, list] = {n: [] for n in ("ck", "codes", "steps", "tail", "costs", "ranks")}
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        mine = codes[a:b]
        tables = [ROW_TABLES[c] for c in mine]
        inner = a > 0 and b < len(keys)
        costs, ranks = (None, None) if inner else combined(tables)
        last = last_state(tables) if inner else None
        for name, value in zip(out, (keys[a], mine, steps_of(mine, START, last) if inner else None, TAIL[last] if inner else None, costs, ranks), strict=True):
            out[name].append(value)
    kinds = {"ck": pa.string(), "codes": pa.binary(), "steps": pa.binary(), "tail": pa.int32(), "costs": _TABLE, "ranks": _TABLE}
    return pa.table({"block": pa.array([key[0].as_py()] * len(out["ck"]), pa.int64()), **{n: pa.array(v, kinds[n]) for n, v in out.items()}})


def _tables(rows: pa.Table) -> list[Table]:
    return [(tuple(c), tuple(r)) for c, r in zip(rows.column("costs").to_pylist(), rows.column("ranks").to_pylist(), strict=True)]


def _combine(key: tuple, rows: pa.Table) -> pa.Table:
    costs, ranks = combined(_tables(rows.sort_by("block")))
    return pa.table({"ck": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int64()), "costs": pa.array([costs], _TABLE), "ranks": pa.array([ranks], _TABLE)})


def _cross(rows: pa.Table, before: int, after: int, tail: int) -> pa.Table:
    states = crossings(_tables(rows), before, after)
    n = rows.num_rows
    tails = [-1] * (n - 1) + [tail]
    kind = pa.int32()
    return pa.table({"ck": rows.column("ck"), "block": rows.column("block"), "enter": pa.array(states[:-1], kind), "leave": pa.array(states[1:], kind), "tail": pa.array(tails, kind)})


def _top(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("block")
    last = last_state(_tables(rows))
    return _cross(rows, START, last, TAIL[last])


def _down(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("block")
    enter, leave, tail = (rows.column(c)[0].as_py() for c in ("enter", "leave", "tail"))
    return _cross(rows, enter, leave, tail)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The steps of stretches whose states at both ends are known."""
    for batch in batches:
        codes, enter, leave = (batch.column(c).to_pylist() for c in ("codes", "enter", "leave"))
        steps = [steps_of(*x) for x in zip(codes, enter, leave, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("ck"), batch.column("block"), batch.column("codes"), pa.array(steps, pa.binary()), batch.column("tail")], names=["ck", "block", "codes", "steps", "tail"])


_COST = np.array([INSERT * (len(s) - 1) + {"D": DELETE, "K": 0, "R": REROLE}[s[-1]] for s in STEPS], np.int64)
_STAYS = np.array([s[-1] != "D" for s in STEPS])


class _Conversation:
    """One conversation as it streams by: first its codes and steps, then its rows."""

    def __init__(self, ck: str) -> None:
        self.ck, self.codes, self.steps, self.tail = ck, bytearray(), bytearray(), 0
        self.state, self.row, self.sha, self.lines = START, 0, hashlib.sha256(), 0
        self.turns: list = [None, None, 0]  # least, largest, how many different

    def _line(self, role: str, text: str) -> tuple[int, str, str]:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1
        return self.lines - 1, role, text

    def _inserted(self, count: int) -> list[tuple[int, str, str]]:
        out = []
        for _ in range(count):
            self.state = NEXT_BY_EDIT[self.state]
            out.append(self._line(ROLE_OF[self.state], ""))
        return out

    def take(self, turn: int | None, role: str, text: str) -> list[tuple[int, str, str]]:
        """The repaired lines that a row gives."""
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        step = STEPS[self.steps[self.row]]
        initial = self.codes[self.row] // 4
        self.row += 1
        out = self._inserted(len(step) - 1)
        if step[-1] == "K":
            self.state = KEPT[self.state, initial]
            out.append(self._line(role, text))
        elif step[-1] == "R":
            self.state = NEXT_BY_EDIT[self.state]
            out.append(self._line(ROLE_OF[self.state], text))
        return out

    def finish(self) -> tuple[list[tuple[int, str, str]], tuple]:
        out = self._inserted(self.tail)
        codes, steps = np.frombuffer(bytes(self.codes), np.uint8), np.frombuffer(bytes(self.steps), np.uint8)
        initials, faults = codes // 4, codes % 4
        a, b = initials[:-1], initials[1:]
        legal = ((a == S) & (b == U)) | ((a == U) & (b == A)) | ((a == A) & (b == U))
        cost = int(_COST[steps].sum()) + CUT * int((_STAYS[steps] & (faults == TRUNCATED)).sum()) + INSERT * self.tail
        low, high, different = self.turns
        gaps = 0 if low is None else high - low + 1 - different
        audit = "".join(STEPS[s] for s in steps.tolist()) + "I" * self.tail
        return out, (self.ck, gaps, *(int((faults == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), int((~legal).sum()), cost, audit, self.sha.hexdigest())


_REPORT = "ck string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_LINES = "ck string, line long, role string, text string"


def _assemble(lines: bool):
    """From each conversation's pieces and rows, in order: its report, or its lines."""
    names = [c.split()[0] for c in (_LINES if lines else _REPORT).split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in (_LINES if lines else _REPORT).split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        out: list[tuple] = []

        def close() -> None:
            if now is not None:
                last, report = now.finish()
                out.extend([(now.ck, *x) for x in last] if lines else [report])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ck", "kind", "codes", "steps", "tail", "turn", "role", "text"))
            for ck, kind, codes, steps, tail, turn, role, text in zip(*columns, strict=True):
                if now is None or now.ck != ck:
                    close()
                    now = _Conversation(ck)
                if kind == 0:
                    now.codes += codes
                    now.steps += steps
                    now.tail = max(tail, 0)
                else:
                    made = now.take(turn, role, text)
                    if lines:
                        out.extend((ck, *x) for x in made)
            yield batch_of(out)
            out.clear()
        close()
        yield batch_of(out)

    return run


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), conv.cast("string")))


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows conv_id, turn, role and text with one in twenty lost, emptied, without its
    sentence ends, repeated, and said by the user, each by a checksum of its place."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(space(id_col), F.lit(":"), space(turn_col)).cast("binary")) % 20).cast("int")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), kind.alias("kind"))
        .where("kind != 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def _described(rows: DataFrame) -> DataFrame:
    """ck, turn, role, text, the digest of role and text, and the class code without
    duplicates."""
    rows = rows.select(
        _key(F.col("conv_id")).alias("ck"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(trimmed == "", BLANK).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(WHOLE)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    return rows.select("ck", "turn", "role", "text", digest.alias("digest"), (letter * 4 + fault).cast("int").alias("code"))


def _pieces(rows: DataFrame) -> DataFrame:
    """ck, block, codes, steps and tail of each stretch of sorted rows."""
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    slim = rows.select("ck", "turn", "digest", "code", F.monotonically_increasing_id().alias("tie"))
    placed = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("ck", "digest", "code", F.monotonically_increasing_id().alias("pos"))
    placed = materialize(placed, "turns")
    again = placed.where(f"code % 4 != {BLANK}").groupBy("ck", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    flagged = placed.join(again, ["ck", "digest"], "left")
    code = F.when(F.col("pos") > F.col("first"), F.expr(f"code - code % 4 + {DUPLICATE}")).otherwise(F.col("code"))
    coded = flagged.select("ck", "pos", code.alias("code"), F.shiftright("pos", BLOCK_LOG2).alias("block"))
    schema = "block long, ck string, codes binary, steps binary, tail int, costs array<long>, ranks array<long>"
    found = materialize(coded.groupBy("block").applyInArrow(_segments, schema), "stretches")
    whole = found.where("steps is not null").select("ck", "block", "codes", "steps", "tail")
    outer = found.where("steps is null").withColumn("over", F.shiftright("block", BLOCK_LOG2))
    upper = outer.select("ck", "over", "block", "costs", "ranks").groupBy("ck", "over").applyInArrow(_combine, "ck string, block long, costs array<long>, ranks array<long>")
    states = "ck string, block long, enter int, leave int, tail int"
    top = upper.groupBy("ck").applyInArrow(_top, states)
    held = outer.select("ck", "over", "block", "costs", "ranks").join(top.withColumnRenamed("block", "over"), ["ck", "over"])
    down = held.groupBy("ck", "over").applyInArrow(_down, states)
    solved = map_batches(outer.select("ck", "block", "codes").join(down, ["ck", "block"]).select("ck", "block", "codes", "enter", "leave", "tail"), _solve, "ck string, block long, codes binary, steps binary, tail int")
    return whole.union(solved)


def _streamed(rows: DataFrame, lines: bool) -> DataFrame:
    ship_package(rows.sparkSession)
    rows = _described(rows)
    pieces = _pieces(rows).select(
        "ck", F.lit(0).alias("kind"), "block", "codes", "steps", "tail", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")
    )
    null = lambda t: F.lit(None).cast(t)
    said = rows.select("ck", F.lit(1).alias("kind"), null("long").alias("block"), null("binary").alias("codes"), null("binary").alias("steps"), null("int").alias("tail"), "turn", "digest", "role", "text")
    order = ["ck", "kind", "block", F.col("turn").asc_nulls_first(), "digest"]
    stream = pieces.union(said).repartition("ck").sortWithinPartitions(*order)
    return map_batches(stream, _assemble(lines), _LINES if lines else _REPORT)


def repair(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """A report of each conversation of ``rows`` (conv_id, turn, role, text), or of every
    conv_id of ``of``: gaps, faults, cost, audit and the digest of the repaired turns."""
    every = (rows if of is None else of).select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    found = every.join(_streamed(rows, lines=False), F.col("key") == F.col("ck"), "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return found.select(
        "conv_id", *(count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, line (from 0), role and text of the repaired conversations."""
    every = rows.select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    return every.join(_streamed(rows, lines=True), F.col("key") == F.col("ck")).select("conv_id", "line", "role", "text")
