"""Repair of conversation structure: the cheapest edits that give `(s?(ua)+)?` as the initials of the roles.

Spark marks every row (fault, neighbours) and hash-partitions rows by conversation. In each partition DuckDB runs one recursive query over batches of conversations: a
step of the recursion advances one turn of all of them and keeps, for each state of the grammar, the least cost and the ASCII-least audit of that cost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm.session import bounded_batches, thrifty

#: Rows of a slice, and of one conversation in it: audits of all steps are held until a slice ends, and grow with it. Longer conversations go on in the next slice.
SLICE, TURNS = 8192, 512
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: States: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's. What each may take next, and where it leads.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
DONE = (0, 3)
ROLE = {2: "user", 3: "assistant"}
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
FAULTS = ("", "blank", "duplicate", "truncated")
WORD = r"[^\x20\x09-\x0D]"


def _turn(state: int) -> int:
    """State after a user's or an assistant's turn, whichever must come."""
    return NEXT[state]["a" if state == 2 else "u"]


def moves() -> list[tuple[int, str, str, int, int]]:
    """(state, initial or '' for any, letters, cost, next state) of a turn: up to two inserts, then what happens to the turn. More inserts only lead back."""
    out = []
    for state in NEXT:
        at, letters, cost = state, "", 0
        for _ in range(3):
            out += [(state, ini, letters + KEEP, cost + COST[KEEP], to) for ini, to in NEXT[at].items()]
            out += [(state, "", letters + REROLE, cost + COST[REROLE], _turn(at)), (state, "", letters + DELETE, cost + COST[DELETE], at)]
            at, letters, cost = _turn(at), letters + INSERT, cost + COST[INSERT]
    return out


def endings() -> list[tuple[int, str, int]]:
    """(state, letters, cost) of the inserts that end a conversation in each state."""
    out = []
    for state in NEXT:
        at, letters = state, ""
        while at not in DONE:
            at, letters = _turn(at), letters + INSERT
        out.append((state, letters, COST[INSERT] * len(letters)))
    return out


_MOVES = ", ".join(map(str, moves()))
#: A cost and an audit as one text whose order is theirs.
_BOTH = "lpad(CAST({} AS VARCHAR), 12, '0') || {}"

#: turns (conv, pos, initial, fault: 0 none, 1 blank or duplicate, 2 truncated), begins (conv, state): the least (cost, audit) from each state a conversation begins in to each that it can be in after its turns.
SOLVE = f"""
WITH RECURSIVE moves(state, initial, letters, cost, next) AS (VALUES {_MOVES}),
 lengths AS (SELECT conv, max(pos) + 1 AS n FROM turns GROUP BY conv),
 steps(conv, pos, begin, state, best) AS (
   SELECT conv, CAST(0 AS BIGINT), state, state, {_BOTH.format('0', "''")} FROM begins
   UNION ALL
   SELECT s.conv, s.pos + 1, s.begin, m.next, min({_BOTH.format("CAST(left(s.best, 12) AS BIGINT) + m.cost + CASE WHEN t.fault = 2 AND right(m.letters, 1) <> 'D' THEN 1 ELSE 0 END", "substr(s.best, 13) || m.letters")})
   FROM steps s JOIN turns t ON t.conv = s.conv AND t.pos = s.pos
   JOIN moves m ON m.state = s.state AND (m.initial = '' OR m.initial = t.initial) AND (t.fault <> 1 OR right(m.letters, 1) = 'D')
   GROUP BY s.conv, s.pos, s.begin, m.next)
SELECT s.conv, s.begin, s.state, CAST(left(s.best, 12) AS BIGINT) AS cost, substr(s.best, 13) AS audit
FROM steps s JOIN lengths l ON l.conv = s.conv AND l.n = s.pos"""


class Solver:
    """DuckDB in a worker's memory, with one thread as the task has one."""

    def __init__(self):
        import duckdb

        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})

    def solve(self, turns: pa.Table, begins: pa.Table) -> list[tuple[int, int, int, int, str]]:
        for name, table in (("turns", turns), ("begins", begins)):
            self.db.register(name, table)
        return self.db.execute(SOLVE).fetchall()


class Path:
    """What a conversation is so far if it is in one state of the grammar: cost, audit, and the hash of its repaired text."""

    def __init__(self):
        self.cost, self.audit, self.sha, self.turns = 0, "", hashlib.sha256(), 0

    def then(self, state: int, cost: int, letters: str, rows: list[tuple[str, str]]) -> "Path":
        new = Path()
        new.cost, new.audit, new.sha, new.turns = self.cost + cost, self.audit + letters, self.sha.copy(), self.turns
        for role, text in repaired(state, letters, rows):
            new.sha.update((("\n" if new.turns else "") + f"{role}:{text}").encode())
            new.turns += 1
        return new


def repaired(state: int, letters: str, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that an audit leaves of rows, beginning in a state."""
    row = iter(rows)
    for x in letters:
        role, text = ("", "") if x == INSERT else next(row)
        if x == DELETE:
            continue
        state = NEXT[state][role[:1]] if x == KEEP else _turn(state)
        yield (role if x == KEEP else ROLE[state]), text


COUNTS = ("fresh_turn", "blank", "duplicate", "truncated", "illegal")
OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Conversation:
    """One conversation as its slices come."""

    def __init__(self, key: int | None):
        self.key, self.paths, self.counts, self.least, self.most = key, {0: Path()}, dict.fromkeys(COUNTS, 0), None, None

    def row(self) -> tuple:
        ends = {s: (letters, cost) for s, letters, cost in endings()}
        cost, audit, state = min((p.cost + ends[s][1], p.audit + ends[s][0], s) for s, p in self.paths.items())
        path = self.paths[state].then(state, ends[state][1], ends[state][0], [])
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.counts["fresh_turn"]
        return (self.key, gaps, *[self.counts[c] for c in COUNTS[1:]], cost, audit, path.sha.hexdigest())


def _repair(slice_: int, most: int):
    """Rows sorted by conversation and turn (conv_id, turn, role, text, gone, fault, fresh_turn, illegal) to a row for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, open_ = Solver(), None  # open_: the last conversation, which can go on in the next slice
        for t in (b.slice(i, slice_) for b in batches for i in range(0, b.num_rows, slice_)):
            key, gone = t.column(0).to_pylist(), t.column(4).to_numpy(zero_copy_only=False)
            new = [k for k in range(len(key)) if k == 0 or key[k] != key[k - 1]]
            goes_on = open_ is not None and open_.key == key[0]
            convs = [open_ if n == 0 and goes_on else Conversation(key[k]) for n, k in enumerate(new)]
            done = [] if open_ is None or goes_on else [open_]
            ends = [*new[1:], len(key)]
            for lo in range(0, max(e - k for k, e in zip(new, ends)), most):
                _advance(solver, t, gone, [(c, k + lo, min(e, k + lo + most)) for c, k, e in zip(convs, new, ends) if k + lo < e])
            yield _rows([*done, *convs[:-1]])
            open_ = convs[-1]
        if open_ is not None:
            yield _rows([open_])

    return run


def _rows(convs: list[Conversation]) -> pa.RecordBatch:
    columns = list(zip(*[c.row() for c in convs])) or [()] * 9
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in OUT.split(", ")])


def _advance(solver: Solver, t: pa.RecordBatch, gone: np.ndarray, spans: list[tuple[Conversation, int, int]]) -> None:
    """Lets conversations go on over some rows each."""
    turn, fault = t.column(1), t.column(5).to_numpy(zero_copy_only=False)
    flags = {"fresh_turn": t.column(6).to_numpy(zero_copy_only=False), "illegal": t.column(7).to_numpy(zero_copy_only=False)}
    flags |= {name: fault == n for n, name in enumerate(FAULTS) if n}
    rows, conv, pos = [], [], []
    for n, (c, a, e) in enumerate(spans):
        stay = [k for k in range(a, e) if not gone[k]]
        for name in COUNTS:
            c.counts[name] += int(flags[name][stay].sum()) if stay else 0
        turns = [x for x in turn.take(pa.array(stay, pa.int64())).to_pylist() if x is not None]
        if turns:
            c.least = min(turns) if c.least is None else min(c.least, *turns)
            c.most = max(turns) if c.most is None else max(c.most, *turns)
        rows += stay
        conv += [n] * len(stay)
        pos += range(len(stay))
    if not rows:
        return
    own = t.take(pa.array(rows))
    role, text = own.column(2).to_pylist(), own.column(3).to_pylist()
    kind = np.array([0, 1, 1, 2])[fault[rows]]
    turns = pa.table({"conv": pa.array(conv, pa.int64()), "pos": pa.array(pos, pa.int64()), "initial": pa.array([r[:1] or " " for r in role]), "fault": pa.array(kind, pa.int64())})
    begins = [(n, s) for n, (c, _, _) in enumerate(spans) for s in c.paths]
    begins = pa.table({"conv": pa.array([x[0] for x in begins], pa.int64()), "state": pa.array([x[1] for x in begins], pa.int64())})
    best: dict[int, dict[int, tuple]] = {}
    for n, begin, state, cost, letters in solver.solve(turns, begins):
        before = spans[n][0].paths[begin]
        way = (before.cost + cost, before.audit + letters, begin, cost, letters)
        of = best.setdefault(n, {})
        of[state] = min(of.get(state, way), way)
    first = np.searchsorted(conv, np.arange(len(spans) + 1))
    for n, ways in best.items():
        pairs = list(zip(role[first[n] : first[n + 1]], text[first[n] : first[n + 1]]))
        spans[n][0].paths = {state: spans[n][0].paths[begin].then(begin, cost, letters, pairs) for state, (_, _, begin, cost, letters) in ways.items()}


def marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, gone), partitioned by conversation and in order, with fault (a place in FAULTS), fresh_turn and illegal.

    One shuffle, by conv_id; the windows and the order are sorts within its partitions and hold no conversation in memory."""
    live = ~F.col("gone")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.repartition("conv_id").withColumn("copy", F.row_number().over(seen))
    order = Window.partitionBy("conv_id").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text", "copy")
    blank = ~F.col("text").rlike(WORD)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, 1).when(F.col("copy") > 1, 2).when(cut, 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(order), initial)  # null for a conversation's first row
    before = F.lag("turn").over(order)
    fresh = F.col("turn").isNotNull() & F.coalesce(before != F.col("turn"), F.lit(True))
    return rows.select("conv_id", "turn", "role", "text", "gone", (fault * live.cast("int")).alias("fault"), (fresh & live).alias("fresh_turn"), (live & F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False))).alias("illegal"), "copy").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "gone", F.col("turn").asc_nulls_first(), "role", "text", "copy").drop("copy")


def repair(rows: DataFrame, slice_: int = SLICE, turns: int = TURNS) -> DataFrame:
    """The cheapest repair of each conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    rows: conv_id, turn long; role, text string; gone boolean (true: the row isn't there, but its conversation has a result). Other columns are not read. A null role or text is one space, a null conv_id a conversation of its own.
    Order: turn (null first), role, text, all bytewise; equal rows stand side by side. A row's first fault counts: blank, duplicate (role and text were in an earlier row), truncated. Keep costs 0 and needs a role whose initial
    the grammar takes, so a row with another role, or an empty one, is reroled or deleted; Rerole costs 2, Delete 3 (blank and duplicate rows must go), an insert of an empty turn 2; a truncated row that isn't deleted adds 1. audit: the edits' initials
    in order; of the cheapest the ASCII-least. illegal: adjacent rows whose initials aren't su, ua or au, before the repair. A conversation without rows has zeros, an empty audit and the hash of an empty text.

    A conversation is solved in one task, as the hash of its text goes through it in order, but in slices of slice_ rows, ``turns`` of one conversation: for each state its cost, audit and running hash are kept, not its rows."""
    bounded_batches(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.col("gone"))
    return marked(rows).mapInArrow(thrifty(_repair(slice_, turns)), OUT)


def damaged(conversations: DataFrame, kinds: int = 20) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) with faults by crc32(`conv_id:turn`) % kinds: 0 the row is gone, 1 its text is empty, 2 its text has no `.!?`, 3 it stands twice, 4 its role is user. Nulls: one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % kinds
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("n"))
    return rows.drop("n")
