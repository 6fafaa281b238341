"""Repair of the structure of conversations by run-length dynamic programming.

A repaired conversation is empty, or an optional system turn followed by pairs of a user's and an assistant's
turn.  Every turn is kept (K), given the role user or assistant (R, cost 2) or deleted (D, cost 3, a must for
blank and repeated turns), empty turns are inserted (I, cost 2), and a truncated turn that stays costs 1.  The
cheapest edits are chosen, of equally cheap ones those whose initials come first in ASCII order.

What has been written so far matters only by its last turn, so there are four states, and a turn is a 4x4 matrix of
costs between them under (min, +), given by its symbol: the initial of its role and its fault.  Turns with equal
symbols in a row form a run; the costs to the end are carried over a run with binary powers of its matrix,
which are worked out once per symbol.  Then the choices are unrolled turn by turn, from the first to the last.

Conversations of at most ``ROWS`` turns and ``BYTES`` of text meet whole in a task.  Longer ones are sorted over
many tasks and cut into blocks of ``BLOCK`` rows: each block's product of matrices gives the costs to the end of
all blocks, each block's exit per entry state gives the states between them, and each block is then unrolled by
itself.  Both ways give the same edits.  Only the digest of a long conversation, a running hash by definition, reads
the repaired pieces one after the other, without holding them.

Defined cases: turns come in the order of ``turn``, nulls first, ties by role and then text (byte order); a null role or text
counts as one blank, a null ``conv_id`` as a conversation of its own; equal rows each count, all but the first as
duplicates; roles other than s..., u..., a... cannot be kept; a row with ``copies`` 0 only says that the
conversation exists; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import textbytes
from abundix.operators.scaling import join_on
from abundix.session import cut_lineage

ROWS = 20_000
BYTES = 16 << 20
BLOCK_BITS = 12
BATCH_BYTES = 1 << 20

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]

_FAR = 1 << 60
# States by the last turn written: none, system, user, assistant.
_STATES = range(4)
_DONE = (0, 3)
_KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "?": (-1, -1, -1, -1)}
_WRITE = (2, 2, 3, 2)  # where an inserted or re-roled turn leads to
_ROLE = {2: "user", 3: "assistant"}
_MUST_GO = "x"
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _before(a: Matrix, after: Vector) -> Vector:
    """Costs to the end from each state ahead of ``a``, from those behind it."""
    return tuple(min(a[i][k] + after[k] for k in _STATES) for i in _STATES)


def _inserts() -> Matrix:
    rows = []
    for i in _STATES:
        costs, state, cost = [_FAR] * 4, i, 0
        while costs[state] == _FAR:
            costs[state] = cost
            state, cost = _WRITE[state], cost + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


_UNIT: Matrix = tuple(tuple(0 if i == j else _FAR for j in _STATES) for i in _STATES)
_INSERTS = _inserts()
#: Costs to the end behind the last turn.
END: Vector = _before(_INSERTS, tuple(0 if i in _DONE else _FAR for i in _STATES))


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """What can be done with a turn: (initial, cost, next state), in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol != _MUST_GO:
        more = TRUNCATED if symbol.endswith("t") else 0
        kept = _KEEP[symbol[0]][state]
        if kept >= 0:
            out.append(("K", more, kept))
        out.append(("R", REROLE + more, _WRITE[state]))
    return out


@lru_cache(maxsize=None)
def _power(symbol: str, k: int) -> Matrix:
    """The matrix of 2^k turns with this symbol, inserts ahead of each included."""
    if k:
        half = _power(symbol, k - 1)
        return _product(half, half)
    direct = [[_FAR] * 4 for _ in _STATES]
    for i in _STATES:
        for _, cost, j in _edits(symbol, i):
            direct[i][j] = min(direct[i][j], cost)
    return _product(_INSERTS, tuple(map(tuple, direct)))


def _over_run(symbol: str, count: int, after: Vector) -> Vector:
    for k in range(count.bit_length()):
        if count >> k & 1:
            after = _before(_power(symbol, k), after)
    return after


Runs = list[tuple[str, int]]


def collapse(symbols: Iterator[tuple[str, int]]) -> Runs:
    """Equal symbols in a row as one (symbol, count)."""
    return [(s, sum(n for _, n in same)) for s, same in groupby(symbols, key=lambda x: x[0])]


def runs_matrix(runs: Runs) -> Matrix:
    out = _UNIT
    for symbol, count in runs:
        for k in range(count.bit_length()):
            if count >> k & 1:
                out = _product(out, _power(symbol, k))
    return out


@lru_cache(maxsize=1 << 16)
def _choice(symbol: str, state: int, after: Vector) -> tuple[str, int, int]:
    """The first of the cheapest edits: initials up to and with the turn's own, cost, next state."""
    best = _before(_power(symbol, 0), after)
    said, paid = "", 0
    while True:
        left = best[state]
        take = {e: (cost, to) for e, cost, to in _edits(symbol, state) if cost + after[to] == left}
        if "D" in take or best[_WRITE[state]] + INSERT != left:
            initial = min(take)
            cost, to = take[initial]
            return said + initial, paid + cost, to
        said, paid, state = said + "I", paid + INSERT, _WRITE[state]


def _finish(state: int) -> tuple[str, int, int]:
    n = 0
    while state not in _DONE:
        state, n = _WRITE[state], n + 1
    return "I" * n, n * INSERT, state


def unroll(runs: Runs, after: Vector, state: int) -> tuple[list[str], int, int]:
    """The edits of each turn that need not go, the cost of all, and the state behind the last turn."""
    vectors = []
    for symbol, count in reversed(runs):
        vectors.append(after)
        after = _level(_over_run(symbol, count, after))
    out: list[str] = []
    cost = 0
    for (symbol, count), behind in zip(runs, reversed(vectors)):
        if symbol == _MUST_GO:  # deleting comes before inserting
            cost += DELETE * count
            continue
        inside = [_level(behind)]
        for _ in range(count - 1):
            inside.append(_level(_before(_power(symbol, 0), inside[-1])))
        for vector in reversed(inside):
            said, paid, state = _choice(symbol, state, vector)
            out.append(said)
            cost += paid
    return out, cost, state


def _level(vector: Vector) -> Vector:
    """Costs relative to the lowest: choices depend on no more, and few such vectors exist."""
    low = min(vector)
    return vector if low == 0 else tuple(v - low for v in vector)


class Turn(NamedTuple):
    turn: int | None
    role: str
    text: str
    symbol: str
    copies: int  # all but the first must go


def _initial(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "?"


def _symbols(turns: list[Turn]) -> Iterator[tuple[str, int]]:
    for t in turns:
        yield t.symbol, 1
        if t.copies > 1:
            yield _MUST_GO, t.copies - 1


def _applied(turns: list[Turn], edits: list[str], state: int, last: bool) -> tuple[str, list[str], list[str], int]:
    """Initials, roles and texts of the repaired turns, and the cost of what is inserted at the end."""
    initials: list[str] = []
    roles: list[str] = []
    texts: list[str] = []
    chosen = iter(edits)
    for t in turns:
        said = "" if t.symbol == _MUST_GO else next(chosen)
        for e in said:
            if e != "D":
                state = _KEEP[_initial(t.role)][state] if e == "K" else _WRITE[state]
                roles.append(t.role if e == "K" else _ROLE[state])
                texts.append("" if e == "I" else t.text)
        initials += (said, "D" * (t.copies - (1 if said else 0)))
    cost = 0
    if last:
        said, cost, _ = _finish(state)
        for _ in said:
            state = _WRITE[state]
            roles.append(_ROLE[state])
            texts.append("")
        initials.append(said)
    return "".join(initials), roles, texts, cost


_PIECE = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "piece", "pieces")]
    + [("edits", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "first_turn", "last_turn", "turns")]
)
_PIECE_SCHEMA = (
    "conv_id long, piece long, pieces long, edits string, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, cost long, first_turn long, last_turn long, turns long"
)


def _piece(turns: list[Turn], faults: list[str], after: Vector, state: int, last: bool, ahead: tuple[str | None, int | None]) -> dict:
    """A repaired stretch of turns with its counts; ``ahead`` are the initial and turn before it."""
    edits, cost, _ = unroll(collapse(_symbols(turns)), after, state)
    initials, roles, texts, end_cost = _applied(turns, edits, state, last)
    illegal, previous = 0, ahead[0]
    for t in turns:
        illegal += t.copies - 1 + int(previous is not None and previous + t.role[:1] not in _LEGAL)
        previous = t.role[:1]
    numbers = [t.turn for t in turns if t.turn is not None]
    distinct = len(set(numbers)) - int(bool(numbers) and numbers[0] == ahead[1])
    again = sum(t.copies - 1 for t, f in zip(turns, faults) if f != "blank")
    return {
        "edits": initials,
        "roles": roles,
        "texts": texts,
        "blank": sum(t.copies for t, f in zip(turns, faults) if f == "blank"),
        "duplicate": again + faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": illegal,
        "cost": cost + end_cost,
        "first_turn": min(numbers, default=None),
        "last_turn": max(numbers, default=None),
        "turns": distinct,
    }


def _symbol(role: str, fault: str) -> str:
    return _MUST_GO if fault in ("blank", "duplicate") else _initial(role) + ("t" if fault == "truncated" else "")


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 500 + sum(map(len, row["texts"]))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_PIECE)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=_PIECE)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[dict]]]:
    """The rows of each conversation; they come one after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for conv_id, same in groupby(rows, key=lambda r: r["conv_id"]):
        yield conv_id, [r for r in same if r["copies"] > 0]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def repaired() -> Iterator[dict]:
        for conv_id, rows in _conversations(batches):
            seen: set[tuple[str, str]] = set()
            turns, faults = [], []
            for r in rows:
                fault = r["fault"]
                if fault != "blank":
                    key = (r["role"], r["text"])
                    fault = "duplicate" if key in seen else fault
                    seen.add(key)
                faults.append(fault)
                turns.append(Turn(r["turn"], r["role"], r["text"], _symbol(r["role"], fault), r["copies"]))
            yield {"conv_id": conv_id, "piece": 0, "pieces": 1, **_piece(turns, faults, END, 0, True, (None, None))}

    return _batches(repaired())


def damage(conversations: DataFrame) -> DataFrame:
    """Faults dealt by the checksum of ``conv_id:turn``; ``copies`` is how often a row stands there then.

    Of 20 rows one is gone (0 copies), one empty, one without full stops, one doubled and one given to the user.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fate = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def _fault(text: Column) -> Column:
    """The fault of a text by itself."""
    end = F.rtrim(text, F.lit(_BLANKS))
    return F.when(end == "", "blank").when(F.substring(end, -1, 1).isin(".", "!", "?"), "").otherwise("truncated")


class Repaired(NamedTuple):
    """Repaired conversations in pieces: conv_id, piece (from 0), pieces (how many), edits, roles, texts and counts.

    Counts of pieces add up; ``turns`` counts turn numbers that the piece before does not end with.  ``whole``
    has the conversations of one piece, ``long`` the others, if there are any.
    """

    whole: DataFrame
    long: DataFrame | None

    def pieces(self) -> DataFrame:
        return self.whole if self.long is None else self.whole.unionByName(self.long)


def repair(turns: DataFrame) -> Repaired:
    """Repair conversations of conv_id, turn, role, text and, if it is there, ``copies``."""
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        (F.col("copies") if "copies" in turns.columns else F.lit(1)).cast("long").alias("copies"),
    )
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("bytes"))
    long = cut_lineage(sizes.where((F.col("n") > ROWS) | (F.col("bytes") > BYTES)).select("conv_id"))
    judged = rows.withColumn("fault", _fault(F.col("text")))
    if long.isEmpty():
        return Repaired(_repair_whole(judged), None)
    short = join_on(judged, long, ["conv_id"], "left_anti", null_safe=True)
    return Repaired(_repair_whole(short), _repair_blocks(join_on(judged, long, ["conv_id"], "left_semi", null_safe=True)))


def _repair_whole(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(textbytes.freeing(_whole), _PIECE_SCHEMA)


def _block_rows(table: pa.Table) -> list[dict]:
    return table.sort_by("line").to_pylist()


def _plain_turns(rows: list[dict]) -> list[Turn]:
    return [Turn(r["turn"], r["role"], r.get("text", ""), _symbol(r["role"], r["fault"]), r["copies"]) for r in rows]


def _measure(table: pa.Table) -> pa.Table:
    """A block's product of matrices, and what stands at its end."""
    rows = _block_rows(table)
    turns = _plain_turns(rows)
    numbers = [t.turn for t in turns if t.turn is not None]
    out = {
        "conv_id": rows[0]["conv_id"],
        "block": rows[0]["block"],
        "matrix": [c for line in runs_matrix(collapse(_symbols(turns))) for c in line],
        "initial": turns[-1].role[:1],
        "turn": numbers[-1] if numbers else None,
    }
    return pa.Table.from_pylist([out], schema=_MEASURE)


_MEASURE = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("matrix", pa.list_(pa.int64())), ("initial", pa.string()), ("turn", pa.int64())])


def _costs_behind(table: pa.Table) -> pa.Table:
    """Costs to the end behind each block of a conversation, and what stands ahead of it."""
    blocks = table.sort_by("block").to_pylist()
    after = END
    for b in reversed(blocks):
        b["after"] = list(_level(after))
        m = b["matrix"]
        after = _level(_before(tuple(tuple(m[4 * i : 4 * i + 4]) for i in _STATES), after))
    initial = turn = None
    for n, b in enumerate(blocks):
        b |= {"piece": n, "pieces": len(blocks), "ahead_initial": initial, "ahead_turn": turn}
        initial, turn = b["initial"], b["turn"] if b["turn"] is not None else turn
    return pa.Table.from_pylist(blocks, schema=_BEHIND)


_BEHIND = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "block", "piece", "pieces")]
    + [("after", pa.list_(pa.int64())), ("ahead_initial", pa.string()), ("ahead_turn", pa.int64())]
)


def _exits(table: pa.Table) -> pa.Table:
    """The state behind a block for each state ahead of it."""
    rows = _block_rows(table)
    runs = collapse(_symbols(_plain_turns(rows)))
    after = tuple(rows[0]["after"])
    out = {"conv_id": rows[0]["conv_id"], "block": rows[0]["block"], "exits": [unroll(runs, after, s)[2] for s in _STATES]}
    return pa.Table.from_pylist([out], schema=_EXITS)


_EXITS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("exits", pa.list_(pa.int64()))])


def _entries(table: pa.Table) -> pa.Table:
    blocks = table.sort_by("block").to_pylist()
    state = 0
    for b in blocks:
        b["state"] = state
        state = b["exits"][state]
    return pa.Table.from_pylist(blocks, schema=_ENTRIES)


_ENTRIES = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("state", pa.int64())])


def _repaired_block(table: pa.Table) -> pa.Table:
    rows = _block_rows(table)
    first = rows[0]
    last = first["piece"] + 1 == first["pieces"]
    out = _piece(_plain_turns(rows), [r["fault"] for r in rows], tuple(first["after"]), first["state"], last, (first["ahead_initial"], first["ahead_turn"]))
    return pa.Table.from_pylist([{k: first[k] for k in ("conv_id", "piece", "pieces")} | out], schema=_PIECE)


def _repair_blocks(rows: DataFrame) -> DataFrame:
    """Conversations of any length: nothing but one row per block is ever grouped by conversation."""
    same = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text", "fault").agg(F.sum("copies").alias("copies"))
    same = same.withColumn("said", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = same.groupBy("conv_id", "said").agg(F.min(place).alias("first"))
    judged = join_on(same, first, ["conv_id", "said"], "inner", null_safe=True)
    again = (F.col("fault") != "blank") & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    judged = judged.withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault"))).drop("first", "said")
    ordered = judged.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("line", F.monotonically_increasing_id())
    lines = cut_lineage(ordered.withColumn("block", F.shiftright("line", BLOCK_BITS)))

    key = ["conv_id", "block"]
    small = lines.drop("text")
    measures = small.groupBy(*key).applyInArrow(_measure, "conv_id long, block long, matrix array<long>, initial string, turn long")
    behind_schema = "conv_id long, block long, piece long, pieces long, after array<long>, ahead_initial string, ahead_turn long"
    behind = cut_lineage(measures.groupBy("conv_id").applyInArrow(_costs_behind, behind_schema))
    known = join_on(small, behind.select(*key, "after"), key, "inner", null_safe=True)
    exits = known.groupBy(*key).applyInArrow(_exits, "conv_id long, block long, exits array<long>")
    entries = exits.groupBy("conv_id").applyInArrow(_entries, "conv_id long, block long, state long")
    plan = cut_lineage(join_on(behind, entries, key, "inner", null_safe=True))
    return join_on(lines, plan, key, "inner", null_safe=True).groupBy(*key).applyInArrow(_repaired_block, _PIECE_SCHEMA)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row per conversation; a piece is let go when it has been hashed."""
    rows = (row for batch in batches for row in batch.to_pylist())
    out = []
    for conv_id, pieces in groupby(rows, key=lambda r: r["conv_id"]):
        digest, begun = hashlib.sha256(), False
        audit, total = [], dict.fromkeys(_COUNTS, 0)
        low = high = None
        turns = 0
        for p in pieces:
            if p["said"] is not None:
                digest.update((("\n" if begun else "") + p["said"]).encode())
                begun = True
            audit.append(p["edits"])
            for c in _COUNTS:
                total[c] += p[c]
            if p["first_turn"] is not None:
                low = p["first_turn"] if low is None else min(low, p["first_turn"])
                high = p["last_turn"] if high is None else max(high, p["last_turn"])
            turns += p["turns"]
        gaps = 0 if low is None else high - low + 1 - turns
        out.append({"conv_id": conv_id, "gaps": gaps, **total, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
    schema = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", *_COUNTS)] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def summarise(repaired: Repaired) -> DataFrame:
    """One row per conversation: gaps in its turn numbers, counts of faults, cost, audit and the repaired text's SHA-256."""
    said = F.array_join(F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n")
    whole = repaired.whole.select(
        "conv_id",
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *_COUNTS,
        F.col("edits").alias("audit"),
        F.sha2(said, 256).alias("repaired_sha256"),
    )
    if repaired.long is None:
        return whole
    said = F.when(F.size("roles") > 0, said).alias("said")
    rows = repaired.long.select("conv_id", "piece", "edits", said, *_COUNTS, "first_turn", "last_turn", "turns")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(ordered.mapInArrow(textbytes.freeing(_stream), _SUMMARY))
