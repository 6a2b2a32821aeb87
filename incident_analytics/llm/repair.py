"""Repair of the role structure of conversations at the least cost, proved by branch and bound.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`: nothing, or an optional system row and
then pairs of user and assistant. Rows are kept (K, cost 0), given the role user or assistant (R, 2) or deleted (D, 3; the only
way with blank and repeated rows), and rows without text are inserted (I, 2). A row whose text breaks off costs 1 more
unless it is deleted. Of the cheapest edits those win whose initials, read as text, come first.

A depth-first search with an explicit stack looks for them. It leaves a prefix that can't beat the incumbent's (cost,
audit) by the least cost of what is left, and one that reached the same node worse than an earlier prefix
did. A conversation is solved in pieces of at most `PIECE` rows, so none is ever in one task as a whole: where a piece
may go on, it is solved for each state before and behind it, and the states are chosen by the sums of costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.shared import ship, stored

#: Rows of a piece.
PIECE = 64
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: What `_kind` says of a row: initial of the role in two bits, blank text, text that breaks off.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
BLANK, BROKEN = 4, 8
#: States of the role sequence: nothing yet, after a system, a user, an assistant row.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
#: State after a role, by state before; a missing role is not allowed there.
NEXT = (
    {SYSTEM: AFTER_S, USER: AFTER_U},
    {USER: AFTER_U},
    {ASSISTANT: AFTER_A},
    {USER: AFTER_U},
)
#: The role that is inserted or given in each state, and what completes a sequence that ends there.
GIVEN = (USER, USER, ASSISTANT, USER)
TAIL = (0, 2, 1, 0)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: No path. Small enough to add up.
NEVER = 1 << 60

Row = tuple[int, bool, int]


def legal(before: int, after: int) -> bool:
    """Whether roles with these initials may be neighbours: su, ua, au."""
    return (before, after) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def bounds(rows: list[Row]) -> list[int]:
    """At each row a cost that no repair of it and the rows behind it can be below.

    Each row costs what it must by itself; of the neighbours that may not stand together, one of each pair
    of a set of disjoint pairs costs one edit more.
    """
    out, base, pairs = [0], 0, [0, 0]
    behind = None
    for kind, first, copies in reversed(rows):
        initial, free = kind & 3, first and not kind & BLANK
        base += DELETE * (copies - free)
        if free:
            broken = CUT if kind & BROKEN else 0
            base += broken if initial != OTHER else min(REROLE + broken, DELETE)
            clash = initial != OTHER and behind is not None and behind != OTHER and not legal(initial, behind)
            pairs = [max(pairs[0], 1 + pairs[1]) if clash else pairs[0], pairs[0]]
            behind = initial
        out.append(base + INSERT * pairs[0])
    return out[::-1]


def solve(rows: list[Row], start: int = START, goal: int | None = None) -> tuple[int, str]:
    """Cost and audit of the best repair of `rows` (kind, first of its kind, copies) from the state `start`.

    Without `goal` the sequence is completed; with it, it ends in that state right behind the last row. NEVER if
    there is no such repair. Copies behind the first are deleted, and so are all if the row stood earlier.
    """
    least, n = bounds(rows), len(rows)
    best, audit = NEVER, ""
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, done = stack.pop()
        bound = cost + least[i]
        if bound > best or (bound == best and done > audit[: len(done)]):
            continue
        known = reached.get((i, state))
        if known is not None and known <= (cost, done):
            continue
        reached[i, state] = (cost, done)
        if i == n:
            if goal is None:
                cost, done = cost + INSERT * TAIL[state], done + "I" * TAIL[state]
            elif state != goal:
                continue
            if (cost, done) < (best, audit):
                best, audit = cost, done
            continue
        kind, first, copies = rows[i]
        given = GIVEN[state]
        moves = []
        if first and not kind & BLANK:
            rest, more = DELETE * (copies - 1), "D" * (copies - 1)
            broken = CUT if kind & BROKEN else 0
            if kind & 3 in NEXT[state]:
                moves.append((i + 1, NEXT[state][kind & 3], cost + KEEP + broken + rest, f"{done}K{more}"))
            moves.append((i + 1, NEXT[state][given], cost + REROLE + broken + rest, f"{done}R{more}"))
            moves.append((i + 1, state, cost + DELETE + rest, f"{done}D{more}"))
            moves.append((i, NEXT[state][given], cost + INSERT, f"{done}I"))
        else:
            # An insertion may as well stand behind rows that have to go, where its initial sorts better.
            moves.append((i + 1, state, cost + DELETE * copies, done + "D" * copies))
        # The most promising move is on top of the stack.
        moves.sort(key=lambda m: (m[2] + least[m[0]], m[3]), reverse=True)
        stack.extend(moves)
    return best, audit


def _kind(role: Column, text: Column) -> Column:
    solid = F.rtrim(text, F.lit(" \t\n\x0b\f\r"))
    initial = F.substring(role, 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when(solid == "", BLANK).when(F.substring(solid, -1, 1).isin(".", "!", "?"), 0).otherwise(BROKEN)
    return code + fault


def _digest(*fields: Column) -> Column:
    """Binary SHA-256 of fields, whose lengths keep them apart; null differs from all values."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


_NUMBERS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = (
    "conv_id long, part int, seq long, whole boolean, costs array<long>, audits array<string>, kinds array<int>, firsts array<boolean>, "
    "copies array<long>, marks array<binary>, first_turn long, last_turn long, lowest long, highest long, blank long, duplicate long, truncated long, illegal long, turns long"
)


class _Piece:
    """Rows of one conversation that stand together."""

    def __init__(self) -> None:
        self.rows: list[Row] = []
        self.turns: list[int | None] = []
        self.marks: list[bytes] = []

    def add(self, turn: int | None, kind: int, first: bool, copies: int, mark: bytes) -> None:
        self.rows.append((kind, first, copies))
        self.turns.append(turn)
        self.marks.append(mark)

    def faults(self) -> dict[str, int]:
        out = dict.fromkeys(_NUMBERS, 0)
        for kind, first, copies in self.rows:
            if kind & BLANK:
                out["blank"] += copies
            else:
                out["duplicate"] += copies - first
                out["truncated"] += bool(first and kind & BROKEN)
            # Copies stand side by side with the same initial.
            out["illegal"] += copies - 1
        out["illegal"] += sum(not legal(a[0] & 3, b[0] & 3) for a, b in pairwise(self.rows))
        out["turns"] = len({t for t in self.turns if t is not None})
        return out

    def row(self, key: int | None, part: int, seq: int, whole: bool) -> dict[str, object]:
        if whole:
            found = [solve(self.rows)]
        else:
            found = [solve(self.rows, a, b) for a in range(STATES) for b in range(STATES)]
        known = [t for t in self.turns if t is not None]
        return {
            "conv_id": key, "part": part, "seq": seq, "whole": whole,
            "costs": [c for c, _ in found], "audits": [a for _, a in found],
            "kinds": [r[0] for r in self.rows], "firsts": [r[1] for r in self.rows], "copies": [r[2] for r in self.rows], "marks": self.marks,
            "first_turn": self.turns[0], "last_turn": self.turns[-1], "lowest": min(known, default=None), "highest": max(known, default=None), **self.faults(),
        }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows of a partition. A conversation in the middle of it that fits into a piece is whole."""
    schema = _schema(_PIECE)
    piece, key, part, seq, begun, cut = _Piece(), None, 0, 0, False, True
    out: list[dict[str, object]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "conv_id", "turn", "kind", "first", "copies", "mark"))
        for part, conv, turn, kind, first, copies, mark in zip(*columns, strict=True):
            if begun and (conv != key or len(piece.rows) == PIECE):
                # The first conversation of a partition may have begun in another one.
                out.append(piece.row(key, part, seq, not cut and conv != key))
                cut = conv == key
                piece, seq = _Piece(), seq + 1
            key, begun = conv, True
            piece.add(turn, kind, first, copies, mark)
            if len(out) >= 256:
                yield from flush()
    if begun:
        out.append(piece.row(key, part, seq, False))
    yield from flush()


def _schema(shape: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = []
    for field in shape.split(", "):
        name, kind = field.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append((name, pa.list_(kinds[inner]) if inner != kind else kinds[kind]))
    return pa.schema(fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)


_CHOSEN = "part int, seq long, state int, end int, tail int, joined int, shared int"


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before and behind each piece of a conversation that are on its best path."""
    for batch in batches:
        out = []
        for pieces in batch.column("pieces").to_pylist():
            ahead = [[NEVER] * STATES for _ in pieces] + [[INSERT * TAIL[s] for s in range(STATES)]]
            for i in range(len(pieces) - 1, -1, -1):
                costs = pieces[i]["costs"]
                ahead[i] = [min(costs[a * STATES + b] + ahead[i + 1][b] for b in range(STATES)) for a in range(STATES)]
            state, before = START, None
            for i, p in enumerate(pieces):
                ways = range(state * STATES, state * STATES + STATES)
                # Audits of one state never begin with one another, so the first that differs decides.
                end = min(ways, key=lambda w: (p["costs"][w] + ahead[i + 1][w % STATES], p["order"][w])) % STATES
                joined = before is not None and not legal(before["last_kind"] & 3, p["first_kind"] & 3)
                same = before is not None and p["first_turn"] is not None and before["last_turn"] == p["first_turn"]
                out.append((p["part"], p["seq"], state, end, TAIL[end] if i == len(pieces) - 1 else 0, int(joined), int(same)))
                state, before = end, p
        yield _batch(out, _schema(_CHOSEN))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the repaired conversations: place, digest of the row (null: inserted), role given (null: as it was)."""
    schema = _schema("conv_id long, part int, seq long, line long, mark binary, given string")
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "part", "seq", "state", "audit", "kinds", "copies", "marks"))
        for key, part, seq, state, audit, kinds, copies, marks in zip(*columns, strict=True):
            i, used, line = 0, 0, 0
            for edit in audit:
                mark, given = None, None
                if edit != "I":
                    kind, mark = kinds[i], marks[i]
                    used += 1
                    if used == copies[i]:
                        i, used = i + 1, 0
                if edit == "D":
                    continue
                role = kind & 3 if edit == "K" else GIVEN[state]
                given = None if edit == "K" else NAMES[role]
                state = NEXT[state][role]
                out.append((key, part, seq, line, mark, given))
                line += 1
        yield _batch(out, schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order; only a digest's state is held."""
    key, state = None, None
    schema = _schema("key long, repaired_sha256 string")
    for batch in batches:
        out = []
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line_text").to_pylist(), strict=True):
            if state is not None and conv == key:
                state.update(b"\n")
            else:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = conv, sha256()
            state.update(line.encode())
        yield _batch(out, schema)
    if state is not None:
        yield _batch([(key, state.hexdigest())], schema)


def mark_of() -> Column:
    """The digest that names a row: equal rows of a conversation are copies."""
    return _digest(F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))


def _order(audits: Column, way: int) -> Column:
    """How many audits of the same state before a piece sort before that of `way`."""
    same = F.slice(audits, way // STATES * STATES + 1, STATES)
    return F.size(F.filter(same, lambda a: a < audits[way]))


def _solved(rows: DataFrame) -> DataFrame:
    """The solved pieces, stored: place (conv_id, part, seq), state before, cost, audit, faults, turns and rows of each."""
    said = _digest(F.col("conv_id"), F.col("role"), F.col("text")).alias("said")
    slim = rows.select("conv_id", "turn", _kind(F.col("role"), F.col("text")).alias("kind"), said, mark_of().alias("mark"), "times")
    slim = stored(slim.groupBy("conv_id", "turn", "kind", "said", "mark").agg(F.sum("times").cast("long").alias("copies")))
    # Of the rows that say the same in a conversation the first one counts; it may stand in another piece.
    earliest = slim.groupBy("said").agg(F.min(F.struct("turn", "mark")).alias("at")).select(F.col("at.mark").alias("_mark"))
    first = F.col("_mark").isNotNull().alias("first")
    flagged = stored(slim.join(earliest, slim.mark == earliest._mark, "left").select("conv_id", "turn", "kind", first, "copies", "mark"))
    ordered = flagged.repartitionByRange("conv_id", "turn", "mark").sortWithinPartitions("conv_id", "turn", "mark")
    pieces = stored(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_pieces, _PIECE))

    parts = pieces.filter("not whole")
    # Only numbers of a piece go to the choice of states. The order of audits is that among those of one state before.
    among = [_order(F.col("audits"), i) for i in range(STATES**2)]
    edges = [F.col("kinds")[0].alias("first_kind"), F.element_at("kinds", -1).alias("last_kind"), F.col("first_turn"), F.col("last_turn")]
    summary = F.struct("part", "seq", "costs", F.array(*among).alias("order"), *edges)
    chosen = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(summary)).alias("pieces")).mapInArrow(_choices, _CHOSEN)
    at = (F.col("state") * STATES + F.col("end")).cast("int")
    kept = [*_NUMBERS, "lowest", "highest", "kinds", "copies", "marks"]
    ends = parts.join(chosen, ["part", "seq"]).withColumns({"illegal": F.col("illegal") + F.col("joined"), "turns": F.col("turns") - F.col("shared")})
    cut = ends.select(
        "conv_id", "part", "seq", "state", (F.col("costs")[at] + INSERT * F.col("tail")).alias("cost"),
        F.concat(F.col("audits")[at], F.repeat(F.lit("I"), F.col("tail"))).alias("audit"), *kept,
    )
    whole = pieces.filter("whole").select(
        "conv_id", "part", "seq", F.lit(START).alias("state"), F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), *kept
    )
    return stored(whole.unionByName(cut))


@dataclass
class Repair:
    """What a repair gives.

    `conversations`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    `lines`: the repaired rows: conv_id, part, seq, line (their order), role, text; inserted ones have empty text.
    """

    conversations: DataFrame
    lines: DataFrame

    def digests(self) -> DataFrame:
        """key (the conv_id) and SHA-256 of the repaired `role:text` lines of each conversation that has any."""
        said = self.lines.select("conv_id", "part", "seq", "line", F.concat("role", F.lit(":"), "text").alias("line_text"))
        # A digest runs over all lines of a conversation, so they stream through one task; none holds them.
        ordered = said.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "line")
        return ordered.select("conv_id", "line_text").mapInArrow(_digests, "key long, repaired_sha256 string")


def repaired(rows: DataFrame) -> Repair:
    """Repairs conversations of rows conv_id (long), turn (long), role, text and times (how often the row stands there).

    Rows of a conversation go by turn, null first; different rows of one turn by their SHA-256. Null role or text
    is one space; null conv_id is a conversation like any other. Equal rows are copies side by side, of which the first may
    stay. Other columns are not read. No rows: no conversations.
    """
    ship(rows.sparkSession)
    space = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *space, F.col("times").cast("long"))
    pieces = _solved(rows)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))), lambda p: p["audit"])
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    ends = [F.min("lowest").alias("low"), F.max("highest").alias("high"), F.sum("turns").alias("turns")]
    # Turns may be any longs: their distance is held to the largest one.
    wide = F.col("high").cast("decimal(20, 0)") - F.col("low") + 1 - F.col("turns")
    gaps = F.least(F.coalesce(wide, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps")
    found = pieces.groupBy("conv_id").agg(*sums, *ends, F.array_join(in_order, "").alias("audit"))
    whole = found.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    lines = pieces.mapInArrow(_lines, "conv_id long, part int, seq long, line long, mark binary, given string")
    texts = rows.select(mark_of().alias("_mark"), F.col("role").alias("_role"), "text").dropDuplicates(["_mark"])
    with_text = lines.join(texts, lines.mark == texts._mark, "left").select(
        "conv_id", "part", "seq", "line", F.coalesce("given", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return Repair(whole, with_text)
