"""Repair of damaged conversations by a cheapest path through an edit lattice.

A node of the lattice is (rows read, state of the role grammar ``(s?(ua)+)?``). Edits are its
edges: keep (0), rerole to user or assistant (1), delete (2), insert an empty turn (5); a
truncated row that stays adds 5, a blank or repeated one must go. In a state only one of user
and assistant may follow, so an audit (the initials of the edits) names one path.

Bidirectional Dijkstra finds the path: a forward heap by (cost, audit) from the first row, a
reverse heap by (cost, rows left) from the accepting ends. When the heaps' tops together exceed the
best crossing, every equal-cost path has been crossed on some edge, and the least
concatenated audit is taken. Two audits of one cost between the same nodes are never a prefix of one
another (the longer one would hold inserts, which cost), so the least prefix and the least
suffix of a crossing make its least audit.

Rows of a conversation reach a task sorted and as a stream. Beyond ``SEGMENT_ROWS`` rows, or
``SEGMENT_BYTES`` of text, a segment is reduced to its cheapest paths between grammar states and
only these labels are carried on, so a task never holds a whole conversation. The digest of a
repaired conversation is one chain over its text, which no number of tasks would shorten.

* Null roles and texts count as one space. Rows of one turn are ordered by role and text, so
  repeated rows stand side by side; null turns come first. A null conv_id is a conversation.
* A role's initial is its first letter; an empty role has none and fits nowhere.
* Empty tables give empty results. Columns beyond the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
INSERT, RENAME, DROP, CUT = 5, 1, 2, 5
SEGMENT_ROWS = 2048
SEGMENT_BYTES = 8 << 20
REMEMBERED = 1 << 16
# No grammar state is worth more than this against another: delete a leading system turn
# and insert two turns. Labels further above the cheapest one cannot win.
STATE_WORTH = DROP + 2 * INSERT

# Grammar states: nothing yet, after s, after u, after a. NEXT is where the one fitting role
# of {user, assistant} leads; AFTER is where a kept row with this initial leads.
NEXT = (2, 2, 3, 2)
BEFORE = ((), (), (0, 1, 3), (2,))
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS = (0, 3)
NAMES = {2: "user", 3: "assistant"}

# What is wrong with a row, as a number for each row of the stream.
FINE, BLANK, AGAIN, SHORT, GONE = range(5)
_GRAVE = (BLANK, AGAIN)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage rows by ``crc32(conv:turn) % 20``; adds ``gone``, true for dropped rows.

    0 drops the row, 1 empties its text, 2 takes out its stops, 3 repeats it, 4 makes its role
    user. Nulls count as one space.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(plain(role)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(plain(text), ".!?", "")).otherwise(plain(text)).alias("text"),
        F.explode(F.array_repeat(kind == 0, F.when(kind == 3, 2).otherwise(1))).alias("gone"),
    )


def _edges(codes: str, i: int, state: int, open_end: bool) -> Iterator[tuple[int, int, int, str]]:
    """Edges that leave a node: row, state, cost, initial."""
    if i < len(codes):
        yield i + 1, state, DROP, "D"
        extra = _extra(codes[i])
        if extra >= 0:
            kept = AFTER.get(codes[i].lower(), {}).get(state)
            if kept is not None:
                yield i + 1, kept, extra, "K"
            yield i + 1, NEXT[state], extra + RENAME, "R"
    if open_end or i < len(codes):
        yield i, NEXT[state], INSERT, "I"


def _edges_back(codes: str, i: int, state: int, open_end: bool) -> Iterator[tuple[int, int, int, str]]:
    """Edges that enter a node: row and state they come from, cost, initial."""
    if i:
        yield i - 1, state, DROP, "D"
        extra = _extra(codes[i - 1])
        if extra >= 0:
            for before, kept in AFTER.get(codes[i - 1].lower(), {}).items():
                if kept == state:
                    yield i - 1, before, extra, "K"
            for before in BEFORE[state]:
                yield i - 1, before, extra + RENAME, "R"
    if open_end or i < len(codes):
        for before in BEFORE[state]:
            yield i, before, INSERT, "I"


def _extra(code: str) -> int:
    """What it costs that a row stays: -1 where it may not, more where it is cut short."""
    return -1 if code == "!" else CUT if code.isupper() else 0


def cheapest(codes: str, first: int, lasts: tuple[int, ...], open_end: bool) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest paths from state ``first`` to one of ``lasts``.

    A code is a row: its initial (x: none that fits), in capitals if cut short, or ``!`` if
    it must go. Without ``open_end`` nothing is inserted behind the last row.
    """
    rows = len(codes)
    ahead: dict[tuple[int, int], tuple[int, str]] = {}
    behind: dict[tuple[int, int], tuple[int, str]] = {}
    reached = {(rows, state): (0, "") for state in lasts}  # labels of the reverse search, settled or not
    forward = [(0, "", 0, first)]
    reverse = [(0, 0, rows, state) for state in lasts]
    best = (0, "") if rows == 0 and first in lasts else None

    def cross(cost: int, audit: str) -> None:
        nonlocal best
        if best is None or (cost, audit) < best:
            best = cost, audit

    while forward and reverse and (best is None or forward[0][0] + reverse[0][0] <= best[0]):
        # The ends come first, so that either heap may run dry.
        if len(behind) >= len(lasts) and len(forward) <= len(reverse):
            cost, audit, i, state = heappop(forward)
            if (i, state) in ahead:
                continue
            ahead[i, state] = cost, audit
            for j, then, more, initial in _edges(codes, i, state, open_end):
                if (j, then) in behind:
                    rest = behind[j, then]
                    cross(cost + more + rest[0], audit + initial + rest[1])
                if (j, then) not in ahead:
                    heappush(forward, (cost + more, audit + initial, j, then))
        else:
            cost, _, i, state = heappop(reverse)
            if (i, state) in behind:
                continue
            _, audit = behind[i, state] = reached[i, state]
            for j, then, more, initial in _edges_back(codes, i, state, open_end):
                if (j, then) in ahead:
                    start = ahead[j, then]
                    cross(start[0] + more + cost, start[1] + initial + audit)
                label = cost + more, initial + audit
                if (j, then) not in behind and label < reached.get((j, then), (label[0] + 1,)):
                    reached[j, then] = label
                    heappush(reverse, (label[0], rows - j, j, then))
    return best


class _Path:
    """A cheapest way to one grammar state at the end of a segment."""

    def __init__(self) -> None:
        self.cost, self.audit, self.digest, self.empty = 0, "", hashlib.sha256(), True

    def longer(self, cost: int, audit: str, state: int, rows: list[tuple[str, str]]) -> _Path:
        path = _Path()
        path.cost, path.audit = self.cost + cost, self.audit + audit
        path.digest, path.empty = self.digest.copy(), self.empty
        lines = [f"{role}:{text}" for _, role, text in edited(audit, state, rows)]
        if lines:
            path.digest.update(("" if path.empty else "\n").encode() + "\n".join(lines).encode())
            path.empty = False
        return path


def edited(audit: str, state: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of the turns that an audit leaves, from this grammar state on."""
    waiting = iter(rows)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield edit, NAMES[state], ""
            continue
        role, text = next(waiting)
        if edit == "K":
            state = AFTER[role[0]][state]
            yield edit, role, text
        elif edit == "R":
            state = NEXT[state]
            yield edit, NAMES[state], text


class _Conversation:
    """What a task keeps of the conversation it is reading."""

    def __init__(self, cheapest: Callable = cheapest) -> None:
        self.cheapest = cheapest
        self.paths = {0: _Path()}
        self.rows: list[tuple[str, str]] = []
        self.codes: list[str] = []
        self.size = 0
        self.counts = [0] * 5
        self.illegal = self.turns = 0
        self.before = self.first = self.last = None

    def add(self, turn: int | None, fault: int, role: str, text: str) -> None:
        if fault == GONE:
            return
        initial = role[:1]
        self.counts[fault] += 1
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        code = initial if initial in AFTER else "x"
        self.codes.append("!" if fault in _GRAVE else code.upper() if fault == SHORT else code)
        self.rows.append((role, text))
        self.size += len(text)
        if len(self.rows) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES:
            self.advance()

    def advance(self) -> None:
        """Reduce the rows at hand to one path for each state that may still win."""
        codes = "".join(self.codes)
        best: dict[int, tuple] = {}
        for state, path in self.paths.items():
            for then in range(4):
                found = self.cheapest(codes, state, (then,), False) if then >= min(state, 2) else None
                if found:
                    label = path.cost + found[0], path.audit + found[1], state, found
                    best[then] = min(best.get(then, label), label)
        limit = min(label[0] for label in best.values()) + STATE_WORTH
        self.paths = {
            then: self.paths[state].longer(*found, state, self.rows)
            for then, (cost, _, state, found) in best.items()
            if cost <= limit
        }
        self.rows, self.codes, self.size = [], [], 0

    def finish(self) -> tuple[int, ...]:
        codes = "".join(self.codes)
        labels = []
        for state, path in self.paths.items():
            found = self.cheapest(codes, state, ENDS, True)
            labels.append((path.cost + found[0], path.audit + found[1], state, found))
        _, _, state, found = min(labels)
        path = self.paths[state].longer(*found, state, self.rows)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (
            min(gaps, (1 << 63) - 1),
            self.counts[BLANK],
            self.counts[AGAIN],
            self.counts[SHORT],
            self.illegal,
            path.cost,
            path.audit,
            path.digest.hexdigest(),
        )


REPAIRED = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_NAMES = [part.split()[0] for part in REPAIRED.split(", ")]


def _listed(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """Rows by conversation and in order, each with its first fault."""
    listed = rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(F.col("gone"), GONE)
        .when(bare == "", BLANK)
        .when(F.row_number().over(same) > 1, AGAIN)
        .when(~F.right(bare, F.lit(1)).isin(*".!?"), SHORT)
        .otherwise(FINE)
    )
    # Both orders lie within the one exchange by conversation.
    return listed.select("conv_id", "turn", fault.alias("fault"), "role", "text").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
    )


def repair_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: Column | None = None,
) -> DataFrame:
    """One row for each conversation: what is wrong with it, the cheapest edits, a digest.

    Columns: conv_id, gaps (turn numbers missing), rows that are blank, duplicate and
    truncated by their first fault, illegal (neighbours whose roles do not follow), cost, audit,
    repaired_sha256 (of ``role:text`` lines). ``gone`` marks rows that only name their
    conversation.
    """
    ordered = _listed(rows, conv, turn, role, text, gone)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv, current = None, None
        # Many conversations have the same roles and faults.
        known = lru_cache(maxsize=REMEMBERED)(cheapest)
        for batch in batches:
            done, found = [], []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for ident, place, fault, name, words in zip(*columns, strict=True):
                if current is None or ident != open_conv:
                    if current is not None:
                        done.append(open_conv)
                        found.append(current.finish())
                    open_conv, current = ident, _Conversation(known)
                current.add(place, fault, name, words)
            if done:
                yield _as_batch(done, found, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if current is not None:
            yield _as_batch([open_conv], [current.finish()], kind)

    kind = ordered.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(repair, f"conv_id {kind}, {REPAIRED}")


def _as_batch(ids: list, found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    whole = {"conv_id": pa.array(ids, kind)}
    for name, values in zip(_NAMES, zip(*found, strict=True), strict=True):
        whole[name] = pa.array(values, pa.string() if name in ("audit", "repaired_sha256") else pa.int64())
    return pa.record_batch(whole)


def repaired_turns(
    rows: DataFrame,
    repaired: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: Column | None = None,
) -> DataFrame:
    """The turns that the audits of ``repair_conversations`` leave, one row each.

    Columns: conv_id, place (from 0), edit, turn (null where inserted), role, text. An audit
    arrives ahead of its rows, which pass as a stream.
    """
    listed = _listed(rows, conv, turn, role, text, gone).where(F.col("fault") != GONE)
    audits = repaired.select("conv_id", F.col("audit").alias("text"))
    both = listed.withColumn("head", F.lit(1)).unionByName(audits.withColumn("head", F.lit(0)), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "head", F.asc_nulls_first("turn"), "role", "text"
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, 0, 0
        ident = None
        for batch in batches:
            out: list[tuple] = []
            kind = batch.schema.field(0).type

            def inserted() -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    state = NEXT[state]
                    out.append((ident, place, "I", None, NAMES[state], ""))
                    at, place = at + 1, place + 1

            columns = [batch.column(name).to_pylist() for name in ("conv_id", "head", "turn", "role", "text")]
            for key, head, number, name, words in zip(*columns, strict=True):
                if head == 0:
                    ident, audit, at, state, place = key, words, 0, 0, 0
                    inserted()
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = AFTER[name[0]][state] if edit == "K" else NEXT[state]
                    out.append((ident, place, edit, number, name if edit == "K" else NAMES[state], words))
                    place += 1
                inserted()
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            names = ["conv_id", "place", "edit", "turn", "role", "text"]
            values = list(zip(*out, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    kind = both.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(apply, f"conv_id {kind}, place long, edit string, turn long, role string, text string")
