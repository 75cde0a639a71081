"""Conversation structure repair by Wagner-Fischer alignment to an alternating grammar.

A sound conversation has role initials ``(s?(ua)+)?``. For every feasible length that grammar has exactly one string, so a
repair aligns the turns to such a string: keep, rerole, delete, insert. Counted from its end, the string is the same for
every length, so one Wagner-Fischer table of costs-to-go holds all lengths without ``s``; a length with ``s`` keeps one
turn as ``s``, deletes what stands before it and goes on in the same table. A plain repair gives an incumbent cost, which
bounds the deletions and insertions, and with them the band of the table that is filled (Ukkonen). Each length of least
cost is traced back to its ASCII-least audit, and the audits are compared.

Turns are shuffled once by conversation, sorted, and stream through a task in order. A conversation's turns wait in a
file of the task once they exceed ``HELD_BYTES``; a table beyond ``TABLE_CELLS`` is folded by the parity of the remaining
length, which is the same recurrence over all lengths at once, in memory linear in the number of turns.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits, and what an undeleted truncated turn adds.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANK_CHARS = " \t\n\x0b\x0c\r"

# Kinds of role initials and faults as they travel to the tasks.
S, U, A, OTHER = range(4)
SOUND, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
NAMES = {U: "user", A: "assistant"}

#: Bytes of one conversation's turns that a task holds before they go to a file.
HELD_BYTES = 32 << 20
#: Cells of the banded table; beyond, lengths are folded by parity.
TABLE_CELLS = 4 << 20
#: Turns turned into Python values at a time.
SLICE_ROWS = 256
_FAR = 1 << 30
_OUT_ROWS = 2_000


def incumbent(roles: list[int], faults: list[int]) -> int:
    """The cost of a plain valid repair: turns that do not alternate get a partner, foreign ones another role."""
    cost, due, kept, started = 0, U, 0, False
    for role, fault in zip(roles, faults):
        if fault in (IS_BLANK, IS_DUPLICATE):
            cost += DELETE
            continue
        cost += TRUNCATED * (fault == IS_TRUNCATED)
        if role == S and not started:
            started = True
            continue
        started = True
        if role == due:
            due = U + A - due
        elif role in NAMES:
            cost += INSERT
            kept += 1
        else:
            cost += REROLE
            due = U + A - due
        kept += 1
    if due == A:
        cost += INSERT
    elif started and not kept:
        cost += 2 * INSERT
    return cost


def _turn_costs(roles: list[int], faults: list[int]) -> np.ndarray:
    """Per turn the cost of standing as ``u`` and as ``a``; infinite where it must go."""
    role, fault = np.array(roles, np.int64), np.array(faults, np.int64)
    stay = np.where(fault == IS_TRUNCATED, TRUNCATED, 0)
    must_go = (fault == IS_BLANK) | (fault == IS_DUPLICATE)
    return np.stack([np.where(must_go, _FAR, stay + np.where(role == to, 0, REROLE)) for to in (U, A)], axis=1)


class Table:
    """Costs to go: ``at(i, r)`` repairs the turns from ``i`` on into the last ``r`` places of the target."""

    def __init__(self, costs: np.ndarray, most: int):
        self.n, self.below, self.above = len(costs), most // DELETE, most // INSERT
        width = self.below + self.above + 1
        self.cells = np.full((self.n + 1, width), _FAR, np.int64)
        for i in range(self.n, -1, -1):
            # column c stands for r = (n - i) + c - below remaining places
            left = np.arange(width) + (self.n - i - self.below)
            if i == self.n:
                best = np.where(left == 0, 0, _FAR)
            else:
                after = self.cells[i + 1]
                deleted = np.append(after[1:], _FAR) + DELETE
                stands = after + np.where(left % 2 == 1, costs[i, 1], costs[i, 0])
                best = np.where(left >= 1, np.minimum(deleted, stands), np.where(left == 0, deleted, _FAR))
            best = np.minimum.accumulate(best - INSERT * left) + INSERT * left
            self.cells[i] = np.where(left < 0, _FAR, np.minimum(best, _FAR))

    def at(self, i: int, r: int) -> int:
        c = r - (self.n - i) + self.below
        return int(self.cells[i, c]) if 0 <= c < self.cells.shape[1] and i <= self.n else _FAR

    def lengths(self, i: int) -> Iterator[int]:
        """Even remaining lengths inside the band."""
        start = max(0, self.n - i - self.below)
        return range(start + start % 2, self.n - i + self.above + 1, 2)

    def audit(self, i: int, r: int, roles: list[int], costs: np.ndarray) -> str:
        """The ASCII-least of the cheapest audits: at each step the first letter that keeps to the cost."""
        out = []
        while i < self.n or r:
            now = self.at(i, r)
            if i < self.n and self.at(i + 1, r) + DELETE == now:
                out.append("D")
                i += 1
            elif r and self.at(i, r - 1) + INSERT == now:
                out.append("I")
                r -= 1
            else:
                out.append("K" if roles[i] == (A if r % 2 else U) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def aligned(roles: list[int], faults: list[int], most: int) -> tuple[int, str]:
    """Cost and audit of the best repair of cost ``most`` or less, over every feasible length of the target."""
    costs = _turn_costs(roles, faults)
    table = Table(costs, most)
    # (cost, turns deleted before a kept s, or -1 without s, remaining length)
    found = [(table.at(0, r), -1, r) for r in table.lengths(0)]
    for p in range(min(table.n, most // DELETE + 1)):
        if roles[p] == S and faults[p] in (SOUND, IS_TRUNCATED):
            before = p * DELETE + TRUNCATED * (faults[p] == IS_TRUNCATED)
            found += [(before + table.at(p + 1, r), p, r) for r in table.lengths(p + 1) if r >= 2]
    least = min(cost for cost, _, _ in found)
    audits = (
        table.audit(0, r, roles, costs) if p < 0 else "D" * p + "K" + table.audit(p + 1, r, roles, costs)
        for cost, p, r in found
        if cost == least
    )
    return least, min(audits)


def folded(roles: list[int], faults: list[int]) -> tuple[int, str]:
    """As ``aligned``, with all lengths of one parity in one state: memory linear in the number of turns.

    States: the rest of the target is ``(ua)*``, ``a(ua)*``, ``(ua)+``, or still open to a leading ``s``.
    """
    n, costs = len(roles), _turn_costs(roles, faults)
    even, odd, some, open_ = (np.full(n + 1, _FAR, np.int64) for _ in range(4))

    def with_s(i: int) -> int:
        return TRUNCATED * (faults[i] == IS_TRUNCATED) if roles[i] == S and faults[i] in (SOUND, IS_TRUNCATED) else _FAR

    even[n], odd[n], some[n], open_[n] = 0, INSERT, 2 * INSERT, 0
    for i in range(n - 1, -1, -1):
        as_u, as_a = costs[i]
        e, o = min(DELETE + even[i + 1], as_u + odd[i + 1]), min(DELETE + odd[i + 1], as_a + even[i + 1])
        even[i], odd[i] = min(e, INSERT + o), min(o, INSERT + e)
        some[i] = min(DELETE + some[i + 1], as_u + odd[i + 1], INSERT + odd[i])
        open_[i] = min(DELETE + open_[i + 1], as_u + odd[i + 1], INSERT + odd[i], with_s(i) + some[i + 1])
    # next states: after an insertion or a turn that stands
    tables, after = {"e": even, "o": odd, "m": some, "p": open_}, {"e": "o", "o": "e", "m": "o", "p": "o"}
    i, state, out = 0, "p", []
    while True:
        table, then = tables[state], tables[after[state]]
        now, letter = table[i], U if state != "o" else A
        if i == n and now == 0:
            return int(open_[0]), "".join(out)
        if i < n and table[i + 1] + DELETE == now:
            out.append("D")
            i += 1
        elif then[i] + INSERT == now:
            out.append("I")
            state = after[state]
        elif roles[i] == S and state == "p" and with_s(i) + some[i + 1] == now:
            # an s that takes another role costs more than deleting nothing: K is the smaller letter
            out.append("K")
            i, state = i + 1, "m"
        else:
            out.append("K" if roles[i] == letter else "R")
            i, state = i + 1, after[state]


def best_edits(roles: list[int], faults: list[int]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, ties to the ASCII-least audit."""
    if not roles:
        return 0, ""
    most = incumbent(roles, faults)
    if (len(roles) + 1) * (most // DELETE + most // INSERT + 1) > TABLE_CELLS:
        return folded(roles, faults)
    return aligned(roles, faults, most)


class _Turns:
    """The turns of one conversation in order; beyond a size they wait in a file of this task."""

    def __init__(self):
        self.roles, self.faults, self.held, self.bytes, self.file = [], [], [], 0, None
        self.pairs, self.illegal, self.last = 0, 0, None
        self.turns, self.first, self.latest = 0, None, None

    def add(self, turn, kind: int, fault: int, role: str, text: str) -> None:
        if self.last is not None and (self.last, kind) not in ((S, U), (U, A), (A, U)):
            self.illegal += 1
        self.last = kind
        if turn is not None and turn != self.latest:
            self.turns, self.latest = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        self.roles.append(kind)
        self.faults.append(fault)
        self.held.append((turn, role, text))
        self.bytes += len(role) + len(text)
        if self.bytes > HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.held, self.file)
            self.held, self.bytes = [], 0

    def __iter__(self):
        if self.file:
            self.file.seek(0)
            while True:
                try:
                    yield from pickle.load(self.file)
                except EOFError:
                    break
            self.file.close()
        yield from self.held

    def gaps(self) -> int:
        return 0 if self.first is None else self.latest - self.first + 1 - self.turns

    def repaired(self, audit: str) -> Iterator[tuple]:
        """``edit, turn, role, text`` of every turn that stays or comes in, in order."""
        rows, due = iter(self), None
        for edit in audit:
            if edit == "I":
                due = NAMES[A if due == "user" else U]
                yield edit, None, due, ""
                continue
            turn, role, text = next(rows)
            if edit == "R":
                role = NAMES[A if due == "user" else U]
            if edit != "D":
                due = {"u": "user", "a": "assistant", "s": None}[role[0]]
                yield edit, turn, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Turns]]:
    now, held = None, None
    parts = (batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, batch.num_rows, SLICE_ROWS))
    for part in parts:
        for conv, turn, gone, kind, fault, role, text in zip(*(column.to_pylist() for column in part.columns)):
            if held is None or conv != now:
                if held is not None:
                    yield now, held
                now, held = conv, _Turns()
            if not gone:
                held.add(turn, kind, fault, role, text)
    if held is not None:
        yield now, held


def _audit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds, out = None, []

    def drained():
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], kinds)]
            + [pa.array(c, pa.int64()) for c in columns[1:8]]
            + [pa.array(c, pa.string()) for c in columns[8:]],
            names=names,
        )

    def seen():
        nonlocal kinds
        for batch in batches:
            kinds = batch.schema.field(0).type
            yield batch

    for conv, turns in _conversations(seen()):
        cost, audit = best_edits(turns.roles, turns.faults)
        digest, joint = hashlib.sha256(), b""
        for _, _, role, text in turns.repaired(audit):
            digest.update(joint + f"{role}:{text}".encode())
            joint = b"\n"
        faults = [turns.faults.count(fault) for fault in (IS_BLANK, IS_DUPLICATE, IS_TRUNCATED)]
        out.append((conv, len(turns.roles), turns.gaps(), *faults, turns.illegal, cost, audit, digest.hexdigest()))
        if len(out) >= _OUT_ROWS:
            yield drained()
            out = []
    if out:
        yield drained()


def _turn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, out, size = None, [], 0

    def drained():
        columns = list(zip(*out))
        types = [kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        names = ["conv_id", "place", "edit", "turn", "role", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def seen():
        nonlocal kinds
        for batch in batches:
            kinds = batch.schema.field(0).type
            yield batch

    for conv, turns in _conversations(seen()):
        _, audit = best_edits(turns.roles, turns.faults)
        for place, row in enumerate(turns.repaired(audit)):
            out.append((conv, place, *row))
            size += len(row[3])
            if len(out) >= _OUT_ROWS or size > HELD_BYTES:
                yield drained()
                out, size = [], 0
    if out:
        yield drained()


def _judged(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: Column | None) -> DataFrame:
    """Turns in order within their conversation, with the kind of their role and their first fault."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
    )
    whole = rows.repartition("conv_id")
    # the conversation's partition serves both orders: no second shuffle
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    initial, ending = F.substring("role", 1, 1), F.rtrim(F.col("text"), F.lit(BLANK_CHARS))
    kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    fault = (
        F.when(ending == "", IS_BLANK)
        .when(F.col("nth") > 1, IS_DUPLICATE)
        .when(~F.substring(ending, -1, 1).isin(".", "!", "?"), IS_TRUNCATED)
        .otherwise(SOUND)
    )
    # of equal turns the one that counts as first comes first
    ordered = whole.withColumn("nth", F.row_number().over(same)).sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    return ordered.select(
        "conv_id", "turn", "gone", kind.cast("int").alias("kind"), fault.cast("int").alias("fault"), "role", "text"
    )


def audits(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    gone: Column | None = None,
) -> DataFrame:
    """Per conversation its faults, the cheapest repair and a digest of the repaired text.

    ``conv_id, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Turns go by number,
    NULL first, equal numbers by role and text. NULL roles and texts are one space, a NULL conversation is one like any
    other, and a role without characters fits no place. Rows for which ``gone`` holds do not count, but their
    conversation is returned, with zeros and the digest of nothing where no turn is left. Repeated rows are duplicates.
    Very long texts pass through memory one batch at a time; other columns are not read. An empty table gives no rows.
    """
    judged = _judged(turns, conv_col, turn_col, role_col, text_col, gone)
    kind = judged.schema["conv_id"].dataType.simpleString()
    return judged.mapInArrow(
        _audit_rows,
        f"conv_id {kind}, n_turns long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string",
    )


def repaired_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, turn, role, text``, one row per turn that stays or comes in.

    ``edit`` is K, R or I; an inserted turn has no number and an empty text. Odd input is taken as ``audits`` takes it.
    """
    judged = _judged(turns, conv_col, turn_col, role_col, text_col, None)
    kind = judged.schema["conv_id"].dataType.simpleString()
    return judged.mapInArrow(_turn_rows, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """Turns damaged by a checksum of their place, and the column that marks the dropped ones: a test bed for repairs.

    Of twenty remainders, 0 drops the turn, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        "conv_id", "turn", kind.alias("damage"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    )
    twice = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)), F.col("damage") == 0
