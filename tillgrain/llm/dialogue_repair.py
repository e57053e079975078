"""Conversation structure: planted damage, audit of the faults, cheapest repair.

A repair edits a conversation's rows in order until their roles read system?, then user and
assistant in turns, both at least once, or nothing at all: Delete (3, and the only edit of
blank and duplicate rows), Insert an empty user or assistant row (2), Keep (0, the role must fit),
Rerole (2, to the role that fits). Truncated rows that stay cost 1 more. The answer is the cheapest
edit string, the least in ASCII order where several are.

Search is iterative-deepening A*: depth first in the order D, I, K, R under a cost bound that
rises by one, pruned by the charges that the rows ahead cannot avoid, with a table of states
that failed and the budget they failed with. The first accepting path is the answer, as no
cheaper one passed an earlier bound.

A conversation may hold any share of all rows. Its rows, reduced to a digest of the text, are
sorted by range partitions and cut into segments of ``SEGMENT`` rows. Each segment has a matrix
of cheapest costs between the four states of the role pattern; composed from the last segment
backwards they give the cost still to come at the end of each segment, with which every
segment is searched alone, for each state it may start in. Two paths over the same rows never
are prefixes of each other (each ends with its last row's edit), so the first segment in
which they differ decides their order and the pieces join to the whole answer. Texts move
once, to be hashed: SHA-256 needs a conversation's rows in one stream, which holds one row at a
time and the edit string.

Rows are taken by turn, nulls first, then role, then digest. A null role or text is one
space, in the key of the damage a null id or turn as well. Defined cases: a role whose first letter
is not s, u or a, the empty one included, fits nowhere and is illegal beside any other; rows without
conv_id are one conversation; equal rows are duplicates of the first; an empty table gives an
empty result; columns besides conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm.support import map_batches, materialise

SEGMENT = 64

# States: before the first row, after system, after user, after assistant.
STATES = range(4)
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NOWHERE = (None, None, None, None)
# Inserted or renamed rows take the one role that fits: assistant after user, else user.
FORCED = (2, 2, 3, 2)
NAMES = ("user", "user", "assistant", "user")
# Cost of the inserts that complete a conversation, two each.
ENDS = (0, 4, 2, 0)
DELETE, INSERT, RENAME = 3, 2, 2
# Marks of a row: sound, truncated, to be deleted.
SOUND, CUT, GONE = ".", "~", "#"
_SPACE = r"\x20\x09-\x0D"


def repair(roles: str, marks: str, start: int, ends: Sequence[int]) -> tuple[int, str, int]:
    """(cost, edits, last state) of the best path; ``ends`` are the costs after the last row."""
    n = len(roles)
    due = {SOUND: 0, CUT: 1, GONE: DELETE}
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + due[marks[i]]
    least = min(ends)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def descend(i: int, state: int, left: int) -> int | None:
        if i == n:
            return state if ends[state] <= left else None
        if ahead[i] + least > left or failed.get((i, state), -1) >= left:
            return None
        mark, moves = marks[i], [("D", i + 1, state, DELETE), ("I", i, FORCED[state], INSERT)]
        if mark != GONE:
            kept = KEEP.get(roles[i], _NOWHERE)[state]
            if kept is not None:
                moves.append(("K", i + 1, kept, due[mark]))
            moves.append(("R", i + 1, FORCED[state], RENAME + due[mark]))
        for edit, after, to, cost in moves:
            if cost <= left:
                path.append(edit)
                last = descend(after, to, left - cost)
                if last is not None:
                    return last
                path.pop()
        failed[i, state] = left
        return None

    bound = ahead[0] + least if n else ends[start]
    while (last := descend(0, start, bound)) is None:
        bound += 1
    return bound - ends[last], "".join(path), last


@lru_cache(maxsize=20_000)
def matrix(roles: str, marks: str) -> tuple[int, ...]:
    """Cheapest cost from each state before the rows to each state after them, row by row."""
    far = 1 << 40
    out: list[int] = []
    for start in STATES:
        cost = [far] * 4
        cost[start] = 0
        for role, mark in zip(roles, marks, strict=True):
            for _ in range(2):
                for q in STATES:
                    cost[FORCED[q]] = min(cost[FORCED[q]], cost[q] + INSERT)
            after = [c + DELETE for c in cost]
            if mark != GONE:
                more = int(mark == CUT)
                kept = KEEP.get(role, _NOWHERE)
                for q in STATES:
                    after[FORCED[q]] = min(after[FORCED[q]], cost[q] + RENAME + more)
                    if kept[q] is not None:
                        after[kept[q]] = min(after[kept[q]], cost[q] + more)
            cost = after
        out += [min(c, far) for c in cost]
    return tuple(out)


def backwards(step: Sequence[int], ends: Sequence[int]) -> list[int]:
    """Costs before a segment from its matrix and the costs after it."""
    return [min(step[4 * q + to] + ends[to] for to in STATES) for q in STATES]


@lru_cache(maxsize=20_000)
def _known(roles: str, marks: str, start: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
    return repair(roles, marks, start, ends)


# -- over tables ----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the planted damage, with how often each one stands there."""
    blank_for = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", blank_for("conv_id"), blank_for("turn")).cast("binary")) % 20
    text, role = blank_for("text"), blank_for("role")
    return (
        conversations.withColumn("_fate", fate)
        .where("_fate != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_fate") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("_fate") == 1, "")
            .when(F.col("_fate") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.when(F.col("_fate") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _order(*more: str) -> list[Column]:
    plain = [F.col(c) for c in ("role", "digest", *more)]
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *plain]


def _marked_rows(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One narrow row per distinct row, with its count and whether it comes first."""
    text = F.col("text")
    blank = ~text.rlike(f"[^{_SPACE}]")
    cut = ~text.rlike(rf"[.!?][{_SPACE}]*\z")
    narrow = (
        rows.select(
            "conv_id",
            "turn",
            "role",
            _digest(text).alias("digest"),
            F.when(blank, "b").when(cut, "t").otherwise("").alias("fault"),
            "copies",
        )
        .groupBy("conv_id", "turn", "role", "digest", "fault")
        .agg(F.sum("copies").alias("n"))
    )
    stored = materialise(spark, narrow, "dialogue_rows")
    # Only the first row of a text is looked for, which a map-side limit allows: a text
    # repeated in very many turns sends one row per task.
    first = (
        stored.select(
            "conv_id",
            "turn",
            "role",
            "digest",
            F.expr(
                "row_number() over (partition by conv_id, role, digest"
                " order by turn asc nulls first)"
            ).alias("_n"),
        )
        .where("_n = 1")
        .select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "role", "digest")])
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "turn", "role", "digest")]
    joined = stored.join(first, same[0] & same[1] & same[2] & same[3], "left")
    return joined.select(*stored.columns, F.col("_role").isNotNull().alias("first"))


class _Open:
    """A segment being filled."""

    def __init__(self, conv: object, key: tuple, opens: bool) -> None:
        self.conv, self.key, self.opens = conv, key, opens
        self.roles: list[str] = []
        self.marks: list[str] = []
        self.blank = self.duplicate = self.truncated = self.turns = 0
        self.turn_first = self.turn_last = None


_SEGMENT_SCHEMA = (
    "conv_id bigint, turn bigint, role string, digest binary, seg bigint, opens boolean, roles string, "
    "marks string, matrix array<bigint>, blank bigint, duplicate bigint, truncated bigint, "
    "turns bigint, turn_first bigint, turn_last bigint"
)


def _segments(marked: DataFrame) -> DataFrame:
    """Sorted rows cut into segments; ``seg`` rises along every conversation."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 33
        names = _SEGMENT_SCHEMA.split(", ")
        out: dict[str, list] = {}
        held: _Open | None = None
        last_conv: object = _Open  # no conversation is this

        def close(s: _Open) -> None:
            nonlocal number
            roles, marks = "".join(s.roles), "".join(s.marks)
            row = (s.conv, *s.key, number, s.opens, roles, marks, matrix(roles, marks), s.blank)
            row += (s.duplicate, s.truncated, s.turns, s.turn_first, s.turn_last)
            for name, value in zip(names, row, strict=True):
                out.setdefault(name.split()[0], []).append(value)
            number += 1

        def emptied() -> dict:
            full = dict(out)
            out.clear()
            return full | {"turn": pa.array(full["turn"], pa.int64())}

        for batch in batches:
            for conv, turn, role, digest, fault, n, first in zip(
                *[batch.column(i).to_pylist() for i in range(7)], strict=True
            ):
                letter = role[:1] if role[:1] in KEEP else "x"
                for copy in range(n):
                    if held is None or held.conv != conv or len(held.roles) >= SEGMENT:
                        if held is not None:
                            close(held)
                        # The first segment of a task may continue a conversation.
                        opens = last_conv is not _Open and last_conv != conv
                        held = _Open(conv, (turn, role, digest), opens)
                        last_conv = conv
                    held.roles.append(letter)
                    if fault == "b":
                        mark = GONE
                        held.blank += 1
                    elif copy or not first:
                        mark = GONE
                        held.duplicate += 1
                    else:
                        mark = CUT if fault == "t" else SOUND
                        held.truncated += fault == "t"
                    held.marks.append(mark)
                    if turn is not None and turn != held.turn_last:
                        held.turns += 1
                        held.turn_last = turn
                        if held.turn_first is None:
                            held.turn_first = turn
                if len(out.get("seg", ())) >= 1000:
                    yield emptied()
        if held is not None:
            close(held)
        if out:
            yield emptied()

    columns = ("conv_id", "turn", "role", "digest", "fault", "n", "first")
    ranged = marked.select(*columns).repartitionByRange(*_order())
    return map_batches(ranged.sortWithinPartitions(*_order()), step, _SEGMENT_SCHEMA)


def _costs_to_come(segments: DataFrame) -> DataFrame:
    """(seg, ends) of all segments but the last of each conversation."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv: object = _Open
        ends: list[int] = []
        for batch in batches:
            seg, to_come = [], []
            for this, number, costs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if conv is not _Open and this == conv:
                    seg.append(number)
                    to_come.append(ends)
                else:
                    conv, ends = this, list(ENDS)
                ends = backwards(costs, ends)
            if seg:
                yield {"follows": seg, "ends": to_come}

    rows = segments.select("conv_id", "seg", "matrix").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", F.desc("seg"))
    return map_batches(rows, step, "follows bigint, ends array<bigint>")


def _searched(segments: DataFrame) -> DataFrame:
    """Segments with cost, edits and last state for each state they may start in."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            costs, edits, lasts = [], [], []
            for opens, roles, marks, ends in zip(
                *[column[n].to_pylist() for n in ("opens", "roles", "marks", "ends")], strict=True
            ):
                found = [
                    _known(roles, marks, q, tuple(ends or ENDS))
                    for q in (STATES[:1] if opens else STATES)
                ]
                costs.append([f[0] for f in found])
                edits.append([f[1] for f in found])
                lasts.append([f[2] for f in found])
            yield column | {"costs": costs, "edits": edits, "lasts": lasts}

    joined = segments.join(_costs_to_come(segments), F.col("seg") == F.col("follows"), "left")
    kept = [*segments.drop("matrix").columns, "ends"]
    schema = ", ".join(p for p in _SEGMENT_SCHEMA.split(", ") if not p.startswith("matrix"))
    schema += ", ends array<bigint>, costs array<bigint>, edits array<string>, lasts array<bigint>"
    return map_batches(joined.select(*kept), step, schema)


class _Conversation:
    """What a stream of a conversation's segments and rows adds up to."""

    def __init__(self) -> None:
        self.planned = self.state = 0
        self.cost = self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0
        self.lowest = self.highest = None
        self.last_role = ""
        self.audit: list[str] = []
        self.queue: deque[str] = deque()
        self.sha = hashlib.sha256()
        self.empty = True

    def segment(self, p: dict) -> None:
        at = self.planned
        self.cost += p["costs"][at]
        self.audit.append(p["edits"][at])
        self.queue.extend(p["edits"][at])
        self.planned = p["lasts"][at]
        roles = self.last_role + p["roles"]
        self.illegal += sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))
        self.last_role = roles[-1:]
        for name in ("blank", "duplicate", "truncated", "turns"):
            setattr(self, name, getattr(self, name) + p[name])
        if p["turn_first"] is not None:
            self.turns -= p["turn_first"] == self.highest
            self.lowest = p["turn_first"] if self.lowest is None else self.lowest
            self.highest = p["turn_last"]

    def _write(self, role: bytes, text: bytes) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(role + b":" + text)

    def _fitting(self, text: bytes) -> None:
        self._write(NAMES[self.state].encode(), text)
        self.state = FORCED[self.state]

    def row(self, role: str, text: bytes, copies: int) -> None:
        for _ in range(copies):
            while (edit := self.queue.popleft()) == "I":
                self._fitting(b"")
            if edit == "K":
                self._write(role.encode(), text)
                self.state = KEEP[role[0]][self.state]
            elif edit == "R":
                self._fitting(text)

    def result(self) -> tuple:
        more = ENDS[self.planned] // INSERT
        for _ in range(more):
            self._fitting(b"")
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        audit = "".join(self.audit) + "I" * more
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal)
        return (*counts, self.cost + INSERT * more, audit, self.sha.hexdigest())


_RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)
_PLAN = ("costs", "edits", "lasts", "roles", "blank", "duplicate", "truncated", "turns", "turn_first", "turn_last")


def _applied(conversations: DataFrame, rows: DataFrame, searched: DataFrame) -> DataFrame:
    """Rows and edits of each conversation in one sorted stream."""
    texts = rows.select(
        "conv_id", "turn", "role", _digest(F.col("text")).alias("digest"),
        F.lit(2).alias("kind"), "copies", F.col("text").cast("binary").alias("text"),
    )
    plans = searched.select(
        "conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), "seg", *_PLAN
    )
    every = conversations.select("conv_id").distinct().withColumn("kind", F.lit(0))
    stream = texts.unionByName(plans, allowMissingColumns=True)
    stream = stream.unionByName(every, allowMissingColumns=True)
    names = ["conv_id", "role", "kind", "copies", "text", *_PLAN]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        targets = [part.split()[0] for part in _RESULT.split(", ")]
        conv: object = _Open
        held = _Conversation()
        for batch in batches:
            done: list[tuple] = []
            for i, (this, role, kind, copies, text) in enumerate(
                zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True)
            ):
                if conv is _Open or this != conv:
                    if conv is not _Open:
                        done.append((conv, *held.result()))
                    conv, held = this, _Conversation()
                if kind == 1:
                    plan = {n: batch.column(5 + k)[i].as_py() for k, n in enumerate(_PLAN)}
                    held.segment(plan)
                elif kind == 2:
                    held.row(role, text, copies)
            if done:
                yield dict(zip(targets, zip(*done, strict=True), strict=True))
        if conv is not _Open:
            last = (conv, *held.result())
            yield dict(zip(targets, ([v] for v in last), strict=True))

    dealt = stream.repartition("conv_id").sortWithinPartitions(*_order("kind", "seg"))
    return map_batches(dealt.select(*names), step, _RESULT)


def report(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repair of every conversation."""
    table = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    rows = damaged(table)
    segments = materialise(spark, _segments(_marked_rows(spark, rows)), "dialogue_segments")
    return _applied(table, rows, _searched(segments))
