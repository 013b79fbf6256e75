"""Conversation structure repair by Knuth's lightest derivation.

Rows of a conversation are edited until their roles read ``system? (user assistant)+`` or nothing is
left. Repairs are deductions over items (rows consumed, state of the pattern), each weighted by a
superior function: the cost of an edit is added, its initial is appended to the audit. An agenda pops
the item of least (cost, audit); a popped item is final, because no deduction makes a value smaller, and
the search ends when the goal item is popped.

A conversation is not one task's business. Rows are range-sorted by (conversation, turn, role, text)
and repaired as they stream by. What does not lie wholly inside one range, or is longer than a
segment, becomes segments: a segment's items are the lightest derivations from every state to every
state, and a second agenda joins neighbours by deductions of two antecedents, first by tens of
segments, then by tens of those, until one derivation spans the conversation. Joining keeps the
order of audits: the rows of a segment give each audit its letters other than I, and the letters fix the
cost, so of two audits of equal cost neither is the beginning of the other.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.frames import Scratch, map_batches, release

#: Costs of the edits; a row that stays cut off costs more.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: States of the pattern: nothing yet, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTED = (START, ASSISTANT)
#: What may follow a state: (initial, next state).
FOLLOWS = {
    START: (("s", SYSTEM), ("u", USER)),
    SYSTEM: (("u", USER),),
    USER: (("a", ASSISTANT),),
    ASSISTANT: (("u", USER),),
}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
#: Rows of a segment, and segments joined at a time.
SEGMENT, FAN = 512, 32
INK = re.compile(r"[^\x20\x09-\x0D]")
Weight = tuple[int, str]


def lightest(rows: list[tuple[str, bool, bool]], starts: tuple[int, ...], goals: tuple[int, ...]) -> dict[tuple[int, int], Weight]:
    """The least (cost, audit) from each start to each goal state over all rows (initial, must go, cut off)."""
    found = {}
    for start in starts:
        agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
        final: set[tuple[int, int]] = set()
        wanted = set(goals)
        while agenda and wanted:
            cost, audit, at, state = heapq.heappop(agenda)
            if (at, state) in final:
                continue
            final.add((at, state))
            if at == len(rows) and state in wanted:
                wanted.discard(state)
                found[start, state] = (cost, audit)
            for initial, after in FOLLOWS[state]:
                if initial != "s" and (at, after) not in final:
                    heapq.heappush(agenda, (cost + INSERT, audit + "I", at, after))
            if at == len(rows):
                continue
            own, must_go, cut_off = rows[at]
            if (at + 1, state) not in final:
                heapq.heappush(agenda, (cost + DELETE, audit + "D", at + 1, state))
            if must_go:
                continue
            stays = cost + CUT_OFF * cut_off
            for initial, after in FOLLOWS[state]:
                if (at + 1, after) in final:
                    continue
                if own == initial:
                    heapq.heappush(agenda, (stays, audit + "K", at + 1, after))
                elif initial != "s":
                    heapq.heappush(agenda, (stays + REROLE, audit + "R", at + 1, after))
    return found


def join(left: dict[tuple[int, int], Weight], right: dict[tuple[int, int], Weight], whole: bool) -> dict[tuple[int, int], Weight]:
    """Derivations over two neighbours; ``whole``: only those that begin with nothing."""
    agenda = [
        (a + b, x + y, p, r)
        for (p, q), (a, x) in left.items()
        if not whole or p == START
        for (q2, r), (b, y) in right.items()
        if q == q2
    ]
    heapq.heapify(agenda)
    final: dict[tuple[int, int], Weight] = {}
    while agenda:
        cost, audit, p, r = heapq.heappop(agenda)
        final.setdefault((p, r), (cost, audit))
    return final


class Editor:
    """Plays an audit on rows as they come, and hashes what is left."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first = audit, 0, START, True
        self.sha = hashlib.sha256()

    def _out(self, role: str, text: str) -> None:
        self.sha.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = ASSISTANT if self.state == USER else USER
            self._out(NAMES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and role[:1] == "s":
            self.state = SYSTEM
        else:
            self.state = ASSISTANT if self.state == USER else USER
        self._out(role if edit == "K" else NAMES[self.state], text)

    def digest(self) -> str:
        self._insert()
        return self.sha.hexdigest()


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_WEIGHTS = T.ArrayType(T.StructType([T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()),
                                     T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
#: A repaired conversation (DONE), a segment of one (PART), or a row of a segment (ROW).
DONE, PART, ROW = 0, 1, 2
_FIELDS = [
    T.StructField("kind", T.IntegerType()),
    T.StructField("segment", T.LongType()),
    T.StructField("at", T.LongType()),
    *(T.StructField(c, T.LongType()) for c in COUNTS),
    T.StructField("rows", T.LongType()),
    T.StructField("turns", T.LongType()),
    T.StructField("first_turn", T.LongType()),
    T.StructField("last_turn", T.LongType()),
    T.StructField("first_initial", T.StringType()),
    T.StructField("last_initial", T.StringType()),
    T.StructField("weights", _WEIGHTS),
    T.StructField("sha256", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("copies", T.LongType()),
]


def faults(text: str, copy: bool) -> tuple[str | None, bool, bool]:
    """(name of the first fault, whether the row must go, whether it is cut off)."""
    if not INK.search(text):
        return "blank", True, False
    if copy:
        return "duplicate", True, False
    bare = text.rstrip(" \t\n\v\f\r")
    if bare[-1] not in ".!?":
        return "truncated", False, True
    return None, False, False


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self):
        self.rows: list[tuple[str, bool, bool]] = []
        self.texts: list[tuple[str, str, int, int | None]] = []
        self.counts = dict.fromkeys((*COUNTS, "turns"), 0)
        self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None

    def add(self, turn: int | None, role: str, text: str, copies: int, earlier: bool) -> None:
        """``copies`` equal rows; ``earlier``: role and text have been seen in this conversation."""
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        for repeats, copy in ((1, earlier), (copies - 1, True)):
            if not repeats:
                continue
            fault, must_go, cut_off = faults(text, copy)
            if fault:
                self.counts[fault] += repeats
            if self.last_initial is not None and self.last_initial + initial not in LEGAL_PAIRS:
                self.counts["illegal"] += 1
            if initial + initial not in LEGAL_PAIRS:
                self.counts["illegal"] += repeats - 1
            self.first_initial = initial if self.first_initial is None else self.first_initial
            self.last_initial = initial
            self.rows.extend([(initial, must_go, cut_off)] * repeats)
        self.texts.append((role, text, copies, turn))

    def summary(self) -> dict:
        return {
            **self.counts, "rows": len(self.rows), "first_turn": self.first_turn, "last_turn": self.last_turn,
            "first_initial": self.first_initial, "last_initial": self.last_initial,
        }


def _weights(found: dict[tuple[int, int], Weight]) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in sorted(found.items())]


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _repair(schema: T.StructType, size: int):
    """Sorted rows to repaired conversations, or to segments where a conversation may go on elsewhere."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        out: list[dict] = []
        weight = [0]
        number = 0
        own, segment = None, _Segment()
        edge = True  # the first conversation of a range may have begun in the one before

        def give(**values) -> None:
            out.append({f: values.get(f) for f in arrow.names})
            weight[0] += 200 + len(values.get("text") or "") + sum(len(w["audit"]) for w in values.get("weights") or ())

        def flush():
            rows = pa.RecordBatch.from_pylist(out, arrow)
            out.clear()
            weight[0] = 0
            return rows

        def close(conversation, held: _Segment, split: bool) -> None:
            nonlocal number
            found = lightest(held.rows, STATES, STATES) if split else lightest(held.rows, (START,), ACCEPTED)
            if split:
                give(kind=PART, conversation=conversation, segment=base + number, at=0, weights=_weights(found), **held.summary())
                for at, (role, text, copies, _) in enumerate(held.texts):
                    give(kind=ROW, conversation=conversation, segment=base + number, at=at, role=role, text=text, copies=copies)
                number += 1
                return
            cost, audit = min(found[START, goal] for goal in ACCEPTED if (START, goal) in found)
            editor = Editor(audit)
            for role, text, copies, _ in held.texts:
                for _ in range(copies):
                    editor.row(role, text)
            best = [{"p": START, "q": START, "cost": cost, "audit": audit}]
            give(kind=DONE, conversation=conversation, weights=best, sha256=editor.digest(), **held.summary())

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conversation", "turn", "role", "text", "copies", "earlier"))
            for conversation, turn, role, text, copies, earlier in zip(*columns):
                if own is None or conversation != own[0]:
                    if own is not None:
                        close(own[0], segment, edge)
                        edge = False
                    own, segment = (conversation,), _Segment()
                if len(segment.rows) + copies > size and segment.rows:
                    close(own[0], segment, True)
                    edge = True  # what follows is split as well
                    segment = _Segment()
                while copies > size:  # a hot group of equal rows
                    segment.add(turn, role, text, size, earlier)
                    close(own[0], segment, True)
                    edge, segment, earlier, copies = True, _Segment(), True, copies - size
                segment.add(turn, role, text, copies, earlier)
                if weight[0] > 4 << 20:
                    yield flush()
        if own is not None:
            close(own[0], segment, True)  # it may go on in the next range
        if out:
            yield flush()

    return run


def _merge(schema: T.StructType, fan: int):
    """Neighbouring segments of a group, sorted, to one."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["conversation"], row["place"] // fan)
                if own != key:
                    if held is not None:
                        yield pa.RecordBatch.from_pylist([held], arrow)
                    key, held = own, {**row, "place": own[1]}
                else:
                    held = _joined(held, row, own[1] == 0)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held], arrow)

    return run


def _joined(left: dict, right: dict, whole: bool) -> dict:
    out = {**left}
    for c in (*COUNTS, "rows", "turns"):
        out[c] = left[c] + right[c]
    if left["last_initial"] is not None and right["first_initial"] is not None:
        out["illegal"] += left["last_initial"] + right["first_initial"] not in LEGAL_PAIRS
    if left["last_turn"] is not None and left["last_turn"] == right["first_turn"]:
        out["turns"] -= 1
    for c, first in (("first_turn", True), ("first_initial", True), ("last_turn", False), ("last_initial", False)):
        a, b = (left[c], right[c]) if first else (right[c], left[c])
        out[c] = b if a is None else a
    weights = ({(w["p"], w["q"]): (w["cost"], w["audit"]) for w in side["weights"]} for side in (left, right))
    out["weights"] = _weights(join(*weights, whole))
    return out


def _replay(schema: T.StructType):
    """An audit, then the rows of its conversation in order: the hash of what is left."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, conversation = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    if editor is not None:
                        yield pa.RecordBatch.from_pylist([{"conversation": conversation, "sha256": editor.digest()}], arrow)
                    editor, conversation = Editor(row["audit"]), row["conversation"]
                    continue
                for _ in range(row["copies"]):
                    editor.row(row["role"], row["text"])
        if editor is not None:
            yield pa.RecordBatch.from_pylist([{"conversation": conversation, "sha256": editor.digest()}], arrow)

    return run


def repair(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None,
    segment: int = SEGMENT, fan: int = FAN,
) -> DataFrame:
    """One row for each conversation of ``df``: its faults, its cheapest repair and a hash of the result.

    Returns the conversation's column, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` (K keep, R give a role, D delete, I insert) and ``repaired_sha256``. Columns other
    than those named are not used, so their names cannot clash. Rows stand in the order of turn (null
    first), role and text; equal rows are copies. A null role or text is one space; a null conversation
    is a conversation. ``copies`` names a column with the multiplicity of a row; with 0 a row only names
    its conversation. A role that is empty has no initial and cannot be kept. An empty table gives none.

    A conversation of any length is spread over segments of ``segment`` rows, joined ``fan`` at a time. The audit, one letter for
    each row, is held by one task with the derivations of its last join (sixteen times its length at
    most), and the hash is taken over the rows as they stream through one task.
    """
    scratch = Scratch(df.sparkSession)
    kind = df.schema[conversation].dataType
    many = F.col(f"`{copies}`").cast("long") if copies else F.lit(1).cast("long")
    rows = (
        df.select(
            F.col(f"`{conversation}`").alias("conversation"),
            F.col(f"`{turn}`").cast("long").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
            many.alias("copies"),
        )
        .groupBy("conversation", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .withColumn("key", F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)))
    )
    first = (
        rows.where("copies > 0").groupBy("conversation", "key").agg(F.min(F.struct("turn")).alias("first"))
        .withColumnsRenamed({"conversation": "of", "key": "same"})
    )
    marked = rows.join(first, F.col("conversation").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")), "left").select(
        "conversation", "turn", "role", "text", "copies",
        (F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("earlier"),
    )
    order = [F.asc_nulls_first("conversation"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    schema = T.StructType([T.StructField("conversation", kind), *_FIELDS])
    streamed = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    made = scratch.write(map_batches(streamed, _repair(schema, segment), schema), "repair")
    done = made.where(F.col("kind") == DONE).select("conversation", *_SUMS, F.col("weights")[0].alias("best"), "sha256")
    whole = done.unionByName(_whole(made, kind, scratch, fan))
    release(df.sparkSession)
    gaps = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).otherwise(F.lit(0))
    return whole.select(
        F.col("conversation").alias(conversation), gaps.cast("long").alias("gaps"), *COUNTS,
        F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), F.col("sha256").alias("repaired_sha256"),
    )


_SUMS = (*COUNTS, "turns", "first_turn", "last_turn")


def _whole(made: DataFrame, kind: T.DataType, scratch: Scratch, fan: int) -> DataFrame:
    """Repaired conversations of the segments of ``made``."""
    columns = ["conversation", *_SUMS, "rows", "first_initial", "last_initial", "weights"]
    parts = made.where(F.col("kind") == PART)
    # Numbers of segments within a conversation: narrow rows, one for each SEGMENT rows of the input.
    place = F.row_number().over(Window.partitionBy("conversation").orderBy("segment")).cast("long") - 1
    placed = parts.select(F.col("segment").alias("own"), place.alias("place"))
    parts = scratch.write(parts.join(placed, parts["segment"] == placed["own"]).select("place", *columns), "repair-parts")
    most = parts.agg(F.max("place")).first()[0]
    while most:
        group = F.floor(F.col("place") / fan)
        grouped = parts.repartition(F.col("conversation"), group).sortWithinPartitions("conversation", "place")
        parts = scratch.write(map_batches(grouped, _merge(parts.schema, fan), parts.schema), "repair-parts")
        most //= fan
    best = F.array_min(
        F.transform(
            F.filter("weights", lambda w: (w["p"] == START) & w["q"].isin(*ACCEPTED)),
            lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"), w["p"].alias("p"), w["q"].alias("q")),
        )
    )
    spans = scratch.write(parts.withColumn("found", best), "repair-spans")
    audits = spans.select("conversation", F.lit(-1).cast("long").alias("segment"), F.lit(0).cast("long").alias("at"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                          F.lit(0).cast("long").alias("copies"), F.col("found.audit").alias("audit"))
    rows = made.where(F.col("kind") == ROW).select(*audits.columns[:-1], F.lit(None).cast("string").alias("audit"))
    ordered = audits.unionByName(rows).repartition("conversation").sortWithinPartitions(
        F.asc_nulls_first("conversation"), "segment", "at"
    )
    hashed = T.StructType([T.StructField("conversation", kind), T.StructField("sha256", T.StringType())])
    shas = map_batches(ordered, _replay(hashed), hashed).withColumnRenamed("conversation", "of")
    best_of = F.struct(F.col("found.p").alias("p"), F.col("found.q").alias("q"), F.col("found.cost").alias("cost"), F.col("found.audit").alias("audit"))
    return spans.join(shas, F.col("conversation").eqNullSafe(F.col("of"))).select("conversation", *_SUMS, best_of.alias("best"), "sha256")


def damage(df: DataFrame) -> DataFrame:
    """``conversations`` with faults chosen by crc32(``conv_id:turn``) % 20, as rows with ``copies``.

    0 drops the row (0 copies), 1 empties its text, 2 removes its full stops, 3 repeats it, 4 makes it the
    user's. Nulls count as one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    dropped = F.col("fault") == 0
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).select(
        "conv_id",
        F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(dropped, F.lit("")).when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(dropped, F.lit(0)).when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )
