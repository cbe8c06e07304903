"""Conversation structure repair: the cheapest edits that leave a well-formed conversation.

Edits lead through four states: nothing yet, after the system turn, after a user turn, after an assistant turn. A
forward vector holds the least cost of reaching each state and the order of the audits that do so, a backward vector
the least cost of finishing from each state. Hirschberg's scheme lets both meet in the middle of a conversation, picks
the cheapest crossing (of several the one whose audit so far is least), and solves both halves alike, so it never stores
more than the two vectors and the crossings.

The same scheme carries conversations of any length over many tasks. Rows are sorted over the whole table by
conversation and turn, without their texts. Conversations that lie inside a partition are finished there, in a byte a
row. The first and last one of a partition may go on in the next: of these a partition
gives its part's cost and order from every state to every state, which is a step like that of a single row; the
crossings between the parts are found from these alone, and each part is then solved between its two states by a task.

Audits of two states are never equal and neither starts with the other, as each ends with the letter of the same row;
so their order, not their text, decides between them later on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

START, SYSTEM, USER, ASSISTANT = range(4)
REROLED, DELETED, INSERTED, CUT = 1, 2, 5, 5  # costs
_SPACE = " \t\n\x0b\f\r"
_LEGAL = ("su", "ua", "au")
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What is still inserted behind the last row, by state.
_TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_TAIL_COSTS = [INSERTED * len(_TAIL[state]) for state in range(4)]
#: A step: from each state the (state, cost, order) that it can lead to.
Step = list[list[tuple]]


def _kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return USER if initial == "u" and state != USER else None


def _row_step(code: str) -> Step:
    """The step of a row: the least edits (inserts, then the row's own) between each two states.

    `code` is x for a row that must go, else the role's initial (o: any other), a capital for a truncated text.
    """
    cut = CUT if code.isupper() else 0
    step = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state = start
        for inserts in range(3):
            edits = [(state, DELETED, "D")]
            if code != "x":
                kept = _kept_state(state, code.lower())
                if kept is not None:
                    edits.append((kept, cut, "K"))
                edits.append((_NEXT[state], REROLED + cut, "R"))
            for reached, cost, letter in edits:
                found = (INSERTED * inserts + cost, "I" * inserts + letter)
                best[reached] = min(best.get(reached, found), found)
            state = _NEXT[state]
        step.append([(reached, *found) for reached, found in sorted(best.items())])
    return step


_STEPS = {code: _row_step(code) for code in "xsuaoSUAO"}


def _advance(vector: list, step: Step) -> list:
    """(cost, order of the audit) of each state after one more step; None where it is out of reach."""
    found: list = [None] * 4
    for state, held in enumerate(vector):
        if held is not None:
            for reached, cost, order in step[state]:
                way = (held[0] + cost, held[1], order)
                if found[reached] is None or way < found[reached]:
                    found[reached] = way
    audits = sorted((way[1:], state) for state, way in enumerate(found) if way is not None)
    for rank, (_, state) in enumerate(audits):
        found[state] = (found[state][0], rank)
    return found


def _forward(step_of: Callable[[int], Step], low: int, high: int, start: int) -> list:
    vector = [(0, 0) if state == start else None for state in range(4)]
    for i in range(low, high):
        vector = _advance(vector, step_of(i))
    return vector


def _backward(step_of: Callable[[int], Step], low: int, high: int, costs: list) -> list:
    """Least cost from each state before step `low` to the end, whose states cost `costs` (None: not allowed)."""
    for i in reversed(range(low, high)):
        costs = [min((cost + costs[reached] for reached, cost, _ in ways if costs[reached] is not None), default=None)
                 for ways in step_of(i)]
    return costs


def _crossing(forward: list, costs: list) -> int:
    """The state where a cheapest way crosses, of several the one with the least audit."""
    ways = [(held[0] + cost, held[1], state) for state, (held, cost) in enumerate(zip(forward, costs))
            if held is not None and cost is not None]
    return min(ways)[2]


def crossings(step_of: Callable[[int], Step], count: int, start: int, costs: list) -> bytearray:
    """The states before, between and after `count` steps on the audit-least cheapest way."""
    states = bytearray(count + 1)
    states[0] = start
    states[count] = _crossing(_forward(step_of, 0, count, start), costs) if count else start
    open_parts = [(0, count)]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        ends = [0 if state == states[high] else None for state in range(4)]
        states[middle] = _crossing(_forward(step_of, low, middle, states[low]), _backward(step_of, middle, high, ends))
        open_parts += [(low, middle), (middle, high)]
    return states


def audit_of(codes: bytes, start: int = START, end: int | None = None) -> tuple[str, int]:
    """Audit and cost of the rows `codes`, from one state to another; with no end, to the end of the conversation."""
    costs = _TAIL_COSTS if end is None else [0 if state == end else None for state in range(4)]
    states = crossings(lambda i: _STEPS[chr(codes[i])], len(codes), start, costs)
    letters, cost = [], 0
    for i, code in enumerate(codes):
        _, more, edits = next(way for way in _STEPS[chr(code)][states[i]] if way[0] == states[i + 1])
        letters.append(edits)
        cost += more
    if end is None:
        letters.append(_TAIL[states[-1]])
        cost += _TAIL_COSTS[states[-1]]
    return "".join(letters), cost


# Rows

def damage(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) damaged by a checksum of conversation and turn; `copies` says how often a row stands.

    0 drops the row (copies 0), 1 empties its text, 2 removes its full stops, exclamation and question marks, 3
    repeats it, 4 makes it the user's; the checksum modulo 20. Null roles and texts are one space, and so are nulls in the
    checksum's text; a null turn stays null.
    """
    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = spaced("text")
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def undamaged(rows: DataFrame) -> DataFrame:
    """`rows` as they are, in the form of `damage`, for repair of real conversations."""
    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
                       spaced("text").alias("text"), F.lit(1).alias("copies"))


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


_ORDER = ("conv_id", "has_turn", "turn", "role", "digest")


def _coded(rows: DataFrame) -> DataFrame:
    """Rows without their texts, with what is wrong with each. `again`: role and text stand at an earlier turn."""
    body = F.rtrim("text", F.lit(_SPACE))
    narrow = rows.select(
        "conv_id", F.col("turn").isNotNull().alias("has_turn"), "turn", "role", _digest(F.col("text")).alias("digest"),
        (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"), "copies")
    repeated = (narrow.where("copies > 0").groupBy("conv_id", "role", "digest")
                .agg(F.min(F.struct("has_turn", "turn")).alias("first"), F.count("*").alias("rows")).where("rows > 1")
                .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
                        F.col("first.turn").alias("_turn"), F.lit(True).alias("_found")))
    same = narrow["conv_id"].eqNullSafe(repeated["_conv"]) & (narrow["role"] == repeated["_role"]) \
        & (narrow["digest"] == repeated["_digest"])
    again = F.coalesce("_found", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("_turn"))
    return narrow.join(repeated, same, "left").select(*narrow.columns, again.alias("again"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


class _Part:
    """What one partition knows of a conversation, gathered row by row: a byte a row and a few numbers."""

    def __init__(self, conv) -> None:
        self.conv, self.codes, self.last_row = conv, bytearray(), None
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.turns = 0

    def add(self, turn, role: str, digest: bytes, blank: bool, truncated: bool, copies: int, again: bool) -> None:
        if copies == 0:
            return
        again = again or self.last_row == (turn, role, digest)
        self.last_row = (turn, role, digest)
        initial = role[:1]
        for _ in range(copies):
            fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else None
            if fault:
                self.counts[fault] += 1
            code = "x" if blank or again else initial if initial in ("s", "u", "a") else "o"
            self.codes += (code.upper() if fault == "truncated" else code).encode()
            if self.first_initial is None:
                self.first_initial = initial
            elif self.last_initial + initial not in _LEGAL:
                self.counts["illegal"] += 1
            self.last_initial = initial
            again = True
        if turn is not None and (self.turns == 0 or turn != self.last_turn):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def step(self) -> list[int]:
        """Cost and order from every state to every state, -1 where there is no way."""
        codes = self.codes
        flat = []
        for start in range(4):
            for held in _forward(lambda i: _STEPS[chr(codes[i])], 0, len(codes), start):
                flat += (-1, -1) if held is None else held
        return flat


def _steps_of(flat: list[int]) -> Step:
    return [[(reached, flat[8 * state + 2 * reached], flat[8 * state + 2 * reached + 1])
             for reached in range(4) if flat[8 * state + 2 * reached] >= 0] for state in range(4)]


def _gaps(first, last, turns: int) -> int:
    return 0 if turns == 0 else min(last - first + 1 - turns, 2**63 - 1)


def _parts_of_partition(key: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows to conversations: finished ones, and parts of the first and the last one."""
    schema = pa.schema([("conv_id", key), ("part", pa.int64()), ("codes", pa.binary()), ("step", pa.list_(pa.int64())),
                        *((c, pa.int64()) for c in (*_COUNTS, "first_turn", "last_turn", "turns")),
                        ("first_initial", pa.string()), ("last_initial", pa.string()), ("gaps", pa.int64()),
                        ("cost", pa.int64()), ("audit", pa.string())])

    def row(part: _Part, number: int, is_open: bool) -> dict:
        known = {"conv_id": part.conv, "part": number, **part.counts, "first_turn": part.first_turn, "last_turn": part.last_turn,
                 "turns": part.turns, "first_initial": part.first_initial, "last_initial": part.last_initial}
        if is_open:
            return known | {"codes": bytes(part.codes), "step": part.step()}
        audit, cost = audit_of(part.codes)
        return known | {"gaps": _gaps(part.first_turn, part.last_turn, part.turns), "cost": cost, "audit": audit}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, is_first, done, held = None, 0, True, [], 0
        for found in batches:
            columns = [found.column(c).to_pylist() for c in
                       ("conv_id", "turn", "role", "digest", "blank", "truncated", "copies", "again", "part")]
            for conv, *values, number in zip(*columns):
                if part is None or part.conv != conv:
                    if part is not None:
                        done.append(row(part, number, is_first))
                        held += len(part.codes) + 100
                        is_first = False
                    part = _Part(conv)
                part.add(*values)
                if held > 1 << 20:
                    yield batch(done)
                    done, held = [], 0
        if part is not None:
            done.append(row(part, number, True))
        if done:
            yield batch(done)

    return read


def _join_parts(table: pa.Table) -> pa.Table:
    """The parts of one conversation, without their rows: the states each lies between, its counts, and what the borders add."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    steps = [_steps_of(r["step"]) for r in rows]
    states = crossings(lambda i: steps[i], len(steps), START, _TAIL_COSTS)
    turns, first, last, initial, out = 0, None, None, None, []
    for i, r in enumerate(rows):
        illegal = r["illegal"]
        if r["first_initial"] is not None:
            illegal += initial is not None and initial + r["first_initial"] not in _LEGAL
            initial = r["last_initial"]
        if r["turns"]:
            turns += r["turns"] - (last is not None and last == r["first_turn"])
            first, last = r["first_turn"] if first is None else first, r["last_turn"]
        out.append({"conv_id": r["conv_id"], "part": r["part"], "entry": states[i],
                    "exit": None if i + 1 == len(rows) else states[i + 1], "blank": r["blank"], "duplicate": r["duplicate"],
                    "truncated": r["truncated"], "illegal": illegal, "gaps": 0})
    out[-1]["gaps"] = _gaps(first, last, turns)
    schema = pa.schema([("conv_id", table.schema.field("conv_id").type), ("part", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()),
                        *((c, pa.int64()) for c in (*_COUNTS, "gaps"))])
    return pa.Table.from_pylist(out, schema=schema)


def _solve_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in batches:
        for i in range(found.num_rows):
            row = found.slice(i, 1)
            value = {c: row.column(c)[0].as_py() for c in ("codes", "entry", "exit")}
            audit, cost = audit_of(value["codes"], value["entry"], value["exit"])
            kept = row.select(["conv_id", "part", *_COUNTS, "gaps"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([cost], pa.int64()), pa.array([audit], pa.string())],
                                             names=[*kept.schema.names, "cost", "audit"])


_RESULT = ("gaps", *_COUNTS, "cost", "audit")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (as `damage` gives them): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows of a conversation stand by turn, nulls first; equal turns by role and then by the SHA-256 of the text, so equal rows are
    neighbours and all but the first are duplicates. A conversation whose rows all have no copies has zeros and an empty audit.
    A null conv_id is a conversation like any other; an empty table gives an empty result.
    """
    key = rows.schema["conv_id"]
    kind = T.StructField("conv_id", key.dataType)
    longs = {c: T.StructField(c, T.LongType()) for c in (*_COUNTS, "first_turn", "last_turn", "turns", "gaps", "cost", "part")}
    counts = [longs[c] for c in _COUNTS]
    audit = T.StructField("audit", T.StringType())
    schema = T.StructType([
        kind, longs["part"], T.StructField("codes", T.BinaryType()), T.StructField("step", T.ArrayType(T.LongType())), *counts,
        longs["first_turn"], longs["last_turn"], longs["turns"], T.StructField("first_initial", T.StringType()),
        T.StructField("last_initial", T.StringType()), longs["gaps"], longs["cost"], audit])
    arrow_key = _arrow_type(rows)
    ordered = (_coded(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
               .select("conv_id", "turn", "role", "digest", "blank", "truncated", "copies", "again",
                       F.spark_partition_id().cast("long").alias("part")))
    found = written(ordered.mapInArrow(_parts_of_partition(arrow_key), schema), "conversation-parts")
    open_parts = found.where("codes is not null")
    joined = open_parts.drop("codes", "gaps", "cost", "audit").groupBy("conv_id").applyInArrow(
        _join_parts, T.StructType([kind, longs["part"], T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
                                   *counts, longs["gaps"]]))
    codes = open_parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "codes")
    solved = (joined.join(codes, (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
              .mapInArrow(_solve_parts, T.StructType([kind, longs["part"], *counts, longs["gaps"], longs["cost"], audit])))
    pieces = F.array_sort(F.collect_list(F.struct("part", "audit")))
    whole = solved.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("gaps", *_COUNTS, "cost")),
                                          F.array_join(F.transform(pieces, lambda p: p.audit), "").alias("audit"))
    return found.where("codes is null").select("conv_id", *_RESULT).unionByName(whole)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


# Repaired conversations

def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted audits and rows to (conversation, result, turn, edit, role, text), and one with no edit at the end of each.

    Holds one audit and a batch of rows.
    """
    conv = result = None
    audit, at, state, is_open = "", 0, START, False

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = _NEXT[state], at + 1
            yield conv, result, None, "I", _ROLES[state], ""

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "result")]
        for conv_id, turn, role, text, copies, found in zip(*columns):
            if found is not None:
                if is_open:
                    yield from inserts()
                    yield conv, result, None, None, None, None
                conv, result, audit, at, state, is_open = conv_id, found, found["audit"], 0, START, True
                continue
            for _ in range(copies):
                yield from inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = _kept_state(state, role[:1])
                elif edit == "R":
                    state = _NEXT[state]
                if edit != "D":
                    yield conv, result, turn, edit, role if edit == "K" else _ROLES[state], text
    if is_open:
        yield from inserts()
        yield conv, result, None, None, None, None


def _beside_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit followed by its rows in order; the one shuffle of the texts."""
    none = F.lit(None)
    result = F.struct(*_RESULT)
    lead = found.select("conv_id", F.lit(False).alias("is_row"), F.lit(False).alias("has_turn"), none.cast("long").alias("turn"),
                        none.cast("string").alias("role"), none.cast("binary").alias("digest"), none.cast("string").alias("text"),
                        none.cast("int").alias("copies"), result.alias("result"))
    body = rows.where("copies > 0").select(
        "conv_id", F.lit(True).alias("is_row"), F.col("turn").isNotNull().alias("has_turn"), "turn", "role",
        _digest(F.col("text")).alias("digest"), "text", "copies", none.cast(lead.schema["result"].dataType).alias("result"))
    return (lead.unionByName(body).repartition("conv_id")
            .sortWithinPartitions("conv_id", "is_row", "has_turn", "turn", "role", "digest")
            .select("conv_id", "turn", "role", "text", "copies", "result"))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations, a row for each turn: conv_id, position, edit (K, R or I), turn (null for an insert), role, text.

    `found` is what `audits` gives for `rows`. A conversation is put together by one task, which reads it as a stream.
    """
    key = _arrow_type(rows)
    schema = pa.schema([("conv_id", key), ("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                        ("role", pa.string()), ("text", pa.string())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, position = [], 0, 0
        for conv, _, turn, edit, role, text in _edited(batches):
            if edit is None:
                position = 0
                continue
            out.append({"conv_id": conv, "position": position, "edit": edit, "turn": turn, "role": role, "text": text})
            position, size = position + 1, size + len(text) + 64
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _beside_audits(rows, found).mapInArrow(build, T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("position", T.LongType()),
        T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType())]))


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with repaired_sha256, of the repaired conversation's `role:text`, joined by newlines.

    A SHA-256 takes its input in order, so a conversation is hashed by one task, as a stream.
    """
    key = _arrow_type(rows)
    schema = pa.schema([("conv_id", key), *((c, pa.int64()) for c in _RESULT[:-1]), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, digest, is_first = [], 0, hashlib.sha256(), True
        for conv, result, _, edit, role, text in _edited(batches):
            if edit is not None:
                digest.update(f"{'' if is_first else chr(10)}{role}:{text}".encode())
                is_first = False
                continue
            out.append({"conv_id": conv, **result, "repaired_sha256": digest.hexdigest()})
            size, digest, is_first = size + len(result["audit"]) + 200, hashlib.sha256(), True
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _beside_audits(rows, found).mapInArrow(build, T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), *(T.StructField(c, T.LongType()) for c in _RESULT[:-1]),
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]))


def _oracle() -> str:
    """DuckDB SQL: every state's (cost, audit) as one text, a recursive step per row."""
    def plus(held: str, more: str, letters: str) -> str:
        return (f"(lpad(cast(cast(substr({held}, 1, 12) as bigint) + {more} as varchar), 12, '0')"
                f" || substr({held}, 13) || '{letters}')")

    ways: dict[int, list[str]] = {state: [] for state in range(4)}
    for start in range(4):
        state = start
        for inserts in range(3):
            lead, held = "I" * inserts, f"p.s{start}"
            ways[state].append(plus(held, f"{5 * inserts + 2}", f"{lead}D"))
            for initial, kept in (("s", 1 if state == 0 else None), ("u", 2 if state != 2 else None), ("a", 3 if state == 2 else None)):
                if kept is not None:
                    ways[kept].append(f"case when not gone and initial = '{initial}'"
                                      f" then {plus(held, f'{5 * inserts} + extra', f'{lead}K')} end")
            after = 3 if state == 2 else 2
            ways[after].append(f"case when not gone then {plus(held, f'{5 * inserts + 1} + extra', f'{lead}R')} end")
            state = after
    steps = ", ".join(f"least({', '.join(ways[state])}) as s{state}" for state in range(4))
    tails = ((0, ""), (10, "II"), (5, "I"), (0, ""))
    final = f"least({', '.join(plus(f's{state}', str(cost), letters) for state, (cost, letters) in enumerate(tails))})"
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), '') as chars
  from conversations),
hashed as (
  select * exclude (chars), xor(list_reduce(list_transform(chars, lambda c: cast(ascii(c) as bigint)),
           lambda crc, byte: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
           4294967295), 4294967295) % 20 as kind
  from keyed),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case kind when 0 then [] when 3 then [1, 2] else [1] end) as copy
  from hashed),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos,
         rtrim(text, {space}) as body
  from damaged),
faulty as (
  select *, substr(role, 1, 1) as initial,
         case when body = '' then 'blank'
              when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
              when right(body, 1) not in ('.', '!', '?') then 'truncated' end as fault,
         lag(substr(role, 1, 1)) over (partition by conv_id order by pos) as before
  from numbered),
walk as (
  select conv_id, cast(0 as bigint) as pos, '000000000000' as s0, cast(null as varchar) as s1, cast(null as varchar) as s2,
         cast(null as varchar) as s3
  from (select distinct conv_id from conversations)
  union all
  select p.conv_id, r.pos, {steps}
  from walk p join (select *, coalesce(fault in ('blank', 'duplicate'), false) as gone,
                           case when fault = 'truncated' then 5 else 0 end as extra from faulty) r
    on r.conv_id is not distinct from p.conv_id and r.pos = p.pos + 1),
ended as (
  select conv_id, {final} as best
  from walk qualify row_number() over (partition by conv_id order by pos desc) = 1),
audited as (
  select conv_id, cast(substr(best, 1, 12) as bigint) as cost, substr(best, 13) as audit from ended),
letters as (
  select conv_id, unnest(string_split(audit, '')) as letter, generate_subscripts(string_split(audit, ''), 1) as i
  from audited where audit <> ''),
placed as (
  select *, sum(case when letter <> 'I' then 1 else 0 end) over upto as row_no,
         sum(case when letter <> 'D' then 1 else 0 end) over upto as out_no
  from letters window upto as (partition by conv_id order by i)),
edited as (
  select p.*, r.role, r.text,
         max(case when p.letter = 'K' and p.out_no = 1 and r.initial = 's' then 1 else 0 end) over (partition by p.conv_id) as has_system
  from placed p left join faulty r on r.conv_id is not distinct from p.conv_id and r.pos = p.row_no and p.letter <> 'I'),
joined as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role when (out_no - has_system) % 2 = 1 then 'user'
           else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by i)) as digest
  from edited where letter <> 'D' group by conv_id),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cost, audit,
       coalesce(digest, sha256('')) as repaired_sha256
from audited a left join counted c on c.conv_id is not distinct from a.conv_id
left join joined j on j.conv_id is not distinct from a.conv_id
"""


ORACLE = _oracle()
