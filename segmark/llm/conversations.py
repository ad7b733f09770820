"""Conversation repair: the cheapest edits to legal turns by rank-convergence parallel Viterbi.

Legal role sequences are empty or an optional system turn followed by pairs of user and assistant.
Rows are kept (0), given another role (``REROLE``), deleted (``DELETE``), or an empty user or assistant
row is inserted (``INSERT``); blank rows and repeats of an earlier role and text must go, truncated rows
that stay cost ``TRUNCATED`` more.

1. Equal rows of one turn become one row with a count; a second aggregate finds the first turn of each
   role and text. Rows that must go lose their text; they only add to the cost and to the audit.
2. A range sort by conversation and turn deals the rows, so a conversation of any size spreads over
   many tasks. A task cuts its rows into chunks: a conversation's rows in it, ``CHUNK_ROWS`` rows or
   ``CHUNK_BYTES`` of text at most.
3. Backward costs (cheapest way to the end from each of the four states between turns). The last chunk
   of a conversation starts from the true costs, every other from a speculative vector. In fix-up
   passes a chunk whose right neighbour's costs differ from those it started from by more than a
   constant runs again. As a rule two or three passes settle all; without convergence the passes walk
   from chunk to chunk, and the result is the same.
4. With costs right up to a constant, each chunk traces its least edits from every entering state;
   the states are then stitched along the conversation, and the trace of the real one is written.

Edits are ordered like their initials (D, I, K, R); of the cheapest audits the ASCII-least is taken.
Conversations within one task never leave it again; of the others, one small row a chunk is joined.

Defined results: null roles and texts are one space. Rows go by turn, nulls first, then by role, then
by a hash of the text; a role counts by its first character. A null id is a conversation of its own.
Exact copies of rows are duplicates. Empty tables give empty results. Other columns are not read.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from segmark.llm.common import handover, release

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20
SPACE = "[\\x20\\x09-\\x0D]"

#: States between turns: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": 1, "u": 2, "a": 3}
FAR = 1 << 60
END = (0, 6, 3, 0)  # with the inserts that complete a last pair
SPECULATIVE = (0, 0, 0, 0)

Vector = tuple[int, int, int, int]

_PIECE = ("conv_id {id}, part int, no int, alone boolean, codes binary, before array<long>, roles array<string>, texts array<string>, blank long, "
          "duplicate long, truncated long, illegal long, first string, last string, min_turn {turn}, max_turn {turn}, turns long")


# ---- the machine: costs and edits of one row --------------------------------------------
def _moves(code: int) -> list[tuple[str, int, int, int]]:
    """(edit, from, to, cost) of a row: code is its initial's number plus 4 if truncated."""
    initial, more = code & 3, TRUNCATED if code & 4 else 0
    out = [("D", x, x, DELETE) for x in range(4)]
    for x in range(4):
        y = ASSISTANT if x == USER else USER
        out.append(("R", x, y, REROLE + more))
        if initial == (3 if y == ASSISTANT else 2):
            out.append(("K", x, y, more))
    if initial == 1:
        out.append(("K", START, SYSTEM, more))
    return out


def _after_insert(x: int) -> int:
    return ASSISTANT if x == USER else USER


def _normal(v: list[int] | Vector) -> Vector:
    low = min(v)
    return tuple(x - low for x in v)


class Machine:
    """Backward steps and edits, each computed once per (costs after the row, kind of row)."""

    def __init__(self) -> None:
        self.steps: dict[tuple[Vector, int], Vector] = {}
        self.edits: dict[tuple[Vector, int, int], tuple[str, int, int, str]] = {}

    def _full(self, after: Vector, code: int) -> list[int]:
        v = [FAR] * 4
        for _, x, y, cost in _moves(code):
            v[x] = min(v[x], cost + after[y])
        u, a = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
        return [min(v[START], INSERT + u), min(v[SYSTEM], INSERT + u), u, a]

    def before(self, after: Vector, code: int) -> Vector:
        """Costs before a row, up to a constant."""
        key = (after, code)
        if key not in self.steps:
            self.steps[key] = _normal(self._full(after, code))
        return self.steps[key]

    def edit(self, after: Vector, code: int, state: int) -> tuple[str, int, int, str]:
        """Least cheapest edits of a row from ``state``: letters, next state, cost, and the new role
        ('' if the row is deleted, '=' if it keeps its own)."""
        key = (after, code, state)
        if key not in self.edits:
            here = self._full(after, code)
            letters, cost, x = "", 0, state
            while True:
                options = [(e, y, c) for e, f, y, c in _moves(code) if f == x and c + after[y] == here[x]]
                y = _after_insert(x)
                if INSERT + here[y] == here[x]:
                    options.append(("I", y, INSERT))
                e, y, c = min(options)
                letters, cost, x = letters + e, cost + c, y
                if e != "I":
                    role = {"D": "", "K": "="}.get(e, "assistant" if y == ASSISTANT else "user")
                    self.edits[key] = (letters, x, cost, role)
                    break
        return self.edits[key]

    def costs(self, codes: bytes, right: Vector) -> list[Vector]:
        """Costs after each row of a chunk, from its right end; the last entry is the cost before all."""
        out = [right]
        for code in reversed(codes):
            out.append(self.before(out[-1], code))
        return out


def _inserted(state: int, n: int) -> list[str]:
    out = []
    for _ in range(n):
        state = _after_insert(state)
        out.append("assistant:" if state == ASSISTANT else "user:")
    return out


def trace(machine: Machine, codes: bytes, right: Vector, state: int) -> tuple[int, int, list[tuple[str, int, str]]]:
    """Exit state, cost, and per row (letters, state before it, new role)."""
    after = machine.costs(codes, right)
    cost, rows = 0, []
    for i, code in enumerate(codes):
        letters, y, c, role = machine.edit(after[len(codes) - 1 - i], code, state)
        rows.append((letters, state, role))
        state, cost = y, cost + c
    return state, cost, rows


# ---- rows and faults --------------------------------------------------------------------
def _at(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def flagged_rows(df: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text) with its count m and its first copy's fault."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    distinct = df.select("conv_id", "turn", role.alias("role"), text.alias("text")).groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("m"))
    keys = [F.xxhash64("conv_id", "role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role", "conv_id").alias("h2")]
    distinct = handover(distinct.select("*", *keys), "turns-distinct")
    again = distinct.groupBy("h1", "h2").agg(F.min(_at(F.col("turn"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    seen = distinct.join(again, ["h1", "h2"], "left")
    visible = F.regexp_replace("text", f"{SPACE}+$", "")
    fault = F.when(visible == "", "blank").when(_at(F.col("turn")) > F.col("first"), "duplicate").when(
        ~F.right(visible, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    rows = seen.withColumn("fault", fault).select("conv_id", "turn", "role", F.md5(F.encode("text", "UTF-8")).alias("k"), "m", "fault",
                                                  F.when(~F.col("fault").isin("blank", "duplicate"), F.col("text")).alias("text"))
    out = handover(rows, "turns-flagged")
    release(df.sparkSession, distinct)
    return out


class _Chunk:
    """Consecutive rows of one conversation in one task."""

    def __init__(self, conv) -> None:
        self.conv, self.rows, self.size = conv, 0, 0
        self.codes, self.before, self.roles, self.texts = bytearray(), [0], [], []
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.first, self.last = 0, None, None
        self.turns: list = []  # least, largest, how many

    def add(self, turn, role: str, m: int, fault: str, text: str | None) -> None:
        c = role[:1]
        if self.first is None:
            self.first = c
        elif self.last + c not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += m - 1
        self.last = c
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        if fault:
            self.count[fault] += 1
        if m > 1:
            self.count["blank" if fault == "blank" else "duplicate"] += m - 1
        if text is None:
            self.before[-1] += m
        else:
            self.codes.append(INITIALS.get(c, 0) | (4 if fault == "truncated" else 0))
            self.roles.append(role)
            self.texts.append(text)
            self.before.append(m - 1)
            self.size += len(text)
        self.rows += 1

    def full(self) -> bool:
        return self.rows >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def row(self, part: int, no: int, alone: bool) -> tuple:
        low, high, n = self.turns or (None, None, 0)
        return (self.conv, part, no, alone, bytes(self.codes), self.before, self.roles, self.texts, self.count["blank"], self.count["duplicate"],
                self.count["truncated"], self.illegal, self.first, self.last, low, high, n)


def chunks(rows: DataFrame) -> DataFrame:
    """The flagged rows as chunks, in order of (part, no). ``alone``: the whole conversation."""
    order = ["conv_id", "turn", "role", "k"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = _PIECE.format(id=kind["conv_id"], turn=kind["turn"])
    types = to_arrow_schema(StructType.fromDDL(schema))
    names = types.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        now: _Chunk | None = None
        whole = False  # the present conversation began inside this task and in the present chunk

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), types.field(i).type) for i, c in enumerate(zip(*found, strict=True))], names=names)

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "m", "fault", "text")]
            for conv, turn, role, m, fault, text in zip(*cols, strict=True):
                if now is None:
                    now = _Chunk(conv)
                elif conv != now.conv:
                    held.append(now.row(part, no, whole))
                    now, no, whole = _Chunk(conv), no + 1, True
                elif now.full():
                    held.append(now.row(part, no, False))
                    now, no, whole = _Chunk(conv), no + 1, False
                now.add(turn, role, m, fault, text)
            if held:
                yield batch_of(held)
                held = []
        if now is not None:
            yield batch_of([now.row(part, no, False)])

    return dealt.select("conv_id", "turn", "role", "m", "fault", "text").mapInArrow(run, schema)


# ---- fix-up passes and tracing ----------------------------------------------------------
def _rerun(df: DataFrame) -> DataFrame:
    """``df`` (.., codes, right) with ``left``, the costs before the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine()
        for batch in batches:
            left = [list(machine.costs(c, tuple(r))[-1]) for c, r in zip(batch.column("codes").to_pylist(), batch.column("right").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(left, pa.list_(pa.int64()))], names=[*batch.schema.names, "left"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kind}, left array<long>")


def _vector(v: Vector) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in v])


def settled_costs(chain: DataFrame) -> DataFrame:
    """(conv_id, part, no, codes, right): the true costs after each chunk, up to a constant.

    ``chain`` holds the chunks, with rows to edit, of conversations that may have several.
    """
    spark = chain.sparkSession
    order = Window.partitionBy("conv_id").orderBy("part", "no")
    last = F.lead("no").over(order).isNull()
    now = handover(_rerun(chain.select("conv_id", "part", "no", "codes", F.when(last, _vector(END)).otherwise(_vector(SPECULATIVE)).alias("right"))), "turn-costs")
    while True:
        given = F.coalesce(F.lead("left").over(order), _vector(END))
        checked = now.withColumn("given", given)
        wrong = checked.where(F.col("given") != F.col("right"))
        if wrong.isEmpty():
            return now.drop("left")
        again = _rerun(wrong.select("conv_id", "part", "no", "codes", F.col("given").alias("right")))
        after = handover(checked.where(F.col("given") == F.col("right")).drop("given").unionByName(again), "turn-costs")
        release(spark, now)
        now = after


def entering_states(settled: DataFrame) -> DataFrame:
    """(conv_id, part, no, right, state): the state in which the least trace enters each chunk."""

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine()
        for batch in batches:
            out = [[trace(machine, c, tuple(r), x)[0] for x in range(4)]
                   for c, r in zip(batch.column("codes").to_pylist(), batch.column("right").to_pylist(), strict=True)]
            keep = ["conv_id", "part", "no", "right"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out, pa.list_(pa.int32()))], names=[*keep, "exits"])

    kind = settled.schema["conv_id"].dataType.simpleString()
    maps = settled.mapInArrow(exits, f"conv_id {kind}, part int, no int, right array<long>, exits array<int>")

    def stitch(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("no", "ascending")])
        state, out = START, []
        for row in table.column("exits").to_pylist():
            out.append(state)
            state = row[state]
        return table.drop_columns(["exits"]).append_column("state", pa.array(out, pa.int32()))

    return maps.groupBy("conv_id").applyInArrow(stitch, f"conv_id {kind}, part int, no int, right array<long>, state int")


def _written(keep: list[str]) -> Callable:
    """Chunks with right and state to ``keep`` plus audit, lines, out (state) and cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine()
        for batch in batches:
            got = [batch.column(c).to_pylist() for c in ("codes", "before", "roles", "texts", "right", "state")]
            audits, lines, outs, costs = [], [], [], []
            for codes, before, roles, texts, right, state in zip(*got, strict=True):
                out, cost, rows = trace(machine, codes, tuple(right), state)
                audit, said = ["D" * before[0]], []
                for (letters, at, role), own, text, gone in zip(rows, roles, texts, before[1:], strict=True):
                    audit.append(letters + "D" * gone)
                    said += _inserted(at, letters.count("I"))
                    if role:
                        said.append(f"{own if role == '=' else role}:{text}")
                audits.append("".join(audit))
                lines.append("\n".join(said) if said else None)
                outs.append(out if codes else None)
                costs.append(cost + DELETE * sum(before))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(audits, pa.string()), pa.array(lines, pa.string()), pa.array(outs, pa.int32()), pa.array(costs, pa.int64())],
                names=[*keep, "audit", "lines", "out", "cost"])

    return run


def _traced(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c not in ("codes", "before", "roles", "texts", "right", "state", "alone")]
    kind = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.mapInArrow(_written(keep), f"{kind}, audit string, lines string, out int, cost long")


COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _finished(df: DataFrame) -> DataFrame:
    """Conversations with their last inserts: conv_id, gaps, counts, cost, audit, repaired."""
    missing = F.when(F.col("out") == SYSTEM, 2).when(F.col("out") == USER, 1).otherwise(0)
    ends = F.when(F.col("out") == SYSTEM, F.lit("user:\nassistant:")).when(F.col("out") == USER, F.lit("assistant:"))
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return df.select("conv_id", gaps.alias("gaps"), *COUNTS[:-1], (F.col("cost") + INSERT * missing).cast("long").alias("cost"),
                     F.concat("audit", F.repeat(F.lit("I"), missing)).alias("audit"), F.concat_ws("\n", "lines", ends).alias("repaired"))


def repair_conversations(df: DataFrame) -> DataFrame:
    """Per conversation of ``df`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal,
    cost, audit and repaired (``role:text`` lines)."""
    spark = df.sparkSession
    rows = flagged_rows(df)
    pieces = handover(chunks(rows), "turn-chunks")
    release(spark, rows)
    # A task's first and last conversation may go on in another task: their chunks are few.
    open_ = pieces.where(~F.col("alone"))
    right = settled_costs(open_.where(F.length("codes") > 0))
    entry = handover(entering_states(right), "turn-states")
    release(spark, right)
    e = entry.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("no").alias("_no"), "right", "state")
    at = (F.col("part") == F.col("_part")) & (F.col("no") == F.col("_no")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    joined = open_.join(e, at, "left").drop("_conv", "_part", "_no").withColumns({
        "right": F.coalesce("right", _vector(END)), "state": F.coalesce("state", F.lit(START))})
    order = Window.partitionBy("conv_id").orderBy("part", "no")
    before = F.lag("last").over(order)
    broken = F.when(before.isNotNull() & ~F.concat(before, F.col("first")).isin("su", "ua", "au"), 1).otherwise(0)
    shared = F.when(F.lag("max_turn").over(order) == F.col("min_turn"), 1).otherwise(0)
    parts = _traced(joined).withColumns({"illegal": F.col("illegal") + broken, "turns": F.col("turns") - shared})
    listed = F.array_sort(F.collect_list(F.struct("part", "no", "audit", "lines", "out")))
    whole = parts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in COUNTS], F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"),
                                         F.sum("turns").alias("turns"), listed.alias("l"))
    outs = F.filter("l.out", lambda x: x.isNotNull())
    spanning = whole.withColumns({
        "audit": F.array_join("l.audit", ""), "out": F.element_at(F.concat(F.array(F.lit(START)), outs), -1),
        "lines": F.when(F.exists("l.lines", lambda x: x.isNotNull()), F.array_join("l.lines", "\n"))})
    alone = _traced(pieces.where("alone").withColumns({"right": _vector(END), "state": F.lit(START)}))
    return _finished(alone).unionByName(_finished(spanning))


# ---- the query's damage -----------------------------------------------------------------
def damaged(df: DataFrame) -> DataFrame:
    """Rows of ``df`` damaged by crc32(`conv_id:turn`) % 20: dropped, emptied, stripped of full stops, repeated, given to the user."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))), F.lit(20))
    rows = df.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def repaired_after_damage(df: DataFrame) -> DataFrame:
    """The repair of the damaged rows for every conversation of ``df``, those without a row left included."""
    done = repair_conversations(damaged(df)).withColumnRenamed("conv_id", "_conv")
    every = df.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("gaps", *COUNTS)}
    return every.withColumns({**zero, "audit": F.coalesce("audit", F.lit("")), "repaired": F.coalesce("repaired", F.lit(""))}).drop("_conv")
