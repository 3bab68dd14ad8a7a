"""Repair of the structure of conversations with Four-Russians block tables.

The roles of a repaired conversation are ``(s?(ua)+)?`` by their initials. What the rows from some row on cost at least is a
vector over the four states that roles can be in; a row maps the vector behind it to the one before it. Less their minimum, only a few
dozen vectors occur, so the map of every block of ``BLOCK`` rows on every vector is worked out once, and costs go backward through a
conversation by one look-up per block. A trace then goes forward, expands each block backward from the vector behind it, and
takes the least edit that stays on a cheapest way, which makes the string of edits the least of all cheapest ones.

Rows are put in order by one range sort over all conversations, so that a conversation of a third of all rows is spread over tasks. Each
task cuts its rows into segments and maps every vector through each segment; two passes over the segments of a conversation, one row
each, tell a segment the vector behind it and the state before it; then all segments are traced on their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgauge.llm.common import ready
from rillgauge.session import materialised

BLOCK = 4  # rows of a block
SEGMENT = 1 << 20  # rows of a segment, at most
RELABEL, REMOVE, ADD, CUT = 3, 4, 3, 3  # costs of Rerole, Delete, Insert, and of a truncated row that stays
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # classes of roles
SYMBOLS, GONE = 9, 8  # a class, 4 more if truncated; or a row that has to go
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
KEPT = {
    (START, SYSTEM): AFTER_SYSTEM, (START, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER,
    (AFTER_USER, ASSISTANT): AFTER_ASSISTANT, (AFTER_ASSISTANT, USER): AFTER_USER,
}
MADE = [AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER]  # the state after an inserted or relabelled row
ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
_LEGAL = np.zeros((4, 4), dtype=bool)
_LEGAL[[SYSTEM, USER, ASSISTANT], [USER, ASSISTANT, USER]] = True


def with_inserts(costs: list[int]) -> list[int]:
    """The least costs when rows may be inserted first."""
    for _ in range(len(costs)):
        costs = [min(c, ADD + costs[MADE[q]]) for q, c in enumerate(costs)]
    return costs


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, in the order of letters."""
    out = [("D", REMOVE, state)]
    if symbol != GONE:
        late = CUT if symbol >= 4 else 0
        if (state, symbol % 4) in KEPT:
            out.append(("K", late, KEPT[state, symbol % 4]))
        out.append(("R", RELABEL + late, MADE[state]))
    return out


class Tables:
    """Vectors of costs less their minimum, the maps of rows and blocks on them, and the edits along a cheapest way.

    ``step`` and ``jump`` give the number of the vector before a row or block, ``rise`` and ``gain`` what its minimum has
    grown by; ``ways[vector behind, symbol, state]`` is the edits (inserts, then the row's own) and the state after them.
    """

    def __init__(self, block: int = BLOCK):
        self.block = block
        far = 10**6
        end = with_inserts([0, far, far, 0])
        vectors, numbers = [tuple(end)], {tuple(end): 0}
        step, rise = [], []
        at = 0
        while at < len(vectors):
            step.append([])
            rise.append([])
            for symbol in range(SYMBOLS):
                costs = self._before(vectors[at], symbol)
                least = min(costs)
                vector = tuple(c - least for c in costs)
                if vector not in numbers:
                    numbers[vector] = len(vectors)
                    vectors.append(vector)
                step[-1].append(numbers[vector])
                rise[-1].append(least)
            at += 1
        self.vectors = vectors
        self.step, self.rise = np.array(step, dtype=np.int32), np.array(rise, dtype=np.int64)
        self.jump, self.gain = self.step, self.rise
        for _ in range(block - 1):  # one more row in front
            rest, won = self.jump, self.gain
            self.jump = self.step[rest].transpose(0, 2, 1).reshape(len(vectors), -1)
            self.gain = (self.rise[rest] + won[:, :, None]).transpose(0, 2, 1).reshape(len(vectors), -1)
        self.ways = [[[self._way(v, s, q) for q in range(4)] for s in range(SYMBOLS)] for v in vectors]
        self.tails = [self._tail(q) for q in range(4)]

    @staticmethod
    def _before(after: tuple, symbol: int) -> list[int]:
        return with_inserts([min(cost + after[to] for _, cost, to in choices(symbol, q)) for q in range(4)])

    def _way(self, after: tuple, symbol: int, state: int) -> tuple[str, int]:
        costs, letters = self._before(after, symbol), ""
        while True:
            for letter, cost, to in choices(symbol, state):
                best = cost + after[to] == costs[state]
                if letter != "D" and costs[state] == ADD + costs[MADE[state]]:
                    break  # an insert comes before K and R
                if best:
                    return letters + letter, to
            letters, state = letters + "I", MADE[state]

    def _tail(self, state: int) -> str:
        letters = ""
        while state in (AFTER_SYSTEM, AFTER_USER):
            letters, state = letters + "I", MADE[state]
        return letters

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the whole blocks of a segment, and the symbols left behind them."""
        n = len(symbols) // self.block * self.block
        weights = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return symbols[:n].reshape(-1, self.block).astype(np.int64) @ weights, symbols[n:]

    def through(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind a segment, the vector before it and what the minimum has grown by."""
        at, won = np.arange(len(self.vectors)), np.zeros(len(self.vectors), dtype=np.int64)
        whole, left = self.blocks(symbols)
        for symbol in left[::-1].tolist():
            won, at = won + self.rise[at, symbol], self.step[at, symbol]
        for block in whole[::-1].tolist():
            won, at = won + self.gain[at, block], self.jump[at, block]
        return at, won

    def behind(self, symbols: np.ndarray, vector: int):
        """The vector behind each row in turn, given the one behind the last; blocks are expanded when they are reached."""
        whole, left = self.blocks(symbols)
        edges = [vector]
        for symbol in left[::-1].tolist():
            edges.append(int(self.step[edges[-1], symbol]))
        tail = edges[:-1][::-1]
        border = np.empty(len(whole), dtype=np.int32)  # behind each block
        at = edges[-1]
        for i in range(len(whole) - 1, -1, -1):
            border[i] = at
            at = self.jump[at, whole[i]]
        for i, at in enumerate(border.tolist()):
            inside = [at]
            for symbol in symbols[i * self.block + self.block - 1 : i * self.block : -1].tolist():
                inside.append(int(self.step[inside[-1], symbol]))
            yield from inside[::-1]
        yield from tail

    def trace(self, symbols: np.ndarray, vector: int, states: list[int]):
        """For each row the edits from each of the given states, which are replaced by those after the row."""
        for symbol, after in zip(symbols.tolist(), self.behind(symbols, vector), strict=True):
            found = [self.ways[after][symbol][q] for q in states]
            states[:] = [to for _, to in found]
            yield [letters for letters, _ in found]


def initial(role: Column) -> Column:
    """Class of a role by its first letter."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with faults planted by crc32 of ``conv_id:turn`` modulo 20; a null counts as one space.

    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user.
    """
    conv, turn, role, text = F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    named = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(named, "UTF-8")) % 20
    fields = rows.select(
        conv, turn, F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), kind.alias("kind"),
    )
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return fields.where("kind != 0").select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, a number in the order of conversation, turn (nulls first), role and text, and their marks.

    ``class``, ``blank``, ``cut`` (truncated) and ``content``, a digest of role and text. Numbers follow each other
    inside a task. Equal rows are dealt apart by a salt, as their order does not matter.
    """
    text = F.col("text")
    marked = rows.select(
        F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumns(
        {
            "class": initial(F.col("role")),
            "blank": ~text.rlike(r"[^\x20\x09-\x0D]"),
            "cut": ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"),
            "content": F.unhex(F.sha2(F.encode(F.concat("role", F.lit("\u0000"), "text"), "UTF-8"), 256)),
            "salt": F.pmod(F.monotonically_increasing_id(), F.lit(4096)),
        }
    )
    keys = ["conv", "turn", "role", "text", "salt"]
    return marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt").withColumn("at", F.monotonically_increasing_id())


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv``, ``at``, ``turn``, ``class``, the first fault of the row and its symbol."""
    firsts = rows.where("NOT blank").groupBy("conv", "content").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    )
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(F.col("class") + F.when(F.col("cut"), 4).otherwise(0))
    narrow = rows.select("conv", "at", "turn", "class", "blank", "cut").join(firsts, "at", "left")
    return narrow.withColumn("fault", fault).withColumn("symbol", symbol).select("conv", "at", "turn", "class", "fault", "symbol")


def _segments(marks: DataFrame) -> DataFrame:
    """The rows of a conversation that follow each other in a task, as one row.

    ``first`` is the ``at`` of its first row; ``to`` and ``won`` say where it takes each vector; ``illegal``
    counts its pairs of roles that may not follow each other, ``head`` and ``last`` are its outermost classes.
    """
    kind = marks.schema["conv"].dataType
    schema = (
        f"conv {kind.simpleString()}, first bigint, symbols binary, to binary, won binary, illegal bigint, head int, last int"
    )

    def run(batches):
        tables, held = Tables(), None

        def closed(segment):
            conv, first, symbols, classes = segment
            symbols, classes = np.concatenate(symbols), np.concatenate(classes)
            to, won = tables.through(symbols)
            wrong = int((~_LEGAL[classes[:-1], classes[1:]]).sum())
            return [conv, first, symbols.tobytes(), to.astype(np.int32).tobytes(), won.tobytes(), wrong, int(classes[0]), int(classes[-1])]

        def batch_of(done):
            columns = list(zip(*done, strict=True))
            kinds = [pa_kind, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
            names = ["conv", "first", "symbols", "to", "won", "illegal", "head", "last"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        pa_kind = None
        for batch in batches:
            conv, at = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            pa_kind, done = conv.type, []
            if not len(at):
                continue
            classes, symbols = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.uint8) for i in (2, 3))
            left, right = conv[:-1], conv[1:]
            same = pc.or_(pc.fill_null(pc.equal(left, right), False), pc.and_(pc.is_null(left), pc.is_null(right)))
            joined = same.to_numpy(zero_copy_only=False) & (at[1:] == at[:-1] + 1)
            edges = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(at)]]).tolist()
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                name = conv[start].as_py()
                while start < end:
                    length = sum(map(len, held[2])) if held else 0
                    follows = held and held[0] == name and held[1] + length == at[start]
                    if not follows or length >= SEGMENT:
                        if held:
                            done.append(closed(held))
                        held, length = (name, int(at[start]), [], []), 0
                    stop = min(end, start + SEGMENT - length)
                    held[2].append(symbols[start:stop])
                    held[3].append(classes[start:stop])
                    start = stop
            if done:
                yield batch_of(done)
        if held:
            yield batch_of([closed(held)])

    rows = marks.select("conv", "at", "class", "symbol").repartitionByRange("at").sortWithinPartitions("at")
    return rows.mapInArrow(run, schema)


def _backward(segments: DataFrame) -> DataFrame:
    """``behind``, the vector behind each segment, and on each conversation's first one its ``cost``; pairs between segments."""
    kind = segments.schema["conv"].dataType.simpleString()

    def run(batches):
        tables = Tables()
        held, at, cost, head = None, 0, 0, -1  # the conversation, the vector before its last seen segment, and so on
        for batch in batches:
            out = []
            for conv, first, number, to, won, wrong, its_head, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held != (conv,):
                    held, at, cost, head = (conv,), 0, 0, -1
                if head >= 0:
                    wrong += int(not _LEGAL[last, head])
                behind, head = at, its_head
                cost += int(np.frombuffer(won, np.int64)[at])
                at = int(np.frombuffer(to, np.int32)[at])
                total = cost + tables.vectors[at][START] if number == 1 else None
                out.append((conv, first, behind, total, wrong))
            if out:
                kinds = [batch.column(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["conv", "first", "behind", "cost", "illegal"])

    opening = segments.groupBy("conv").agg(F.min("first").alias("first")).select("first", F.lit(1).alias("number"))
    rows = segments.join(opening, "first", "left").select("conv", "first", "number", "to", "won", "illegal", "head", "last")
    dealt = rows.repartition("conv").sortWithinPartitions("conv", F.col("first").desc())
    return dealt.mapInArrow(run, f"conv {kind}, first bigint, behind int, cost bigint, illegal bigint")


def _exits(segments: DataFrame) -> DataFrame:
    """The state after each segment for each state before it."""

    def run(batches):
        tables = Tables()
        for batch in batches:
            out = []
            for symbols, behind in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                states = [0, 1, 2, 3]
                for _ in tables.trace(np.frombuffer(symbols, np.uint8), behind, states):
                    pass
                out.append(states)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.list_(pa.int32()))], names=["conv", "first", "exits"])

    kind = segments.schema["conv"].dataType.simpleString()
    return segments.select("conv", "first", "symbols", "behind").mapInArrow(run, f"conv {kind}, first bigint, exits array<int>")


def _forward(exits: DataFrame) -> DataFrame:
    """The state before each segment."""

    def run(batches):
        held, state = None, START
        for batch in batches:
            out = []
            for conv, moves in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if held is None or held != (conv,):
                    held, state = (conv,), START
                out.append(state)
                state = moves[state]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.int32())], names=["first", "entry"])

    dealt = exits.repartition("conv").sortWithinPartitions("conv", "first")
    return dealt.mapInArrow(run, "first bigint, entry int")


def _traced(segments: DataFrame, last: DataFrame) -> DataFrame:
    """Per segment the edits of its rows, and for each row the roles inserted ``before`` it and its own role.

    The own role is null for a deleted row and empty for one that keeps its role. ``tail`` is what is inserted at the end.
    """
    kind = segments.schema["conv"].dataType.simpleString()

    def run(batches):
        tables = Tables()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (2, 3, 4, 5)]
            audits, before, roles, tails = [], [], [], []
            for symbols, behind, entry, ends in zip(*columns, strict=True):
                states, letters, added, own = [entry], [], [], []
                state = entry
                for (edits,) in tables.trace(np.frombuffer(symbols, np.uint8), behind, states):
                    made = []
                    for _ in edits[:-1]:
                        state = MADE[state]
                        made.append(ROLE[state])
                    letters.append(edits)
                    added.append(made)
                    own.append(None if edits[-1] == "D" else "" if edits[-1] == "K" else ROLE[MADE[state]])
                    state = states[0]
                tail = []
                if ends:
                    letters.append(tables.tails[state])
                    for _ in tables.tails[state]:
                        state = MADE[state]
                        tail.append(ROLE[state])
                audits.append("".join(letters))
                before.append(added)
                roles.append(own)
                tails.append(tail)
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(audits, pa.string()), pa.array(before, pa.list_(texts)), pa.array(roles, texts), pa.array(tails, texts)],
                names=["conv", "first", "audit", "before", "roles", "tail"],
            )

    rows = segments.join(last, "first", "left").select("conv", "first", "symbols", "behind", "entry", F.col("ends").isNotNull())
    return rows.mapInArrow(
        run, f"conv {kind}, first bigint, audit string, before array<array<string>>, roles array<string>, tail array<string>"
    )


class Repair:
    """The repair of a frame with ``conv_id``, ``turn``, ``role`` and ``text``.

    Rows of a conversation are taken by turn, nulls first, those of one turn by role and text. A null role or text counts as one space; a
    null ``conv_id`` is a conversation of its own. Rows that repeat role and text are duplicates but the first. An empty table gives
    empty tables. Other columns are not read. What is read several times is written to the shared folder.
    """

    def __init__(self, rows: DataFrame):
        ready(rows.sparkSession)
        self.rows = materialised(ordered(rows), "ordered")
        self.marks = materialised(_symbols(self.rows), "marks")
        segments = materialised(_segments(self.marks), "segments")
        backward = materialised(_backward(segments), "backward")
        self.costs = backward.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
        known = segments.select("conv", "first", "symbols").join(backward.select("first", "behind"), "first")
        entries = _forward(materialised(_exits(known), "exits"))
        ends = segments.groupBy("conv").agg(F.max("first").alias("first")).select("first", F.lit(True).alias("ends"))
        self.edits = materialised(_traced(known.join(entries, "first"), ends), "edits")

    def faults(self) -> DataFrame:
        """Per conversation: its ``gaps`` and numbers of ``blank``, ``duplicate`` and ``truncated`` rows."""
        span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
        counts = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
        return self.marks.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), *counts)

    def audits(self) -> DataFrame:
        """Per conversation: the ``cost`` and the letters of its edits, and ``illegal``."""
        parts = F.sort_array(F.collect_list(F.struct("first", "audit")))["audit"]
        return self.edits.groupBy("conv").agg(F.array_join(parts, "").alias("audit"))

    def repaired(self) -> DataFrame:
        """The rows after the edits: ``conv``, ``at`` and ``place`` (their order), ``role`` and ``text``."""
        made = self.edits.select("first", F.posexplode(F.arrays_zip("before", "roles")).alias("i", "row")).select(
            (F.col("first") + F.col("i")).alias("at"), "row.before", F.col("row.roles").alias("own")
        )

        def empty(roles: Column) -> Column:
            return F.transform(roles, lambda role: F.struct(role.alias("role"), F.lit("").alias("text")))

        joined = self.rows.select("conv", "at", "role", "text").join(made, "at")
        own = F.struct(F.when(F.col("own") == "", F.col("role")).otherwise(F.col("own")).alias("role"), "text")
        stays = F.when(F.col("own").isNotNull(), F.array(own)).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
        body = joined.select("conv", "at", F.posexplode(F.concat(empty(F.col("before")), stays)).alias("place", "row"))
        behind = self.edits.where(F.size("tail") > 0).select(
            "conv", F.lit((1 << 63) - 1).alias("at"), F.posexplode(empty(F.col("tail"))).alias("place", "row")
        )
        return body.unionByName(behind).select("conv", "at", "place", "row.role", "row.text")

    def digests(self) -> DataFrame:
        """Per conversation the sha256 of its repaired ``role:text`` lines; conversations without a row are absent.

        A digest is made of bytes in their order, so this alone streams the rows of a conversation through one task, a line at a time.
        """
        kind = self.rows.schema["conv"].dataType.simpleString()

        def run(batches):
            held, digest, pa_kind = None, None, None
            for batch in batches:
                out, pa_kind = [], batch.column(0).type
                for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held != (conv,):
                        if held is not None:
                            out.append((*held, digest.hexdigest()))
                        held, digest = (conv,), hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa_kind, pa.string()), strict=True)], names=["conv", "sha"])
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa_kind), pa.array([digest.hexdigest()])], names=["conv", "sha"])

        lines = self.repaired().repartition("conv").sortWithinPartitions("conv", "at", "place").select("conv", "role", "text")
        return lines.mapInArrow(run, f"conv {kind}, sha string")


def report(names: DataFrame, repair: Repair) -> DataFrame:
    """One row for each ``conv_id`` of ``names``: faults, ``cost``, ``audit`` and ``repaired_sha256``.

    Conversations without a row have zeros, an empty audit and the digest of nothing.
    """
    parts = [
        names.select(F.col("conv_id").alias("conv")).distinct().withColumn("listed", F.lit(True)),
        repair.faults(), repair.costs, repair.audits(), repair.digests(),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    merged = every.groupBy("conv").agg(
        F.max("listed").alias("listed"), *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha"), F.lit(nothing)).alias("repaired_sha256"),
    )
    return merged.where("listed").drop("listed").withColumnRenamed("conv", "conv_id")
