"""Packing token pieces into sequences by linear grouping.

The packing is decided on how many pieces there are of each length, at most ``capacity`` numbers, whatever
the size of the corpus. Large lengths are sorted, split into groups of equal cardinality and rounded up to the largest
of their group; the best mix of configurations of these few sizes is found by linear programming
with generated columns; actual lengths take the rounded ones' places; the small and left-over
ones go best-fit into the space that remains. The plan is a list of runs (so many sequences of the
same lengths). Spark ranks the pieces of each length, in salted shares, and a piece finds its
sequence and offset by its rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rillgauge.llm import bpe
from rillgauge.llm.common import ready, row_slices, whole_text
from rillgauge.session import materialised

GROUPS = 200  # sizes that large lengths are rounded to
LARGE = 4  # a length over capacity / LARGE is large
GAP = 1e-4  # of the linear optimum at which no more configurations are looked for
SHARE = 200_000  # pieces of one length ranked by one task
SLICE_BYTES = 4 << 20


def grouped(counts: dict[int, int], groups: int) -> list[dict[int, int]]:
    """Lengths split into groups of equal cardinality, the largest first; a length may be in two groups."""
    total = sum(counts.values())
    bounds = [total * (g + 1) // groups for g in range(groups)]
    found, at, g = [{}], 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if at >= bounds[g]:
                g += 1
                found.append({})
                continue
            take = min(left, bounds[g] - at)
            found[-1][length] = found[-1].get(length, 0) + take
            at, left = at + take, left - take
    return [x for x in found if x]


def best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of greatest price that fits: a knapsack, size by size over all rooms."""
    value = np.zeros(capacity + 1)
    copies = np.zeros((len(sizes), capacity + 1), dtype=np.int16)
    for g, (size, price) in enumerate(zip(sizes.tolist(), prices.tolist(), strict=True)):
        if price <= 0:
            continue
        before, value = value, value.copy()
        for k in range(1, capacity // size + 1):
            option = before[: capacity + 1 - k * size] + k * price
            better = option > value[k * size :] + 1e-12
            value[k * size :][better] = option[better]
            copies[g, k * size :][better] = k
    made, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for g in range(len(sizes) - 1, -1, -1):
        made[g] = copies[g, room]
        room -= int(made[g] * sizes[g])
    return float(value[capacity]), made


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down from the linear optimum."""
    sizes_, need = np.array(sizes), np.array(demand, dtype=float)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    use = inverse @ need
    for _ in range(4 * len(sizes) + 100):
        price, made = best_configuration(sizes_, inverse.sum(axis=0), capacity)
        if price <= 1 + GAP:
            break
        direction = inverse @ made
        ratios = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratios.argmin())
        columns[:, out] = made
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        use = np.maximum(inverse @ need, 0)
    # Rounded down, and no more than there are of each size.
    found, left = [], np.array(demand, dtype=np.int64)
    for i, n in enumerate(np.floor(use + 1e-7).astype(np.int64)):
        column = columns[:, i].round().astype(np.int64)
        n = min([int(n), *(left[column > 0] // column[column > 0]).tolist()])
        if n > 0:
            found.append((column, n))
            left -= n * column
    return found


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, large: int = LARGE) -> list[tuple[int, tuple[int, ...]]]:
    """Runs (number of sequences, lengths in each) that hold every piece once."""
    counts = {k: n for k, n in counts.items() if n > 0}
    runs: list[tuple[int, tuple[int, ...]]] = []
    if capacity in counts:
        runs.append((counts.pop(capacity), (capacity,)))
    big = {k: n for k, n in counts.items() if k * large > capacity}
    left = defaultdict(int, {k: n for k, n in counts.items() if k not in big})
    open_runs: list[tuple[int, tuple[int, ...]]] = []
    if big:
        parts = grouped(big, groups)
        # Groups that round to the same size are one size.
        merged: dict[int, dict[int, int]] = {}
        for part in parts:
            into = merged.setdefault(max(part), {})
            for k, n in part.items():
                into[k] = into.get(k, 0) + n
        sizes = sorted(merged, reverse=True)
        queues = [deque(sorted(merged[s].items(), reverse=True)) for s in sizes]
        for made, times in configurations(sizes, [sum(merged[s].values()) for s in sizes], capacity):
            slots = [g for g, n in enumerate(made) for _ in range(int(n))]
            while times:  # substitute actual lengths, as many sequences alike at once as there can be
                times = fill(slots, queues, times, open_runs)
        for queue in queues:
            for k, n in queue:
                left[k] += n
    return runs + best_fit(open_runs, left, capacity)


def fill(slots: list[int], queues: list[deque], times: int, out: list) -> int:
    """One run of sequences with the same actual lengths; how many sequences remain to be filled."""
    take = {g: slots.count(g) for g in set(slots)}
    many = min([times, *(queues[g][0][1] // n for g, n in take.items() if queues[g] and queues[g][0][1] >= n)])
    if any(not queues[g] or queues[g][0][1] < n for g, n in take.items()):
        many = 1  # a group's next lengths differ: this sequence takes several
    lengths = []
    for g, n in take.items():
        want = n * many
        while want and queues[g]:
            length, there = queues[g].popleft()
            used = min(want, there)
            lengths += [length] * (used // many)
            want -= used
            if there > used:
                queues[g].appendleft((length, there - used))
    if lengths:
        out.append((many, tuple(lengths)))
    return times - many


def best_fit(runs: list[tuple[int, tuple[int, ...]]], left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Put the left-over lengths, the longest first, into the fullest sequences that can take them."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    rooms: list[int] = []

    def put(times: int, lengths: tuple[int, ...]) -> None:
        room = capacity - sum(lengths)
        if room not in by_room:
            insort(rooms, room)
        by_room[room].append((times, lengths))

    for run in runs:
        put(*run)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                times, lengths = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[i]
            else:
                room, times, lengths = capacity, n, ()
            each = min(room // length, n)
            used = min(times, n // each)
            put(used, lengths + (length,) * each)
            if times > used and lengths:
                put(times - used, lengths)
            n -= used * each
    return [run for found in by_room.values() for run in found]


def cut(
    docs: DataFrame, path: str, ranks_path: str | None = None, split: str | None = None, capacity: int = 2048,
    end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length`` and ``token_ids`` (little-endian unsigned 32-bit).

    A document is its ids and ``end_id``, so that a null or empty text is one piece of one token. A longer
    one than ``capacity`` is cut into pieces of that length, of which the first may be shorter. Repeated
    rows give repeated pieces; a null id stays null; other columns are not read.
    """
    ready(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        coder = bpe.encoder(path, ranks_path, split)
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                keys, piece, start, length, ids = [], [], [], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    whole = coder.encode(text) + end
                    n = len(whole) // 4
                    ends = range(n % capacity or capacity, n + 1, capacity)
                    at = 0
                    for i, to in enumerate(ends):
                        keys.append(key)
                        piece.append(i)
                        start.append(at)
                        length.append(to - at)
                        ids.append(whole[4 * at : 4 * to])
                        at = to
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, part.schema.field(0).type), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    names=["key", "piece", "start", "length", "token_ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))
    out = source.mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, token_ids binary")
    return out.withColumnRenamed("key", id_col)


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; sequences have no gaps.

    ``length`` must be from 1 to ``capacity``. Pieces alike in ``length`` are taken in ``order``;
    which of repeated rows comes first does not matter. The pieces are written to the shared folder once.
    """
    columns = pieces.columns
    # Each stored piece gets a number of its own, so that its rank can be found on narrow rows and joined back.
    pieces = materialised(pieces.withColumn("_piece_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(not 1 <= k <= capacity for k in counts):
        raise ValueError("a piece is empty or longer than a sequence")
    length, first, sequence, offset = [], [], [], []
    ranked, number = defaultdict(int), 0
    for times, lengths in plan(counts, capacity):
        at = 0
        for k in lengths:
            length.append(k)
            first.append(ranked[k])
            sequence.append(number)
            offset.append(at)
            ranked[k] += times
            at += k
        number += times
    places = np.array([length, first, sequence, offset], dtype=np.int64).reshape(4, -1)
    places = places[:, np.lexsort((places[1], places[0]))]

    # The pieces of one length are ranked in shares of about SHARE.
    shares = ",".join(str(-(-counts.get(k, 0) // SHARE) or 1) for k in range(1, capacity + 1))
    salted = pieces.select("length", *order, "_piece_row").withColumn(
        "_share", F.expr(f"pmod(xxhash64({', '.join(order)}), element_at(array({shares}), int(length)))")
    )
    sizes = salted.groupBy("length", "_share").count()
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_share").orderBy(*order)
    ranks = salted.withColumn("_n", F.row_number().over(inside) - 1).join(base, ["length", "_share"])
    ranks = ranks.select("_piece_row", (F.col("_base") + F.col("_n")).alias("_rank"))
    # The whole pieces are shuffled once to meet their ranks, neither sorted nor held by length.
    rows = pieces.join(ranks.hint("shuffle_hash"), "_piece_row").select(*columns, "_rank")
    at_length = columns.index("length")
    keep = len(columns)

    def place(batches):
        lengths, firsts = places[0], places[1]
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            k, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at_length, keep))
            where = np.empty(len(k), dtype=np.int64)
            for value in np.unique(k):
                mine = k == value
                a, b = starts[value], starts[value + 1]
                where[mine] = a + np.searchsorted(firsts[a:b], rank[mine], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(keep)),
                    pa.array(places[2][where] + rank - firsts[where]), pa.array(places[3][where]),
                ],
                names=[*batch.schema.names[:keep], "sequence_id", "offset"],
            )

    schema = StructType([*(pieces.schema[c] for c in columns), StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return rows.mapInArrow(place, schema)
