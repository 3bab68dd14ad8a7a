"""Collocations of each language, counted with double-array tries.

Candidates are found level by level, from two words on: hashes of phrases are summed up, from three words on only where the
phrases of one word less at both ends may be frequent. A table of fixed size, in which every frequent hash marks two bits, says which
phrases may be frequent; as equal hashes and bits only add to them, no frequent phrase is missed (Apriori). The candidates' texts are dealt into shards of bounded bytes, and each shard is built
into a double-array trie over bytes. The tries are broadcast, a few at a time; numpy moves all places of a slice of text whose word is in
the trie's shard through it side by side, a byte at a time, and counts the accepting states they reach at the ends of words. The sums of all
tasks are the exact counts, from which scores are worked out with exact decimals.

A trie's keys are a language, a line break and a phrase of words with one space between them.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import pieces_for, ready, row_slices, whole_text
from rillgauge.llm.substring import Powers, mixed
from rillgauge.session import materialised

LONGEST = 3  # words of a phrase
LEAST = 10  # occurrences of a candidate
COVERED = 50  # percent of a phrase's occurrences in a longer candidate, from which on it is dropped
TOP = 2000  # phrases of a language
SCALE = 1_000_000  # of scores
BITS = 26  # a table of hashes has 2**BITS bits, 8 MB
DIGITS = 36  # bits of the hashes that are summed up
GROUPED = 12  # first bits of them, by which they are dealt; the others and a count up to 255 are one 32-bit number
SHARD_BYTES = 6 << 20  # of keys in a trie, at most (a longer key is alone)
AT_ONCE = 3  # tries broadcast at a time; more need more memory in the workers and fewer passes
SLICE_BYTES = 1 << 19
HELD = 1 << 20  # hashes held by a task before they are summed up and passed on
ROWS = 1 << 18  # of a batch passed on
NO_LANGUAGE = "und"
BLANK, BREAK = 0x20, 0x0A
_KIND = np.zeros(256, dtype=np.uint8)  # 0 in words, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTES = Powers(0x9E3779B97F4A7C15)
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_JOIN = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of a slice of text: ``row`` has each with one byte behind it, a space or, at the end of a piece, a line break."""

    def __init__(self, data: bytes, own: int):
        row = np.frombuffer(data + b"\n", dtype=np.uint8)
        kind = _KIND[row]
        solid = kind == 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
        starts, ends = edges[::2], edges[1::2]
        piece = np.cumsum(kind == 2)[starts]
        self.joined = np.concatenate([piece[1:] == piece[:-1], [False]])[: len(starts)]  # whether the next word follows
        lower = _LOWER[row]
        lower[ends] = np.where(self.joined, BLANK, BREAK)
        solid[ends] = True
        self.row, self.lengths = lower[solid], ends - starts
        self.ends = np.cumsum(self.lengths + 1) - 1
        self.starts = self.ends - self.lengths
        self.own = int(np.searchsorted(starts, own))  # words of this slice; those behind belong to the next

    def hashes(self, lang: bytes) -> np.ndarray:
        up, down = _BYTES.need(len(self.row) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[self.row] * up[:-1], dtype=np.uint64)])
        value = (total[self.ends] - total[self.starts]) * down[self.starts] + self.lengths.astype(np.uint64)
        return mixed(value ^ mixed(np.array([zlib.crc32(lang)], dtype=np.uint64)))

    def longer(self, hashes: np.ndarray, first: np.ndarray, valid: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the phrases of ``words`` words from those of one less, and which of them lie in one piece."""
        follows = np.zeros(len(valid), dtype=bool)
        n = len(valid) - (words - 1)
        if n > 0:
            follows[:n] = valid[:n] & self.joined[words - 2 : words - 2 + n]
        last = np.zeros_like(first)
        if n > 0:
            last[:n] = first[words - 1 :]
        return mixed(hashes * _JOIN + last), follows


def slices(text: bytes, words_behind: int, size: int):
    """(bytes, own bytes) of a text: whole, or in parts cut between words that also hold the next ``words_behind`` words."""
    behind = re.compile(rb"(?:[\x20\x09-\x0D.,;:!?]+[^\x20\x09-\x0D.,;:!?]+){0,%d}" % words_behind)
    between = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
    at = 0
    while len(text) - at > size:
        cut = between.search(text, at + size)
        if not cut:
            break
        end = behind.match(text, cut.start()).end()
        yield text[at:end], cut.start() - at
        at = cut.start()
    yield text[at:], len(text) - at


def grouped(batch: pa.RecordBatch, words_behind: int, size: int):
    """(language, words) of a batch of (language, text): short texts of a language are put together, long ones are cut."""
    for part in row_slices(batch, 1, size):
        held: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text.encode())
        for lang, texts in held.items():
            for data, own in slices(b"\n".join(texts), words_behind, size):
                yield lang.encode(), Words(data, own)


def among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are marked."""
    size = (8 * len(bits)).bit_length() - 1

    def marked(index):
        return ((bits[index >> np.uint64(3)] >> (index & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)

    return marked(hashes >> np.uint64(64 - size)) & marked(hashes >> np.uint64(64 - DIGITS) & np.uint64((1 << size) - 1))


def _likely(words: Words, lang: bytes, tables: list[np.ndarray], longest: int):
    """(number of words, hashes, which may be candidates) level by level; levels beyond the tables are not sifted themselves."""
    first = hashes = words.hashes(lang)
    likely = valid = np.ones(len(first), dtype=bool)
    yield 1, first, likely
    for n in range(2, longest + 1):
        hashes, valid = words.longer(hashes, first, valid, n)
        likely = valid & likely & np.concatenate([likely[1:], [False]])[: len(likely)]
        if n - 2 < len(tables):
            likely = likely & among(tables[n - 2], hashes)
        yield n, hashes, likely


def packed(found: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """(``group``, ``data``): sorted hashes of ``DIGITS`` bits and their counts by groups; a count over 255 takes several numbers."""
    assert DIGITS - GROUPED == 24
    full = (times - 1) // 255
    rows = np.repeat(found, full + 1)
    n = np.full(len(rows), 255, dtype=np.uint64)
    n[np.cumsum(full + 1) - 1] = times - 255 * full
    numbers = ((rows & np.uint64(0xFFFFFF)) << np.uint64(8) | n).astype("<u4")
    edges = np.searchsorted(rows, np.arange((1 << GROUPED) + 1, dtype=np.uint64) << np.uint64(24))
    ends = pa.py_buffer((4 * edges).astype(np.int32))
    data = pa.Array.from_buffers(pa.binary(), 1 << GROUPED, [None, ends, pa.py_buffer(numbers)])
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1 << GROUPED, dtype=np.int32)), data], names=["group", "data"])
    return batch.filter(pa.array(edges[1:] > edges[:-1]))


def unpacked(group: int, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a group, sorted, and the sums of their counts."""
    numbers = np.sort(np.frombuffer(b"".join(data), dtype="<u4"))
    place = numbers >> np.uint32(8)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return (group << 24) + place[first].astype(np.int64), np.add.reduceat((numbers & np.uint32(255)).astype(np.int64), first)


def _frequent(docs: DataFrame, tables, least: int) -> DataFrame:
    """(``h``): hashes of phrases of the first level without a table that ``least`` or more places have.

    Tasks send packed sums by groups of hashes; a group is added up on its own.
    """

    def run(batches):
        held, size = [], 0
        known = [t.value for t in tables]

        def summed():
            return packed(*np.unique(np.concatenate(held) >> np.uint64(64 - DIGITS), return_counts=True))

        for batch in batches:
            for lang, words in grouped(batch, LONGEST - 1, SLICE_BYTES):
                *_, (_, hashes, likely) = _likely(words, lang, known, len(known) + 2)
                held.append(hashes[: words.own][likely[: words.own]])
                size += len(held[-1])
                if size >= HELD:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    def added(batches):
        def often():
            found, times = unpacked(last, held)
            return found[times >= least]

        last, held, out, size = None, [], [], 0
        for batch in batches:
            for group, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and group != last:
                    out.append(often())
                    held, size = [], size + len(out[-1])
                    if size >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["h"])
                        out, size = [], 0
                last = group
                held.append(data)
        if held:
            out.append(often())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["h"])

    rows = docs.mapInArrow(run, "group int, data binary").repartition("group").sortWithinPartitions("group")
    return rows.mapInArrow(added, "h bigint")


def bit_table(hashes: DataFrame) -> np.ndarray:
    """A table of fixed size with the two bits of each hash ``h`` of ``DIGITS`` bits; tasks make parts of it."""
    assert 20 <= BITS < DIGITS
    both = F.array(F.shiftright(F.col("h"), DIGITS - BITS), F.col("h").bitwiseAND((1 << BITS) - 1))
    rows = hashes.select(F.explode(both).alias("bit")).select(
        F.shiftright("bit", 20).alias("part"), F.col("bit").bitwiseAND((1 << 20) - 1).alias("bit")
    )

    def run(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for p in np.unique(part).tolist():
                marks = parts.setdefault(p, np.zeros(1 << 20, dtype=bool))
                marks[at[part == p]] = True
        data = [np.packbits(m, bitorder="little").tobytes() for m in parts.values()]
        if data:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array(data, pa.binary())], names=["part", "bits"])

    bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for row in rows.repartition("part").mapInArrow(run, "part bigint, bits binary").toLocalIterator():
        at = row.part << 17
        bits[at : at + (1 << 17)] |= np.frombuffer(row.bits, dtype=np.uint8)
    return bits


def dealt(hashes: np.ndarray) -> np.ndarray:
    """What a phrase is dealt into shards by: 16 bits of the hash of its language and first word."""
    return (hashes & np.uint64(0xFFFF)).astype(np.int32)


def _named(docs: DataFrame, tables) -> DataFrame:
    """The distinct keys of phrases that may be candidates, and of the words in them."""

    def run(batches):
        known = [t.value for t in tables]
        for batch in batches:
            for lang, words in grouped(batch, LONGEST - 1, SLICE_BYTES):
                levels = list(_likely(words, lang, known, len(known) + 1))
                inside = np.zeros(len(words.starts), dtype=bool)
                inside[: words.own] = levels[1][2][: words.own]
                inside[1:] |= inside[:-1].copy()
                keys = []
                for n, hashes, likely in levels:
                    at = np.flatnonzero(inside) if n == 1 else np.flatnonzero(likely[: words.own])
                    at = _distinct(words, hashes, at, n)
                    ends = words.ends[at + n - 1].tolist()
                    data = words.row.tobytes()
                    keys += [lang + b"\n" + data[s:e] for s, e in zip(words.starts[at].tolist(), ends, strict=True)]
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

    return docs.mapInArrow(run, "key binary").distinct()


def _dealt_keys(keys: DataFrame) -> DataFrame:
    """The keys with ``deal``, see :func:`dealt`."""

    def run(batches):
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            every = batch.column(0).to_pylist()
            for i, key in enumerate(every):
                held.setdefault(key[: key.rindex(b"\n")], []).append(i)
            deal = np.empty(len(every), dtype=np.int32)
            for lang, at in held.items():
                words = b"\n".join(every[i][len(lang) + 1 :].split(b" ", 1)[0] for i in at)
                deal[at] = dealt(Words(words, len(words)).hashes(lang))
            yield pa.RecordBatch.from_arrays([pa.array(deal), batch.column(0)], names=["deal", "key"])

    return keys.mapInArrow(run, "deal int, key binary")


def _distinct(words: Words, hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """One place of each different phrase among the places; phrases of equal hashes are compared by their bytes."""
    if not len(at):
        return at
    _, first, group = np.unique(hashes[at], return_index=True, return_inverse=True)
    other = at[first][group]
    size, same_size = words.ends[at + n - 1] - words.starts[at], words.ends[other + n - 1] - words.starts[other]
    alike = size == same_size
    step = np.arange(size[alike].sum()) - np.repeat(np.cumsum(size[alike]) - size[alike], size[alike])
    left = words.row[np.repeat(words.starts[at[alike]], size[alike]) + step]
    right = words.row[np.repeat(words.starts[other[alike]], size[alike]) + step]
    if len(left):
        alike[np.flatnonzero(alike)] = np.logical_and.reduceat(left == right, np.cumsum(size[alike]) - size[alike])
    return np.concatenate([at[first], at[~alike]])


class Trie:
    """A double-array trie: from state ``s`` the byte ``c`` leads to ``t = base[s] + c`` where ``check[t]`` is ``s``.

    ``ends`` has the state in which each key ends, ``accept`` the number of the key that ends in a state, or -1. State 0 is the start.
    """

    def __init__(self, base: np.ndarray, check: np.ndarray, ends: np.ndarray):
        self.base, self.check, self.ends = base, check, ends
        self.accept = np.full(len(base), -1, dtype=np.int32)
        self.accept[ends] = np.arange(len(ends), dtype=np.int32)

    @classmethod
    def of(cls, keys: list[bytes]) -> Trie:
        """The trie of sorted distinct keys, built a level at a time."""
        flat = np.frombuffer(b"".join(keys), dtype=np.uint8)
        length = np.array([len(k) for k in keys], dtype=np.int64)
        offset = np.cumsum(length) - length

        def levels(state):
            """(live keys, bytes, which differ from the key before in their beginning up to here); ``state`` is set by the caller."""
            live, depth = np.arange(len(keys)), 0
            while len(live := live[length[live] > depth]):
                byte, parent = flat[offset[live] + depth].astype(np.int64), state[live]
                yield live, byte, parent, np.concatenate([[True], (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])])
                depth += 1

        state, states = np.zeros(len(keys), dtype=np.int64), 1
        for live, _, _, fresh in levels(state):
            state[live] = states + np.cumsum(fresh)
            states += int(fresh.sum())
        made, state = _Slots(states), np.zeros(len(keys), dtype=np.int64)
        for live, byte, parent, fresh in levels(state):
            state[live] = made.place(parent[fresh], byte[fresh])[np.cumsum(fresh) - 1]
        return cls(*made.arrays(), state.astype(np.int32))

    def walk(self, data: bytes) -> int | None:
        state = 0
        for byte in data:
            to = int(self.base[state]) + byte
            if self.check[to] != state:
                return None
            state = to
        return state

    def reached(self, words: Words, lang: bytes, place: np.ndarray) -> np.ndarray:
        """Numbers of the keys at the ends of words from each place on."""
        start = self.walk(lang + b"\n")
        if start is None:
            return np.empty(0, dtype=np.int32)
        state = np.full(len(place), start, dtype=np.int32)
        found = []
        while len(place):
            byte = words.row[place]
            ends = (byte == BLANK) | (byte == BREAK)
            found.append(self.accept[state[ends]])
            to = self.base[state] + byte
            goes = (self.check[to] == state) & (byte != BREAK)
            place, state = place[goes] + 1, to[goes]
        every = np.concatenate([*found, np.empty(0, np.int32)])
        return every[every >= 0]


class _Slots:
    """Places of a double array, given out a level of the trie at a time."""

    def __init__(self, states: int):
        self.check = np.full(int(states * 1.3) + 1024, -1, dtype=np.int32)
        self.base = np.zeros(len(self.check), dtype=np.int32)
        self.check[0] = 0  # the start; no byte leads to it, as bases are 1 or more
        self.free = np.arange(256, len(self.check))
        self.at = 0
        self.random = np.random.default_rng(1)

    def grow(self) -> None:
        size = len(self.check)
        self.check = np.concatenate([self.check, np.full(size // 2, -1, dtype=np.int32)])
        self.base = np.concatenate([self.base, np.zeros(size // 2, dtype=np.int32)])
        self.free = np.concatenate([self.free[self.at :], np.arange(size, len(self.check))])
        self.at = 0

    def place(self, parent: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Slots of the children (parent state, byte), those of a parent next to each other."""
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        count = np.diff(np.concatenate([first, [len(parent)]]))
        slots = np.empty(len(parent), dtype=np.int64)
        waiting = np.flatnonzero(count > 1)
        tries = 0
        while len(waiting):
            # All waiting parents try a random base; those whose slots are free, and asked for by no earlier one, stay.
            size = count[waiting]
            owner = np.repeat(np.arange(len(waiting)), size)
            child = np.repeat(first[waiting], size) + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            asked = self.random.integers(1, len(self.check) - 256, len(waiting))[owner] + byte[child]
            taken = self.check[asked] != -1
            order = np.argsort(asked, kind="stable")
            taken[order[1:]] |= asked[order[1:]] == asked[order[:-1]]
            bad = np.bincount(owner, weights=taken, minlength=len(waiting)) > 0
            good = ~bad[owner]
            slots[child[good]] = asked[good]
            self.check[asked[good]] = parent[child[good]]
            self.base[parent[child[good]]] = asked[good] - byte[child[good]]
            waiting = waiting[bad]
            tries += 1
            if tries % 40 == 0:
                self.grow()
        single = first[count == 1]
        while len(single):
            if self.at >= len(self.free):
                self.grow()
            spots = self.free[self.at : self.at + len(single)]
            self.at += len(spots)
            spots = spots[self.check[spots] == -1]
            now, single = single[: len(spots)], single[len(spots) :]
            slots[now] = spots
            self.check[spots] = parent[now]
            self.base[parent[now]] = spots - byte[now]
        return slots

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        used = int(np.flatnonzero(self.check != -1)[-1]) + 1
        size = max(used, int(self.base.max())) + 256
        base, check = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        base[:used], check[:used] = self.base[:used], self.check[:used]
        return base, check


def _tries(keys: DataFrame, shards: int) -> DataFrame:
    """(``shard``, ``trie``, ``keys``, ``base``, ``check``, ``ends``): tries of at most ``SHARD_BYTES`` of keys, by shards of first words."""
    sharded = _dealt_keys(keys).select(F.pmod("deal", F.lit(shards)).cast("int").alias("shard"), "key")

    def run(batches):
        def built(shard, number, held):
            trie = Trie.of(held)
            arrays = [pa.array([a.tobytes()], pa.binary()) for a in (trie.base, trie.check, trie.ends)]
            columns = [pa.array([shard], pa.int32()), pa.array([f"{shard}-{number}"]), pa.array([held], pa.list_(pa.binary())), *arrays]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "trie", "keys", "base", "check", "ends"])

        last, number, held, size = None, 0, [], 0
        for batch in batches:
            for shard, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (shard != last or size + len(key) > SHARD_BYTES):
                    yield built(last, number, held)
                    number, held, size = (number + 1 if shard == last else 0), [], 0
                last = shard
                held.append(key)
                size += len(key)
        if held:
            yield built(last, number, held)

    rows = sharded.repartition("shard").sortWithinPartitions("shard", "key")
    return rows.mapInArrow(run, "shard int, trie string, keys array<binary>, base binary, check binary, ends binary")


def _counted(docs: DataFrame, shared: dict, shards: int) -> DataFrame:
    """(``trie``, ``at``, ``lang``, ``n``): occurrences of the tries' keys, and with no ``at`` the words of each language."""

    def run(batches):
        tries = {name: (shard, Trie(*held.value)) for name, (shard, held) in shared.items()}
        counts, totals = {name: np.zeros(len(trie.ends), dtype=np.int64) for name, (_, trie) in tries.items()}, {}
        for batch in batches:
            for lang, words in grouped(batch, LONGEST - 1, SLICE_BYTES):
                starts, shard_of = words.starts[: words.own], dealt(words.hashes(lang)[: words.own]) % shards
                for name, (shard, trie) in tries.items():
                    found = trie.reached(words, lang, starts[shard_of == shard])
                    counts[name] += np.bincount(found, minlength=len(trie.ends))
                totals[lang] = totals.get(lang, 0) + words.own
        for name, sums in counts.items():
            at = np.flatnonzero(sums)
            nothing = pa.nulls(len(at), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), nothing, pa.array(sums[at])],
                names=["trie", "at", "lang", "n"],
            )
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(totals), pa.string()), pa.nulls(len(totals), pa.int32()),
                pa.array([k.decode() for k in totals], pa.string()), pa.array(list(totals.values()), pa.int64()),
            ],
            names=["trie", "at", "lang", "n"],
        )

    found = docs.mapInArrow(run, "trie string, at int, lang string, n bigint")
    return found.groupBy("trie", "at", "lang").agg(F.sum("n").alias("n"))


def phrase_counts(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``phrase``, ``n``) of every phrase with ``least`` or more occurrences and of the words in them, and (``lang``, ``n``) of all words.

    Phrases have two to ``longest`` words (at most ``LONGEST``). All texts are read once per level from two words on, once for the
    candidates' texts and once per ``AT_ONCE`` tries.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), whole_text(text_col).alias("text"))
    tables = []
    for _ in range(longest - 1):
        likely = _frequent(rows, list(tables), least)
        tables.append(spark.sparkContext.broadcast(bit_table(likely)))  # 8 MB, whatever the input is
    keys = materialised(_named(rows, tables), "keys")
    total = keys.agg(F.coalesce(F.sum(F.octet_length("key")), F.lit(0)).alias("b")).first().b
    shards = min(pieces_for(total, SHARD_BYTES * 3 // 4), 1 << 16)
    tries = materialised(_tries(keys, shards), "tries")
    for table in tables:
        table.destroy()
    counts = totals = None
    names = [r.trie for r in tries.select("trie").toLocalIterator()]
    for i in range(0, len(names), AT_ONCE):
        some = tries.where(F.col("trie").isin(names[i : i + AT_ONCE]))
        shared = {}  # each is bounded by SHARD_BYTES
        for row in some.select("trie", "shard", "base", "check", "ends").toLocalIterator():
            arrays = [np.frombuffer(x, dtype=np.int32) for x in row[2:]]
            shared[row.trie] = row.shard, spark.sparkContext.broadcast(arrays)
        found = materialised(_counted(rows, shared, shards), "counts")
        for _, held in shared.values():
            held.destroy()
        if totals is None:
            totals = found.where("at IS NULL").select("lang", "n")
        part = found.join(some.select("trie", F.posexplode("keys").alias("at", "key")), ["trie", "at"]).select("key", "n")
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        return spark.createDataFrame([], "lang string, phrase string, n bigint"), spark.createDataFrame([], "lang string, n bigint")
    text = F.col("key").cast("string")
    phrase = F.substring_index(text, "\n", -1)
    named = counts.select(F.left(text, F.char_length(text) - F.char_length(phrase) - 1).alias("lang"), phrase.alias("phrase"), "n")
    return materialised(named, "counts"), totals


def part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A null language is ``und``; a null or empty text has no words, repeated rows count each time, an empty table gives no rows. Only the letters
    A to Z are put in lower case. A phrase scores ``a * a / (l * r)`` times ``SCALE`` at its worst cut, ties to the
    first cut. Phrases of which ``covered`` percent or more lie in one longer candidate are dropped. Texts are read whole; other columns are not read.
    """
    counts, totals = phrase_counts(docs, least, longest, lang_col, text_col)
    words = F.split("phrase", " ")
    candidates = counts.where((F.size(words) > 1) & (F.col("n") >= least)).select("lang", "phrase", F.col("n").alias("a"), words.alias("words"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        part(F.col("words"), F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    of_left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    of_right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    parts = cuts.join(of_left, ["lang", "left"]).join(of_right, ["lang", "right"])

    def whole(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    scored = parts.withColumns({"up": whole("a") * whole("a") * F.lit(SCALE).cast("decimal(7,0)"), "down": whole("l") * whole("r")})
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut"))
    size = F.size("words")
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: part(F.col("words"), i, n)),
    )))
    holders = candidates.where(size > 2).select("lang", F.col("a").alias("more"), inner.alias("phrase"))
    held = holders.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    kept = worst.join(held, ["lang", "phrase"], "left").where(
        F.col("more").isNull() | (F.col("more").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered)
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
