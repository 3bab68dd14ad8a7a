"""Repeated passages of words, found by Rabin-Karp hashes of every window.

Documents are dealt into chunks by ranges of their id. Each chunk hashes every window of its whole texts and
sends the distinct hashes, sorted and packed, to hash buckets; a bucket counts in how many chunks
each hash occurs and tells every chunk but the first which of its hashes were seen before. A chunk then
knows, with its own earlier windows, which windows repeat; overlapping ones merge into maximal intervals,
which are removed. A passage that a third of all documents share is one hash per chunk.

The texts are shuffled once, by chunk, and that shuffle serves both passes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgauge.llm.common import pieces_for, ready, whole_text

CHUNK_BYTES = 8 << 20  # of text in a chunk, about; grows with the square root of the corpus
BUCKET_BYTES = 24 << 20  # of text whose windows fall into a bucket, about
SLICE_BYTES = 1 << 20
LONG_WORD = 256  # bytes; a longer word has a cryptographic hash
_BASE, _WINDOW_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so that they have inverses modulo 2**64
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one spread of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, dtype=np.uint64)]), dtype=np.uint64)
                for b in (self.base, pow(self.base, -1, 1 << 64))
            )
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Powers(_BASE), Powers(_WINDOW_BASE)
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of the UTF-8 text, words as ``[^\\x20\\x09-\\x0D]+``.

    Up to ``LONG_WORD`` bytes by a polynomial. Long words can be built that any such polynomial modulo 2^64 takes for
    equal, so those have a cryptographic hash.
    """
    row = np.frombuffer(data, dtype=np.uint8)
    solid = np.concatenate([[False], ~_WHITE[row], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _BYTES.need(len(row) + 1)
    total = _sums(_VALUES[row] * up[:-1])
    found = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        found[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return found


def slices(texts: list[bytes]):
    """(bytes, text numbers) of about ``SLICE_BYTES``: several texts, or parts of a long one cut behind white space."""
    held, size = [], 0
    for text in texts:
        while len(text) > SLICE_BYTES:
            cut = next((i for i in range(SLICE_BYTES, len(text)) if _WHITE[text[i]]), len(text))
            if held:
                yield held
                held, size = [], 0
            yield [text[:cut], None]
            text = text[cut:]
        held.append(text)
        size += len(text) + 1
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after another, and the number of words of each."""
    hashes, counts, open_words = [], [], 0
    for part in slices(texts):
        if part[-1] is None:  # the beginning of a long text
            found = word_hashes(part[0])
            hashes.append(found)
            open_words += len(found)
            continue
        found = word_hashes(b"\n".join(part))
        hashes.append(found)
        for i, text in enumerate(part):
            n = len(text.split())
            counts.append(n + (open_words if i == 0 else 0))
        open_words = 0
    return np.concatenate([*hashes, np.empty(0, np.uint64)]), np.array(counts, dtype=np.int64)


def windows(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows inside one text, in order, and the place of their first words."""
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _WORDS.need(len(hashes))
    total = _sums(hashes * up)
    every = mixed((total[width:] - total[:-width]) * down[: len(hashes) - width + 1])
    ends = np.repeat(np.cumsum(counts), counts)
    at = np.arange(len(every))
    at = at[at + width <= ends[: len(every)]]
    return every[at], at


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _texts(group: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a chunk in the order of the ids, a null one first, rows of one id in that of their texts."""
    keys, texts = group["key"].to_pylist(), [t.encode() for t in group["text"].to_pylist()]
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, texts[i]))
    return [keys[i] for i in order], [texts[i] for i in order]


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_removed``, ``removed`` and ``kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes when a window of ``width`` words that covers it also starts
    earlier, in a document of smaller id or further up in its own; windows are judged on the input. ``removed`` lists
    the maximal intervals of removed words (start, end exclusive), ``kept_text`` has the others joined by blanks.
    A null or empty text has no words; a text shorter than a window keeps all. A null id comes before
    all others; rows that repeat an id are read in the order of their texts, each after the one
    before. An empty table gives no rows. Other columns are not read. Windows are equal when their 64-bit hashes are: among n
    windows about n * n / 2**65 pairs are taken for equal that are not.
    """
    spark = docs.sparkSession
    ready(spark)
    source = docs.select(F.col(id_col).cast("bigint").alias("key"), whole_text(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = pieces_for(size, CHUNK_BYTES)
    buckets = max(1, (pieces_for(size, BUCKET_BYTES) - 1)).bit_length()
    shares = [(i + 1) / n_chunks for i in range(n_chunks - 1)]
    bounds = source.agg(F.percentile_approx("key", shares, max(10_000, 20 * n_chunks))).first()[0] if shares else []
    edges = np.array(bounds or [], dtype=np.int64)

    @F.pandas_udf("int")
    def chunk(key: pd.Series) -> pd.Series:
        return pd.Series(np.where(key.isna(), 0, np.searchsorted(edges, key.fillna(0).astype("int64"), side="left")))

    chunked = source.select(chunk("key").alias("chunk"), "key", "text")

    def sent(group: pa.Table) -> pa.Table:
        found = np.unique(windows(*hashed(_texts(group)[1]), width)[0])
        cuts = np.searchsorted(found, np.arange(1, 1 << buckets, dtype=np.uint64) << np.uint64(64 - buckets))
        parts = [(i, p) for i, p in enumerate(np.split(found, cuts)) if len(p)]
        return pa.table({
            "bucket": pa.array([i for i, _ in parts], pa.int32()),
            "chunk": pa.array([group["chunk"][0].as_py()] * len(parts), pa.int32()),
            "hashes": pa.array([pack(p) for _, p in parts], pa.binary()),
        })

    def seen(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        chunks = group["chunk"].to_numpy()
        found = [unpack(x) for x in group["hashes"].to_pylist()]
        every, owner = np.concatenate(found), np.repeat(np.arange(len(found)), [len(x) for x in found])
        order = np.argsort(every, kind="stable")  # equal hashes in the order of their chunks
        ordered = every[order]
        later = np.sort(order[1:][ordered[1:] == ordered[:-1]])
        owners, starts = np.unique(owner[later], return_index=True)
        return pa.table({
            "chunk": pa.array(chunks[owners], pa.int32()),
            "hashes": pa.array([pack(every[x]) for x in np.split(later, starts[1:])] if len(owners) else [], pa.binary()),
        })

    def removed(group: pa.Table, known: pa.Table) -> pa.Table:
        keys, texts = _texts(group)
        hashes, counts = hashed(texts)
        found, at = windows(hashes, counts, width)
        before = [unpack(x) for x in known["hashes"].to_pylist()]
        _, first = np.unique(found, return_index=True)
        again = np.ones(len(found), dtype=bool)
        again[first] = False
        if before:
            again |= np.isin(found, np.concatenate(before))
        turn = np.zeros(len(hashes) + 1, dtype=np.int32)
        np.add.at(turn, at[again], 1)
        np.add.at(turn, at[again] + width, -1)
        gone = np.cumsum(turn[:-1]) > 0
        ends = np.cumsum(counts)
        n_removed, intervals, kept = [], [], []
        for text, start, end in zip(texts, ends - counts, ends, strict=True):
            mine, words = gone[start:end], text.split()
            if mine.any():
                sides = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                intervals.append([{"start": a, "end": b} for a, b in sides.reshape(-1, 2).tolist()])
                words = [w for w, g in zip(words, mine.tolist(), strict=True) if not g]
            else:
                intervals.append([])
            n_removed.append(int(mine.sum()))
            kept.append(b" ".join(words).decode())
        return pa.table({
            "key": pa.array(keys, pa.int64()), "n_words": pa.array(counts), "n_removed": pa.array(n_removed, pa.int64()),
            "removed": pa.array(intervals, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.string()),
        })

    by_chunk = chunked.groupBy("chunk")
    told = (
        by_chunk.applyInArrow(sent, "bucket int, chunk int, hashes binary")
        .groupBy("bucket").applyInArrow(seen, "chunk int, hashes binary")
    )
    out = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(
        removed,
        "key bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, kept_text string",
    )
    return out.withColumnRenamed("key", id_col)
