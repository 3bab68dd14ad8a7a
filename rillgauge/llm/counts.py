"""Token counts of a sentence-piece vocabulary, each distinct pre-token counted once.

A cut before every run of blanks is safe when no piece holds a blank behind another character, and one between a
Latin letter and a mark when no piece holds the two in a row; both are read off the vocabulary. Documents are read in blocks, and a block gives its distinct
pre-tokens and, packed, how often each occurs in each document. The pre-tokens of all blocks meet by a shuffle,
are counted by the library once each, and the counts are joined to the blocks' frequencies; no ids are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rillgauge.llm.common import ready, row_slices, whole_text

BLOCK_BYTES = 32 << 20  # of text in a block
ROWS = 50_000  # of a batch of pre-tokens
SPACE = "▁"  # fixed value: the letter that stands for a blank in such vocabularies
LATIN = "0-9A-Za-zÀ-ÖØ-öø-ſ"
MARKS = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]


class PieceCounter:
    """Counts pieces; made once per worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_control(i)]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece holds a blank behind another character; texts can't be cut at blanks")
        inner = {m for p in pieces if not p.startswith("<0x") for m in re.findall(rf"(?<=[{LATIN}])\W", p)}
        marks = re.escape("".join(m for m in MARKS if m != "_" and m not in inner))
        #: The pre-tokens of a text that is led by a blank.
        self.pattern = (rf" *[{LATIN}]+(?=[{marks}])|" if marks else "") + " *[^ ]+| +"
        self.letter = len(self.model.encode("a"))

    def __call__(self, pre_tokens: list[str]) -> list[int]:
        """Pieces of each pre-token.

        The library puts a blank in front of a text, which stands for the pre-token's first one. It gives an
        empty text no piece, and a pre-token that was cut off a letter has no blank: these are counted behind a letter.
        """
        behind = [not t.strip(" ") or t[0] != " " for t in pre_tokens]
        found = self.model.encode([f"a{t}" if b else t[1:] for t, b in zip(pre_tokens, behind)], num_threads=1)
        return [len(x) - b * self.letter for x, b in zip(found, behind)]


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    return _COUNTERS.get(path) or _COUNTERS.setdefault(path, PieceCounter(path))


def pre_tokens(text: str, pattern: re.Pattern) -> list[str]:
    """The pre-tokens of a text; an empty text has none."""
    return pattern.findall(" " + text.replace(SPACE, " ")) if text else []


class Block:
    """Documents of one block: how often each of the block's distinct pre-tokens occurs in each."""

    def __init__(self, pattern: re.Pattern):
        self.pattern = pattern
        self.number: dict[str, int] = {}
        self.keys, self.n_bytes, self.distinct, self.local, self.often, self.size = [], [], [], [], [], 0

    def add(self, keys: list, texts: list[str]) -> None:
        number = self.number
        for text in texts:
            found = Counter(pre_tokens(text, self.pattern))
            size = len(text.encode())
            self.n_bytes.append(size)
            self.size += size
            self.distinct.append(len(found))
            self.local.append(np.array([number.setdefault(w, len(number)) for w in found], dtype=np.uint32))
            self.often.append(np.fromiter(found.values(), dtype=np.uint32, count=len(found)))
        self.keys += keys

    def ordered(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, the most frequent first, and the documents' numbers and frequencies."""
        local = np.concatenate([*self.local, np.empty(0, np.uint32)])
        often = np.concatenate([*self.often, np.empty(0, np.uint32)])
        order = np.argsort(-np.bincount(local, minlength=len(self.number)), kind="stable")
        place = np.empty(len(order), dtype=np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.number)
        return [words[i] for i in order], place[local], often


def _blocks(batches, pattern: str):
    """(block id, block) of one task's rows; the id holds the task, the place in it and a mark of the pre-tokens."""
    cut = re.compile(pattern)
    part, n, block = TaskContext.get().partitionId(), 0, Block(cut)

    def name() -> int:
        mark = zlib.crc32("\n".join(block.number).encode(), block.size & 0xFFFFFFFF)
        return (part << 40) + (n << 20) + (mark & 0xFFFFF)

    for batch in batches:
        for rows in row_slices(batch, 1, BLOCK_BYTES // 8):
            block.add(rows.column(0).to_pylist(), rows.column(1).to_pylist())
            if block.size >= BLOCK_BYTES:
                yield name(), block
                n, block = n + 1, Block(cut)
    if block.keys:
        yield name(), block


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    A null or empty text has no bytes and no tokens; texts of any length are counted whole;
    repeated rows give repeated results; a null id stays null; other columns, whatever their
    names, are not read. The frame is read twice and must give its partitions the same rows
    both times, as a scan does; otherwise the query fails.
    """
    ready(docs.sparkSession)
    pattern = counter(path).pattern
    id_kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))

    def words(batches):
        for name, block in _blocks(batches, pattern):
            found = block.ordered()[0]
            for i in range(0, len(found), ROWS):
                part = found[i : i + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), name)),
                        pa.array(np.arange(i, i + len(part)), pa.int32()), pa.array(part, pa.string()),
                    ],
                    names=["block", "number", "word"],
                )

    def count(batches):
        pieces = counter(path)
        for batch in batches:
            for rows in row_slices(batch, 2, BLOCK_BYTES // 8):
                once = rows.column(2).dictionary_encode()  # equal words are neighbours
                each = np.array(pieces(once.dictionary.to_pylist()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(each[once.indices.to_numpy()], pa.int32())],
                    names=["block", "number", "pieces"],
                )

    def frequencies(batches):
        for name, block in _blocks(batches, pattern):
            _, local, often = block.ordered()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.int64()), pa.array([block.keys], pa.list_(id_type)),
                    pa.array([block.n_bytes], pa.list_(pa.int64())), pa.array([block.distinct], pa.list_(pa.int64())),
                    pa.array([_packed(local)], pa.binary()), pa.array([_packed(often)], pa.binary()),
                ],
                names=["block", "keys", "n_bytes", "distinct", "local", "often"],
            )

    def sums(held: pa.Table, counted: pa.Table) -> pa.Table:
        row = held.to_pylist()[0]
        pieces = np.full(counted.num_rows, -1, dtype=np.int64)
        pieces[counted["number"].to_numpy()] = counted["pieces"].to_numpy()
        local = _unpacked(row["local"])
        if len(local) and local.max() >= len(pieces) or (pieces < 0).any():
            raise ValueError("the partitions of the documents changed between two reads")
        total = np.concatenate([[0], np.cumsum(pieces[local] * _unpacked(row["often"]))])
        distinct = np.array(row["distinct"], dtype=np.int64)
        ends = np.cumsum(distinct)
        return pa.table({
            "key": pa.array(row["keys"], id_type), "n_bytes": pa.array(row["n_bytes"], pa.int64()),
            "n_tokens": pa.array(total[ends] - total[ends - distinct], pa.int64()),
        })

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    counted = (
        source.mapInArrow(words, "block bigint, number int, word string")
        .repartition("word").sortWithinPartitions("word")
        .mapInArrow(count, "block bigint, number int, pieces int")
    )
    held = source.mapInArrow(
        frequencies,
        f"block bigint, keys array<{id_kind}>, n_bytes array<bigint>, distinct array<bigint>, local binary, often binary",
    )
    out = held.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        sums, f"key {id_kind}, n_bytes bigint, n_tokens bigint"
    )
    return out.select(F.col("key").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
