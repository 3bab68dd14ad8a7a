"""Token ids in binary blocks of shuffled bit or byte planes.

Format: a folder ``blocks`` with one row per block, and a folder ``index``.

* A shard holds documents in ascending id order, shards follow each other in that order. A shard's ids are one
  stream, cut into blocks of a fixed number of ids (the last one may be shorter).
* A block's ids, little-endian unsigned 32-bit, are transposed: plane p holds byte (or bit) p of every id.
  Each plane is compressed with zstandard by itself. Bits are packed with the first id in the highest bit.
* A block row also lists the documents with ids in it: number in the shard, id, first id in the shard, length, and the
  part of it that is here.
* The index has a row per block: shard, block, number of ids, place of the first one in the shard and among all ids, and
  the sizes of the planes.

Spark's writer stores the rows, so that a lost task leaves nothing behind and any store Spark
writes to can hold them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillgauge.llm import bpe
from rillgauge.llm.common import pieces_for, ready, row_slices, whole_text

BLOCK_IDS = 65_536
SHARD_BYTES = 32 << 20  # of text in a shard, about
SLICE_BYTES = 4 << 20
LEVEL = 3
MARKS = ("number", "key", "first", "total", "at", "here")


def to_planes(ids: np.ndarray, bits: bool, level: int = LEVEL) -> list[bytes]:
    """The compressed planes of ids, the lowest byte or bit first."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(rows[:, p]) for p in range(32)]
    else:
        planes = [np.ascontiguousarray(rows[:, p]) for p in range(4)]
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block of n ids."""
    pack = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(pack.decompress(p), dtype=np.uint8) for p in planes]
    if len(planes) == 32:
        bit_rows = np.stack([np.unpackbits(r, count=n) for r in rows], axis=1)
        return np.packbits(bit_rows, axis=1, bitorder="little").view("<u4").ravel()
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


class _Shard:
    """Collects the ids of a shard and gives its full blocks."""

    def __init__(self, bits: bool):
        self.bits, self.number, self.block, self.first = bits, 0, 0, 0
        self.parts: list[np.ndarray] = []
        self.held = 0
        self.marks: list[dict] = []

    def add(self, key, ids: np.ndarray):
        start, at = self.first + self.held, 0
        while at < len(ids):
            take = min(len(ids) - at, BLOCK_IDS - self.held)
            self.marks.append(dict(zip(MARKS, (self.number, key, start, len(ids), at, take), strict=True)))
            self.parts.append(ids[at : at + take])
            self.held += take
            at += take
            if self.held == BLOCK_IDS:
                yield self.row()
        self.number += 1

    def row(self) -> dict:
        ids = np.concatenate(self.parts)
        row = {"block": self.block, "first": self.first, "n_ids": len(ids), "planes": to_planes(ids, self.bits), "docs": self.marks}
        self.block, self.first = self.block + 1, self.first + len(ids)
        self.parts, self.held, self.marks = [], 0, []
        return row


def write(
    docs: DataFrame, folder: str, path: str, ranks_path: str | None = None, split: str | None = None,
    end_id: int = 2, bits: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode the documents, end each with ``end_id``, and write them to a new folder in ascending id order.

    A null id comes first, rows that repeat an id follow each other in the order of their
    texts. A null or empty text is the end id alone. An empty table gives no blocks. Other columns are not read.
    """
    ready(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = pa.int64()
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
        ("planes", pa.list_(pa.binary())),
        ("docs", pa.list_(pa.struct([(m, id_type) for m in MARKS]))),
    ])

    def run(batches):
        coder, shard, number = bpe.encoder(path, ranks_path, split), _Shard(bits), TaskContext.get().partitionId()

        def out(row):
            return pa.RecordBatch.from_pylist([{"shard": number, **row}], schema=schema)

        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    yield from map(out, shard.add(key, np.frombuffer(coder.encode(text) + end, dtype="<u4")))
        if shard.held:
            yield out(shard.row())

    source = docs.select(F.col(id_col).cast("bigint").alias("key"), whole_text(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = (
        source.repartitionByRange(pieces_for(size, SHARD_BYTES), "key").sortWithinPartitions("key", "text")
        .mapInArrow(
            run,
            "shard int, block int, first bigint, n_ids int, planes array<binary>, "
            f"docs array<struct<{','.join(m + ':bigint' for m in MARKS)}>>",
        )
    )
    # The planes are compressed already.
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    stored = spark.read.schema(blocks.schema).parquet(f"{folder}/blocks")
    shards = stored.groupBy("shard").agg(F.sum("n_ids").cast("bigint").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    sizes = stored.select("shard", "block", "n_ids", "first", F.transform("planes", F.octet_length).alias("plane_bytes"))
    sizes.join(offsets, "shard").select(
        "shard", "block", "n_ids", "first", (F.col("offset") + F.col("first")).alias("start"), "plane_bytes"
    ).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document from the files: the id, ``start`` (ids of all documents before it) and ``token_ids``.

    Blocks are decoded where they are read; only documents that lie in several blocks are put together by a shuffle.
    """
    ready(spark)
    stored, index = spark.read.parquet(f"{folder}/blocks"), spark.read.parquet(f"{folder}/index")

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, offset, n, planes, docs = (batch.column(i).slice(row, 1).to_pylist()[0] for i in range(5))
                ids, at, parts = from_planes(planes, n), 0, []
                for d in docs:
                    parts.append(ids[at : at + d["here"]].tobytes())
                    at += d["here"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(docs), pa.int32()), pa.array([d["number"] for d in docs], pa.int64()),
                        pa.array([d["key"] for d in docs], pa.int64()),
                        pa.array([offset + d["first"] for d in docs], pa.int64()),
                        pa.array([d["total"] for d in docs], pa.int64()), pa.array([d["at"] for d in docs], pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["shard", "number", "key", "start", "total", "at", "token_ids"],
                )

    offsets = index.where("block = 0").select("shard", F.col("start").alias("offset"))
    parts = (
        stored.join(offsets, "shard").select("shard", "offset", "n_ids", "planes", "docs")
        .mapInArrow(decode, "shard int, number bigint, key bigint, start bigint, total bigint, at bigint, token_ids binary")
    )
    whole = F.octet_length("token_ids") == 4 * F.col("total")

    def together(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        return pa.table({
            "key": group["key"][:1].cast(pa.int64()), "start": group["start"][:1],
            "token_ids": pa.array([b"".join(group["token_ids"].to_pylist())], pa.binary()),
        })

    joined = parts.where(~whole).groupBy("shard", "number").applyInArrow(
        together, "key bigint, start bigint, token_ids binary"
    )
    return parts.where(whole).select("key", "start", "token_ids").unionByName(joined).withColumnRenamed("key", id_col)
