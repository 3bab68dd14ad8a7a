"""Exact duplicates by skew-safe combining, with DataFrame functions only.

Rows are first combined inside their task, then per (digest, salt), where the salt is
the number of the task that read them, then the salts' winners globally. Every step
groups by the digest and the whole normalised text, so equal digests of different
texts never meet. A group holding a third of all rows reaches the first shuffle as one row per
task and the second as at most ``SALTS`` rows. When the rows meet their group's winner they are dealt by the
digest and a share, which follows from the id; a group is repeated only for the shares that its rows
have, so a unique text once and a large group up to ``SHARES`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import WHITE, whole_text
from rillgauge.session import materialised

SALTS = 16
SHARES = 60  # bits of a long
TOP, WIDTH = 2**63 - 1, 2**64 + 2  # the largest id, and more than there are ids


def normalised(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``."""
    return F.translate(text, WHITE, "")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def _rank(length: Column, key: Column) -> Column:
    """Greater is better: more code points, then the smaller id, a null id last."""
    turned = F.coalesce(_whole(TOP) - key.cast("decimal(20,0)") + F.lit(1), F.lit(0).cast("decimal(20,0)"))
    return (length.cast("decimal(10,0)") * _whole(WIDTH) + turned).cast("decimal(38,0)")


def _key(rank: Column) -> Column:
    """The id in a rank."""
    turned = rank % _whole(WIDTH)
    return F.when(turned > 0, _whole(TOP) - turned + F.lit(1)).cast("bigint")


def _base(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = whole_text(text_col)
    base = docs.select(
        F.col(id_col).cast("bigint").alias("key"), normalised(text).alias("content"),
        F.char_length(text).alias("length"),
    )
    return base.withColumn("digest", digest(F.col("content"))).withColumn(
        "share", F.pmod(F.xxhash64("key"), F.lit(SHARES)).cast("int")
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per distinct normalised text: ``digest``, ``content``, ``rank`` of its best row, ``size``, ``shares``.

    The bits of ``shares`` say which shares the rows of the text have.
    """
    base = _base(docs, id_col, text_col, digest).select(
        "digest", "content", (F.spark_partition_id() % SALTS).alias("salt"),
        _rank(F.col("length"), F.col("key")).alias("rank"), F.expr("shiftleft(1L, share)").alias("shares"),
    )
    salted = base.groupBy("digest", "content", "salt").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("size"), F.bit_or("shares").alias("shares")
    )
    # Dealt by the digest alone, so that the texts of one digest can be counted without another shuffle.
    return salted.repartition("digest").groupBy("digest", "content").agg(
        F.max("rank").alias("rank"), F.sum("size").alias("size"), F.bit_or("shares").alias("shares")
    )


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and ``digest`` of its normalised text.

    Of equal texts the row with the most code points stays, then the smallest id. A null text is empty, so all empty,
    blank and null texts are one group. A null id ranks after all others. Of rows that repeat the id that stays, the
    longest one is kept, of equal ones any one. An empty table gives no rows. Other columns
    are not read, whatever their names. Ids are integers.
    """
    found = materialised(
        classes(docs, id_col, text_col, digest).groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"), F.max("rank").alias("rank"), F.max("size").alias("size"),
            F.bit_or("shares").alias("shares"),
        ),
        "classes",
    )
    base = _base(docs, id_col, text_col, digest)
    held = F.expr(
        "explode(if(bit_count(shares) = 1, array(cast(round(log2(shares)) as int)),"
        f" filter(sequence(0, {SHARES - 1}), x -> (shiftright(shares, x) & 1) = 1)))"
    )
    one = found.where("texts = 1").select("digest", held.alias("share"), "rank", "size")
    rows = base.select("digest", "share", "key", "length").join(one, ["digest", "share"])
    several = found.where("texts > 1").select("digest")
    if not several.isEmpty():  # different texts under one digest: tell them apart by content
        rows = rows.unionByName(
            base.join(classes(docs, id_col, text_col, digest).join(several, "digest"), ["digest", "content"])
            .select("digest", "share", "key", "length", "rank", "size")
        )
    rows = rows.withColumn("winner", _rank(F.col("length"), F.col("key")) == F.col("rank"))
    first = Window.partitionBy("digest", "share", "key", "winner").orderBy(F.lit(0))
    out = rows.withColumn("kept", (F.row_number().over(first) == 1) & F.col("winner"))
    return out.select(
        F.col("key").alias(id_col), _key(F.col("rank")).alias("keep_id"),
        F.col("size").cast("bigint").alias("group_size"), "kept", "digest",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; see :func:`duplicates` for which they are."""
    found = materialised(duplicates(docs, id_col, text_col), "duplicates")
    kept = found.where("kept").select(F.col(id_col).alias("k"), F.col("digest").alias("d"))
    # The text travels once, inside its row.
    keyed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("key"),
        sha256(normalised(whole_text(text_col))).alias("digest"),
    )

    def same(other: DataFrame) -> Column:
        return (F.col("digest") == other["d"]) & F.col("key").eqNullSafe(other["k"])

    rows = keyed.join(kept, same(kept), "left_semi")
    repeated = found.where(F.col("keep_id").eqNullSafe(F.col(id_col)) & ~F.col("kept")).select(
        F.col(id_col).alias("k"), F.col("digest").alias("d")
    )
    if repeated.isEmpty():
        return rows.select("row.*")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    longest = Window.partitionBy("key", "digest").orderBy(F.char_length(text).desc(), text)
    one = rows.join(repeated, same(repeated), "left_semi").withColumn("n", F.row_number().over(longest)).where("n = 1")
    return rows.join(repeated, same(repeated), "left_anti").select("row").unionByName(one.select("row")).select("row.*")
