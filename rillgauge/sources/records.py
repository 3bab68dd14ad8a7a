"""Records of CSV files with line breaks inside quoted fields, put together from splittable line scans.

A record of several lines begins at a line with an odd number of quotes and ends at the next such line. A first scan keeps, per split of a
file, the number of its lines and which of them are odd: one short row a split. Odd lines of a file that are at most ``MOST_LINES``
apart are paired from the first on; one without a partner is a stray quote and a record of its own. So a stray quote
spoils its own line and not the rest of the file, and a record has at most ``MOST_LINES`` lines more than its first.

After that every split knows its spans. Lines outside of them are records as they are and go on in the task that
read them; a scan of its own picks the lines of spans, and only these are shuffled. Files without an odd line are not read this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillgauge.functions import clean
from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.session import materialised

MOST_LINES = 1000  # between the line that opens a quoted field and the one that closes it
BIN_LINES = 128  # lines of a split whose spans are looked through together
PLACE = ["file", "block"]


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of text files: ``value``, ``file`` (path), ``name``, ``block`` (offset of the split) and ``row`` (order inside it)."""
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def is_odd(value: Column) -> Column:
    """Whether a line holds an odd number of quotes."""
    return (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"')))) % 2 == 1


def surveyed(every: DataFrame) -> DataFrame:
    """Per split: its number ``at`` in the file, ``first`` row, lines ``before`` it in the file, and its ``odd`` rows."""
    odd = F.sort_array(F.collect_list(F.when(is_odd(F.col("value")), F.col("row"))))
    splits = every.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), odd.alias("odd"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumns({"at": F.row_number().over(order), "before": F.coalesce(F.sum("n").over(earlier), F.lit(0))})


def broken_files(splits: DataFrame) -> list[str]:
    """The files with an odd line; as many as there are files at most."""
    return [r.file for r in splits.where(F.size("odd") > 0).select("file").distinct().collect()]


def spans(splits: DataFrame, most_lines: int = MOST_LINES) -> DataFrame:
    """(``file``, ``open``, ``close``, ``at``, ``close_at``, ``stray``): line numbers and splits of the odd lines that belong together.

    The odd lines of a file, a few bytes each, are put in order by one task.
    """
    odd = splits.select("file", "at", "first", "before", F.explode("odd").alias("row")).select(
        "file", "at", (F.col("before") + F.col("row") - F.col("first")).alias("line")
    )
    order = Window.partitionBy("file").orderBy("line")
    apart = F.coalesce(F.col("line") - F.lag("line").over(order) > most_lines, F.lit(True))
    group = odd.withColumn("apart", apart).withColumn("group", F.sum(F.col("apart").cast("int")).over(order))
    inside = Window.partitionBy("file", "group").orderBy("line")
    return (
        group.withColumns({
            "place": F.row_number().over(inside), "close": F.lead("line").over(inside), "close_at": F.lead("at").over(inside),
        })
        .where("place % 2 = 1")
        .select(
            "file", F.col("line").alias("open"), F.coalesce("close", "line").alias("close"), "at",
            F.coalesce("close_at", "at").alias("close_at"), F.col("close").isNull().alias("stray"),
        )
    )


def _places(splits: DataFrame, found: DataFrame) -> DataFrame:
    """Per split with a span, and the first one of each file: ``first``, ``before`` and ``spans``, those of every ``BIN_LINES`` lines."""
    inside = found.select("file", "open", "close", "stray", F.explode(F.sequence("at", "close_at")).alias("at")).join(
        splits.select("file", "at", "before", "n"), ["file", "at"]
    )

    def bin_of(line: Column) -> Column:
        return F.floor((line - F.col("before")) / BIN_LINES)

    first, last = bin_of(F.greatest("open", "before")), bin_of(F.least(F.col("close"), F.col("before") + F.col("n") - 1))
    bins = inside.select("file", "at", F.explode(F.sequence(first, last)).alias("bin"), F.struct("open", "close", "stray").alias("span"))
    held = bins.groupBy("file", "at", "bin").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    touched = splits.join(inside.select("file", "at").distinct(), ["file", "at"], "left_semi")
    every_bin = touched.select("file", "at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / BIN_LINES))).alias("bin"))
    lists = every_bin.join(held, ["file", "at", "bin"], "left").groupBy("file", "at").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bin", "spans"))), lambda b: b["spans"]).alias("spans")
    )
    return splits.join(lists, ["file", "at"], "left").where("spans IS NOT NULL OR at = 1").select(*PLACE, "first", "before", "spans")


def assembled(every: DataFrame, splits: DataFrame, most_lines: int = MOST_LINES) -> DataFrame:
    """Records below the header: ``text`` with its line breaks, ``stray``, ``n_lines``, and ``file``, ``name``, ``block``, ``row`` of its first line.

    Blank lines are no records. Later scans must see the same splits as the first, which is checked on the odd lines.
    """
    places = broadcast_if_small(materialised(_places(splits, spans(splits, most_lines)), "spans"))
    at = F.col("row") - F.col("first")
    placed = every.join(places, PLACE, "left").select(clean.once(
        *[F.col(c) for c in ("value", "file", "name", "block", "row")], (F.col("before") + at).alias("line"),
        F.get("spans", F.floor(at / BIN_LINES).cast("int")).alias("near"),
    ))
    span = F.get(F.filter("near", lambda s: (s["open"] <= F.col("line")) & (F.col("line") <= s["close"])), 0)
    marked = placed.select(clean.once(
        *[F.col(c) for c in ("value", "file", "name", "block", "row", "line")], span.alias("span")
    ))
    moved = F.raise_error(F.concat(F.lit("the splits of a file changed between two scans: "), F.col("file"))).cast("boolean")
    known = F.when(is_odd(F.col("value")), moved).otherwise(F.lit(True))
    header = F.coalesce(F.col("line") == 0, F.lit(False))
    alone = marked.where(F.col("span").isNull() & ~header & (F.trim("value") != "") & known).select(
        F.col("value").alias("text"), F.lit(False).alias("stray"), F.lit(1).cast("bigint").alias("n_lines"), "file", "name", "block", "row"
    )
    # A record has its first line's place; a span is at most MOST_LINES long.
    parts = F.sort_array(F.collect_list(F.struct("line", "value")))
    together = marked.where("span IS NOT NULL").groupBy("file", F.col("span.open").alias("open")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"), F.max("span.stray").alias("stray"),
        F.count(F.lit(1)).alias("n_lines"), F.min(F.struct("line", "name", "block", "row")).alias("start"),
    )
    return alone.unionByName(
        together.where("open > 0").select("text", "stray", "n_lines", "file", "start.name", "start.block", "start.row")
    )
