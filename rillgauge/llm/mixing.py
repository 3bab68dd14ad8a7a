"""Mixing of sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Every source has a target in words. Whole epochs of a source come first; the rest is drawn without replacement: each
document has the key ``-ln(u) / weight`` of a uniform number ``u`` that hashes give it and of its quality weight, and
the documents with the smallest keys are taken until their words reach the rest. The document on the border is taken in part, so
that a source's words meet its target.

No source is sorted as a whole. Keys fall into classes by their logarithm, which spreads them whatever the weights are; the
words of each (source, class) are summed up, with partial sums in the tasks, and a prefix sum over a source's classes finds the one
on the border. Only the documents of that class are ordered. A source of a third of all rows is one of many classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import whole_text
from rillgauge.operators.sizing import broadcast_if_small
from rillgauge.session import materialised

WEIGHTS = (5, 2, 1)  # of the sources in the order of their names, repeating
SHARE = 1.5  # words of the mix, as a share of all words
MOST = 2  # times a document is taken at most
CLASSES = 4096  # of keys, per doubling of the key
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def sizes(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def uniform(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number between 0 and 1 that follows from the id and the text; 52 bits of a digest."""
    named = F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.encode(text, "UTF-8")))
    digits = F.conv(F.substring(F.md5(F.encode(named, "UTF-8")), 1, 13), 16, 10).cast("bigint")
    return (digits + F.lit(0.5)) / F.lit(float(1 << 52))


def _marked(docs: DataFrame, quality: DataFrame | None, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``row``, ``id``, ``source``, ``size``, ``rank`` (smallest first) and ``class`` of each document."""
    text = whole_text(text_col)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(source_col).alias("source"),
        sizes(text).alias("size"), uniform(F.col(id_col), text, seed).alias("u"),
    )
    if quality is None:
        weighed = rows.withColumn("w", F.lit(1.0))
    else:
        best = quality.select(F.col("doc_id").cast("bigint").alias("q"), F.col("weight").cast("double").alias("w"))
        one = broadcast_if_small(best.where("q IS NOT NULL AND w IS NOT NULL").groupBy("q").agg(F.max("w").alias("w")))
        weighed = rows.join(one, F.col("id") == F.col("q"), "left").drop("q").withColumn("w", F.coalesce("w", F.lit(1.0)))
    rank = F.when(F.col("w") > 0, F.least(-F.log("u") / F.col("w"), F.lit(1e300))).otherwise(F.lit(1e300))
    ranked = weighed.withColumn("rank", F.greatest(rank, F.lit(1e-300))).drop("u", "w")
    return ranked.withColumn("class", F.floor(F.log2("rank") * CLASSES).cast("int"))


def targets(source_sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``target`` of each (``source``, ``source_size``): ``share`` of all words dealt by weight, ``most`` sizes at most.

    What goes beyond a source's limit is dealt by weight among the others until none is above. With the sources in the order of
    limit over weight, those that reach their limit come first, and the others share what is left. The
    table has one row per source and is put in order by one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    deal = F.array(*[F.lit(float(w)) for w in weights])
    named = source_sizes.withColumn("place", (F.row_number().over(by_name) - 1) % len(weights)).select(
        "source", "source_size", F.get(deal, F.col("place")).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = named.withColumns({"n": F.row_number().over(by_limit), "left": left, "weight_left": weight_left})
    is_open = F.col("weight") * F.col("left") / F.col("weight_left") < F.col("limit")
    opened = F.min(F.when(is_open, F.struct("n", "weight_left", "left"))).over(every)
    shared = F.col("weight") * F.col("opened.left") / F.col("opened.weight_left")
    return level.withColumn("opened", opened).select(
        "source", "source_size", F.coalesce(F.least("limit", shared), F.col("limit")).alias("target")
    )


def _plan(marked: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """Per source: its size and target, whole ``epochs``, the ``edge`` class and the words ``due`` of it."""
    sums = materialised(marked.groupBy("source", "class").agg(F.sum("size").alias("words")), "classes")
    total = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = targets(total, weights, share, most).withColumn("whole", F.floor(F.col("target") + 0.5).cast("bigint"))
    aims = materialised(
        aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("whole div source_size")).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("rest", F.col("whole") - F.col("epochs") * F.col("source_size")),
        "targets",
    )
    order = Window.partitionBy("source").orderBy("class")
    reached = sums.withColumn("reached", F.sum("words").over(order)).join(
        aims.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))
    )
    edges = reached.where("rest > 0 AND reached >= rest").groupBy("s").agg(
        F.min(F.struct("class", (F.col("rest") - F.col("reached") + F.col("words")).alias("due"))).alias("edge")
    )
    found = aims.withColumnRenamed("source", "at").join(edges, F.col("at").eqNullSafe(F.col("s")), "left")
    return materialised(
        found.select("at", "source_size", "target", "epochs", F.col("edge.class").alias("edge"), F.col("edge.due").alias("due")), "plan"
    )


def _taken(marked: DataFrame, plan: DataFrame) -> DataFrame:
    """The marked rows with their source's plan, and ``part``: their words taken beyond whole epochs."""
    rows = marked.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("at"))).drop("at")
    order = Window.partitionBy("source").orderBy("rank", F.col("id").asc_nulls_first(), "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = rows.where("class = edge").withColumn(
        "part", F.greatest(F.least(F.col("due") - before, F.col("size")), F.lit(0)).cast("bigint")
    )
    others = rows.where("edge IS NULL OR class != edge").withColumn(
        "part", F.when(F.col("class") < F.col("edge"), F.col("size")).otherwise(F.lit(0)).cast("bigint")
    )
    return inside.unionByName(others)


def mix(
    docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
) -> DataFrame:
    """One row per document: its id, ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    ``quality`` has (``doc_id``, ``weight``): a document of twice the weight is drawn as if it were two chances; unlisted ones
    weigh 1, and those of no positive weight come last. A null text has no words; a null source is a source of its own, after the others in
    order. Rows that repeat an id and a text are rows of their own; which of them is cut does not show. An empty table
    gives no rows. Other columns are not read. The same rows give the same mix, however they are split.
    """
    marked = _marked(docs.select(id_col, text_col, source_col), quality, id_col, text_col, source_col, seed).drop("row")
    marked = materialised(marked, "marked")
    taken = _taken(marked, _plan(marked, weights, share, most))
    return taken.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
    )


def mixed(
    docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row per time that a document is taken.

    The text of the one document of a source that is taken in part is its first words, joined by one space. Documents without a
    word are taken once per whole epoch. See :func:`mix`.
    """
    narrow = _marked(docs.select(id_col, text_col, source_col), quality, id_col, text_col, source_col, seed).drop("row")
    rows = _taken(_marked(docs, quality, id_col, text_col, source_col, seed), _plan(narrow, weights, share, most))
    times = F.col("epochs") + (F.col("part") > 0).cast("bigint")
    each = rows.where(times > 0).withColumn("time", F.explode(F.sequence(F.lit(1), times)))
    cut = (F.col("time") > F.col("epochs")) & (F.col("part") < F.col("size"))
    words = F.filter(F.split(F.col("row")[text_col], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")).otherwise(F.col("row")[text_col])
    return each.select(F.col("row").withField(text_col, text).alias("row")).select("row.*")
