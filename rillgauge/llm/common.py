"""Given tables, worker set-up and small helpers shared by the corpus operators."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The schemas of the given tables.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
# The white space of the contracts, [\x20\x09-\x0D].
WHITE = " \t\n\u000b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package when it was put on the path of the driver alone.

    On a cluster the package comes with ``--py-files`` or the executors' image.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def whole_text(text_col: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text_col), F.lit(""))


def row_slices(batch: pa.RecordBatch, column: int, budget: int):
    """Consecutive slices of a batch of at most ``budget`` bytes of the column, one row at least."""
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > budget:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < len(lengths):
        yield batch.slice(start)


def pieces_for(total_bytes: int, target: int, least: int = 1) -> int:
    """How many pieces of about ``target`` bytes hold so many bytes."""
    return max(least, -(-int(total_bytes) // target))
