"""Broadcast only what has been measured to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 256 * 1024 * 1024
_ROW_OVERHEAD = 32


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Rough size of a value: eight bytes a field, and the lengths of texts, at any depth."""
    size = F.lit(8).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = size + F.octet_length(value)
    elif isinstance(kind, T.StructType):
        for field in kind.fields:
            size = size + _bytes(value.getField(field.name), field.dataType)
    elif isinstance(kind, T.ArrayType):
        size = size + F.aggregate(value, F.lit(0).cast("bigint"), lambda n, x: n + _bytes(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        size = size + _bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        size = size + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    return F.coalesce(size, F.lit(8).cast("bigint"))


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size: every field and nested field, and a row overhead."""
    size = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        size = size + _bytes(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("b")).first().b


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size is under the limit.

    Above it the frame is returned as it is: the join shuffles both sides and
    adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
