"""Table inspector: typed predicates, column choice and the first rows."""

from __future__ import annotations

import logging
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

COMPARISONS = {
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}

Filter = tuple[str, str, object]


def predicate(df: DataFrame, filters: Sequence[Filter]) -> Column:
    """All filters combined with AND, each value cast to the type of its column."""
    combined = F.lit(True)
    for name, op, value in filters:
        if name not in df.columns:
            raise ValueError(f"no such column: {name}")
        kind = df.schema[name].dataType
        if op in ("in", "not in"):
            if isinstance(value, str):  # from the command line: values parted by commas
                value = [v.strip() for v in value.split(",")]
            listed = F.col(name).isin([F.lit(v).cast(kind) for v in value])
            combined = combined & (listed if op == "in" else ~listed)
        elif op in COMPARISONS:
            combined = combined & COMPARISONS[op](F.col(name), F.lit(value).cast(kind))
        else:
            raise ValueError(f"unknown operator: {op}")
    return combined


def existing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Requested columns the table has; unknown ones are reported and dropped."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        log.warning("columns not found: %s", unknown)
    known = [c for c in columns if c in df.columns]
    if not known:
        raise ValueError("none of the requested columns exist")
    return known


def inspect(
    df: DataFrame, columns: Sequence[str] | None = None, filters: Sequence[Filter] = (),
    rows: int | None = 10,
) -> DataFrame:
    """Rows passing the filters, in the requested columns, at most ``rows`` of them."""
    result = df.filter(predicate(df, filters)) if filters else df
    if columns:
        result = result.select(*existing_columns(df, columns))
    return result if rows is None else result.limit(rows)
