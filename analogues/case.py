"""One registered query: how Spark builds it and, where there is one, its plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Case:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
