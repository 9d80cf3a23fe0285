"""Literal rows as a table (connection checks, golden micro-tests)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def inline(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str | Sequence[str]) -> DataFrame:
    """A small literal table; only for bounded inputs such as checks and fixtures."""
    return spark.createDataFrame(list(rows), schema=schema)
