"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Read a Parquet dataset, descending into nested folders of a table export.

    Selecting ``columns`` right away lets the scan read only those columns; filters
    applied later are pushed into the scan by the optimizer.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    return df.select(*columns) if columns else df
