"""Table sinks.

``write_table`` writes plain Parquet folders (or catalog tables when a name is given). ``replace_table`` writes a typed table whose
contents are switched by one commit (``sinks.versions``), so it exists whole at every moment; ``read_table`` reads it.
``export_sections`` writes one dataset partitioned by org and section with dynamic partition overwrite, so
re-exporting some sections leaves the others.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sectora.functions.text import sanitize_name
from sectora.functions.types import conform, warehouse_columns
from sectora.sinks import versions


class NameCollision(ValueError):
    pass


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with ``sanitize_name`` in one projection; colliding names raise."""
    names = [sanitize_name(c) for c in df.columns]
    dup = [n for n, k in Counter(names).items() if k > 1]
    if dup:
        raise NameCollision(f"sanitised column names collide: {sorted(dup)}")
    return df.toDF(*names)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    *,
    skip_empty: bool = False,
    table: str | None = None,
) -> bool:
    """Write ``df`` as a table. Returns False when nothing was written.

    * ``overwrite``: replace the folder with ``df`` (sanitised names). The new rows are whole before the old ones go, but
      between two renames a reader finds no folder; ``replace_table`` has no such moment.
    * ``append``: add rows; every column is stored as text, as an all-text target expects.
    * ``skip_empty``: an empty ``df`` leaves the existing table untouched.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    if skip_empty and df.isEmpty():
        return False
    out = sanitize_columns(df)
    if mode == "append":
        out = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])
    else:
        # a warehouse table has no nested columns: they become JSON text
        nested = [f.name for f in out.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
        out = out.withColumns({c: F.to_json(c) for c in nested})
    if mode == "overwrite" and not table:
        _switch(out, path.rstrip("/"))
        return True
    writer = out.write.mode(mode).option("compression", "snappy")
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)
    return True


class TypeViolation(ValueError):
    """Rows that don't fit the types of a target; ``path`` holds them with their reasons."""

    def __init__(self, rejected: int, path: str):
        super().__init__(f"{rejected} rows don't fit the table's types, see {path}")
        self.rejected, self.path = rejected, path


@dataclass(frozen=True)
class Replaced:
    version: int
    path: str
    rejected: int
    rejects: str | None


def replace_table(
    df: DataFrame, base: str, columns: Sequence[tuple[str, str]] | None = None, *, table: str | None = None, on_violation: str = "fail"
) -> Replaced:
    """Replace a typed table with ``df`` by one commit.

    ``columns`` are ``(name, warehouse type)``, by default those of ``df``'s schema. Every value is cast to its column's type; rows that
    don't fit (overflow, text of too many bytes, text that is no number) are counted during the write. With
    ``on_violation="fail"`` they are written to a table of rejects, :class:`TypeViolation` is raised and the old contents stay;
    with ``"report"`` the other rows become the table's contents. ``table`` names a catalog table that is pointed
    at the new contents; only a change of its columns makes it anew.
    """
    if on_violation not in ("fail", "report"):
        raise ValueError("on_violation must be fail or report")
    spark, base = df.sparkSession, base.rstrip("/")
    out = sanitize_columns(df)
    before = versions.current(spark, base)
    checked = conform(out, columns or warehouse_columns(out.schema))
    seen = Observation()
    counted = checked.observe(seen, F.count_if(F.size("_violations") > 0).alias("rejected"))
    path = versions.stage(counted.where(F.size("_violations") == 0).drop("_violations"), base, "table")
    rejected, rejects = seen.get["rejected"], None
    if rejected:
        rejects = f"{base}/rejects/{uuid.uuid4().hex}"
        checked.where(F.size("_violations") > 0).write.parquet(rejects)
        if on_violation == "fail":
            versions.Files(spark).delete(path)
            raise TypeViolation(rejected, rejects)
    after = versions.commit(spark, base, before, {"table": path})
    if table:
        _point(spark, table, path)
    return Replaced(after.number, path, rejected, rejects)


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """The current contents of a table that ``replace_table`` wrote."""
    return versions.read(spark, base)["table"]


def _point(spark: SparkSession, table: str, path: str) -> None:
    """Point a catalog table at a folder: one change of its entry, unless its columns change."""
    new = spark.read.parquet(path).schema.simpleString()
    if spark.catalog.tableExists(table):
        if spark.table(table).schema.simpleString() == new:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def export_sections(records: DataFrame, base_path: str) -> None:
    """Snappy Parquet of ``section_records`` under ``org_id=<o>/section_id=<s>``.

    Rows are rebalanced by (org, section), so files have the size that adaptive execution aims at; only the
    partitions present in ``records`` are replaced.
    """
    (
        records.hint("rebalance", "org_id", "section_id")
        .write.mode("overwrite").partitionBy("org_id", "section_id")
        .option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(base_path)
    )


def _switch(df: DataFrame, path: str) -> None:
    """Write beside ``path``, then rename: the old table stays until the new one is whole."""
    staged, old = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "snappy").parquet(staged)
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, jvm.org.apache.hadoop.fs.Path(old)):
        raise OSError(f"can't move {path} away")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target):
        raise OSError(f"can't move {staged} to {path}")
    if had:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)
