"""Wide Parquet export: one folder for each (org, section), each with a schema of its own.

``<base>/data/<run>/org_id_<org>/section_<section>/`` holds ``record_id, org_id, section_id, section_name`` and one text column for
each attribute that the section defines, named by its id. A Spark writer has one schema for all partitions, so the
rows are rebalanced by (org, section), sorted, and each task writes the files of the sections it meets (Arrow batches to
Parquet): one job for all sections, large sections in several tasks and files.

A file is written beside its place and moved there, under a name that follows from the task's partition alone. A task that runs again
replaces its own files, so a lost executor adds no rows. The run's folder is published by one commit (``sinks.versions``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.operators.joins import lookup_join
from sectora.sinks import versions

FILES = "org_id long, section_id long, file string, n_rows long, columns array<string>"
ROWS_PER_GROUP = 100_000


def export_wide(records: DataFrame, attributes: DataFrame, base: str) -> DataFrame:
    """Export ``section_records`` with the ``section_attributes`` list of each section; returns the files written (``FILES``).

    The base must be a folder that all executors reach (``file://``, ``hdfs://``, ``s3://``... as Arrow's file systems know them).
    """
    spark = records.sparkSession
    base = base.rstrip("/")
    before = versions.current(spark, base)
    run = f"{base}/data/{uuid.uuid4().hex}"
    ids = attributes.select("org_id", "section_id", F.transform("attribute_ids", lambda a: a.cast("string")).alias("ids"))
    rows = lookup_join(records, ids, ["org_id", "section_id"], "left", tiebreak=["record_id"])
    rows = rows.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    rows = rows.select("org_id", "section_id", "section_name", "record_id", "ids", F.transform("ids", lambda k: F.try_element_at("attrs", k)).alias("texts"))
    rows = rows.hint("rebalance", "org_id", "section_id").sortWithinPartitions("org_id", "section_id", "record_id")

    def run_task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = (pyarrow.fs.FileSystem.from_uri(run) if "://" in run or run.startswith("file:") else (pyarrow.fs.LocalFileSystem(), run))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
        now, writer, done, held = None, None, [], 0

        def close() -> None:
            nonlocal writer
            if writer is not None:
                writer.close()
                system.move(f"{place}.{TaskContext.get().taskAttemptId()}", place)
                done.append((*now[:2], place, held, list(now[2])))
                writer = None

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                stop = at + 1
                while stop < len(keys) and keys[stop] == keys[at]:
                    stop += 1
                if now is None or now[:2] != keys[at]:
                    close()
                    names = batch.column(4)[at].as_py()
                    now, held = (*keys[at], names), 0
                    folder = f"{root}/org_id_{keys[at][0]}/section_{keys[at][1]}"
                    system.create_dir(folder, recursive=True)
                    place = f"{folder}/part-{part:05d}.parquet"
                    schema = pa.schema([(n, t) for n, t in zip(["record_id", "org_id", "section_id", "section_name"], [types[0], types[0], types[0], pa.string()], strict=True)] + [(n, pa.string()) for n in names])
                    writer = pq.ParquetWriter(system.open_output_stream(f"{place}.{TaskContext.get().taskAttemptId()}"), schema, compression="snappy")
                some = batch.slice(at, stop - at)
                # the texts of all rows lie one after the other, as many for each row as the section has attributes
                flat, wide = some.column(5).flatten(), len(now[2])
                columns = [flat.take(pa.array(range(k, len(flat), wide), pa.int64())) for k in range(wide)]
                table = pa.Table.from_arrays([some.column(3), some.column(0), some.column(1), some.column(2), *columns], schema=schema)
                writer.write_table(table, row_group_size=ROWS_PER_GROUP)
                held += some.num_rows
                at = stop
        close()
        columns = list(zip(*done, strict=True)) if done else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["org_id", "section_id", "file", "n_rows", "columns"])

    files = versions.stage(rows.mapInArrow(run_task, FILES), base, "files")
    versions.commit(spark, base, before, {"wide": run, "files": files})
    return spark.read.parquet(files)


def read_wide(spark: SparkSession, base: str, org_id: int, section_id: int) -> DataFrame:
    """The wide table of one section, from the newest export."""
    run = versions.current(spark, base).paths["wide"]
    return spark.read.parquet(f"{run}/org_id_{int(org_id)}/section_{int(section_id)}")


def read_all(spark: SparkSession, base: str) -> DataFrame:
    """All sections of the newest export under the union of their columns."""
    run = versions.current(spark, base).paths["wide"]
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(run)
