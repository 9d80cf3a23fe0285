"""The log of report runs: what was built when, from which definition, with what outcome.

The log is append-only: one row for each change of state of a run of a report. Nothing is updated in place, so a driver that
dies leaves a log that says how far it came. Folding the rows by ``max_by`` gives a report's latest state, its status as shown
to a user, the snapshot to read, and what is still to be built.

A run is tied to the definition it was built from by that definition's ``updated_at`` (``defined_at`` here), not by the
clock: a report whose definition changed while it was built is pending again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.sinks.versions import Files

RUNS = "org_id long, report_id long, run_id string, state string, defined_at timestamp_ntz, at timestamp_ntz, path string, error string"
#: States in the order in which one run passes through them.
STATES = ("running", "failed", "completed", "expired")
KEY = ["org_id", "report_id"]


def append(spark: SparkSession, log: str, rows: Iterable[tuple]) -> None:
    """Add rows ``RUNS`` to the log: one file, whole or not at all."""
    rows = list(rows)
    if rows:
        spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(log)


def read(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(log) if Files(spark).exists(log) else spark.createDataFrame([], RUNS)


def _later() -> Column:
    """What orders a report's rows: the definition, the time, the state within one moment."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    return F.struct("defined_at", "at", rank.alias("rank"), "run_id")


def latest(runs: DataFrame) -> DataFrame:
    """The last row of each report (expiry of a snapshot is no state of the report)."""
    fields = [c.split()[0] for c in RUNS.split(", ") if c.split()[0] not in KEY]
    return runs.where("state <> 'expired'").groupBy(*KEY).agg(F.max_by(F.struct(*fields), _later()).alias("run")).select(*KEY, "run.*")


def _with_runs(reports: DataFrame, runs: DataFrame) -> DataFrame:
    """Reports with their last row as ``run``; null if there is none or the definition has changed since."""
    last = latest(runs).select(*KEY, F.struct("run_id", "state", "defined_at", "at", "path", "error").alias("run"))
    joined = reports.join(last, KEY, "left")
    return joined.withColumn("run", F.when(F.coalesce(F.col("run.defined_at") >= F.col("updated_at"), F.lit(False)), F.col("run")))


def states(reports: DataFrame, runs: DataFrame) -> DataFrame:
    """The reports table as a user sees it: ``status``, ``updated_at`` and ``last_run_date`` moved on by the runs."""
    done = runs.where("state = 'completed'").groupBy(*KEY).agg(F.max("at").alias("_done"))
    joined = _with_runs(reports, runs).join(done, KEY, "left")
    return joined.select(
        "report_id", "org_id", "name", "description", F.coalesce("run.state", "status").alias("status"), "created_at",
        F.greatest("updated_at", "run.at").alias("updated_at"), F.greatest("last_run_date", "_done").alias("last_run_date"),
    )


def pending(reports: DataFrame, runs: DataFrame) -> DataFrame:
    """Reports to build: saved and not run since, or left ``running`` by a driver that died."""
    state = F.col("run.state")
    wanted = F.when(state.isNull(), F.col("status") == "created").otherwise(state == "running")
    return _with_runs(reports, runs).where(wanted).select(*reports.columns)


def snapshot_of(runs: DataFrame, org_id: int, report_id: int) -> str | None:
    """Folder of the newest completed run of a report that isn't expired."""
    own = runs.where((F.col("org_id") == F.lit(int(org_id))) & (F.col("report_id") == F.lit(int(report_id))))
    gone = own.where("state = 'expired'").select("run_id")
    found = own.where("state = 'completed'").join(gone, "run_id", "left_anti").agg(F.max_by("path", _later()).alias("path")).first()
    return found.path


def expire(spark: SparkSession, log: str, keep: int = 1, at: dt.datetime | None = None) -> int:
    """Delete the snapshots of all but a report's newest ``keep`` completed runs; returns how many.

    The log learns of it before the folders go, so that no reader is sent to a folder that is being deleted.
    """
    from pyspark.sql import Window

    runs = read(spark, log)
    gone = runs.where("state = 'expired'").select(*KEY, "run_id")
    newest = Window.partitionBy(*KEY).orderBy(_later().desc())
    old = runs.where("state = 'completed'").join(gone, [*KEY, "run_id"], "left_anti").withColumn("place", F.row_number().over(newest)).where(F.col("place") > keep)
    at = at or dt.datetime.now()
    noted = old.select(*KEY, "run_id", F.lit("expired").alias("state"), "defined_at", F.lit(at).cast("timestamp_ntz").alias("at"), "path", F.lit(None).cast("string").alias("error"))
    noted = noted.checkpoint()  # read again after the append, which would change what it is computed from
    n = noted.count()
    if n:
        noted.coalesce(1).write.mode("append").parquet(log)
        files = Files(spark)
        for r in noted.select("path").toLocalIterator():
            files.delete(r.path)
    return n
