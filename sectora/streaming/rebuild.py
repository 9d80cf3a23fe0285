"""Rebuild reports when their definitions change.

Saving a definition emits ``{"orgId": .., "reportId": .., "savedAt": ..}``. The stream reads those events
from a folder of JSON files and rebuilds each named report (``foreachBatch``). Its effects happen once:

* an event that is delivered again, in whatever batch, is dropped by keyed state (organisation, report, time of saving), which a timer
  forgets a day after the event arrived; events are told apart by when they were saved, so a second save is a new event;
* a batch that is replayed after a failure has the same run id, so reports whose outcome is in the run log aren't built again, and a report
  that was being built replaces its own folder;
* a batch's outcomes go to a folder of its own, which a replay replaces.

A batch reads at most ``FILES_PER_BATCH`` files; its reports go through ``rebuild`` a page at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sectora.operators.reports import rebuild

CHANGE_EVENT_SCHEMA = T.StructType([
    T.StructField("orgId", T.LongType()),
    T.StructField("reportId", T.LongType()),
    T.StructField("savedAt", T.TimestampType()),
])
#: How long an event is remembered after it arrived.
REMEMBERED = "1 day"

#: Files of events in a batch: bounds what one batch collects.
FILES_PER_BATCH = 100


def change_events(requests_applied: DataFrame, saved_at: Column | None = None) -> DataFrame:
    """Events for applied requests: ``orgId, reportId, savedAt`` (one per saved definition)."""
    saved = F.lit(None).cast("timestamp") if saved_at is None else saved_at.cast("timestamp")
    return requests_applied.select(F.col("org_id").alias("orgId"), F.col("report_id").alias("reportId"), saved.alias("savedAt"))


def start_rebuild_stream(
    spark: SparkSession,
    events_path: str,
    checkpoint_path: str,
    outcomes_path: str,
    records: Callable[[], DataFrame],
    definitions: Callable[[], dict[str, DataFrame]],
    snapshots_path: str,
    *,
    available_now: bool = True,
    name: str = "batch",
    **build_options,
) -> StreamingQuery:
    """Start the rebuild stream; each batch writes one outcome row per rebuilt report to
    ``outcomes_path`` (``report_id, org_id, status, snapshot_path, error, batch_id``).

    ``records`` and ``definitions`` are called per batch so that every batch sees the latest
    snapshots. ``name`` tells the runs of this stream from those of others.
    """
    files = spark.readStream.schema(CHANGE_EVENT_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH).json(events_path)
    arrived = F.col("_metadata.file_modification_time")
    events = (
        files.select("orgId", "reportId", F.coalesce("savedAt", arrived).alias("savedAt"), arrived.alias("arrived"))
        .where(F.col("orgId").isNotNull() & F.col("reportId").isNotNull())
        .withWatermark("arrived", REMEMBERED).dropDuplicatesWithinWatermark(["orgId", "reportId", "savedAt"])
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        # one row per definition that changed in this batch of files
        pairs = [(r.orgId, r.reportId) for r in batch.select("orgId", "reportId").distinct().toLocalIterator()]
        if not pairs:
            return
        out = rebuild(spark, records(), definitions(), snapshots_path, pairs, run_id=f"{name}-{batch_id}", **build_options)
        out.write.mode("overwrite").parquet(f"{outcomes_path}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
