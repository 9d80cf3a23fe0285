"""Task analytics of the onboarding page, as DataFrame jobs over a ``tasks`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectora.functions.text import first_present, label

# Labels of task types, statuses and actions shown on the page.
TYPE_LABELS = {"document": "Document Upload", "profile": "Profile Information", "signature": "PDF Signature"}
STATUS_LABELS = {"pending": "Pending", "in_progress": "In Progress", "completed": "Completed"}
ACTION_LABELS = {"document": "Upload Document", "profile": "Complete Section", "signature": "Open Form"}
DEFAULT_ACTION = "Open"
MISSING_VALUE = "—"


def open_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") != F.lit("completed"))


def done_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") == F.lit("completed"))


def split_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks with ``bucket`` = open | completed."""
    return tasks.withColumn(
        "bucket", F.when(F.col("status") == "completed", F.lit("completed")).otherwise(F.lit("open"))
    )


def search_tasks(tasks: DataFrame, query: str, task_type: str = "all") -> DataFrame:
    """Case-insensitive literal substring in title or description, and type = ``task_type`` unless all."""
    q = F.lit(query.lower())
    hit = F.contains(F.lower(F.coalesce("title", F.lit(""))), q) | F.contains(
        F.lower(F.coalesce("description", F.lit(""))), q
    )
    if task_type != "all":
        hit = hit & (F.col("type") == F.lit(task_type))
    return tasks.where(hit)


def js_round(c: Column) -> Column:
    """``Math.round``: halves go up."""
    return F.floor(c + F.lit(0.5)).cast("long")


def task_kpis(tasks: DataFrame, by: Sequence[str] = ("provider_id",)) -> DataFrame:
    """Pending / completed counts, completed per type and the completion rate (percent)."""
    done = F.col("status") == "completed"
    agg = tasks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~done).alias("pending"),
        F.count_if(done).alias("completed"),
        F.count_if(done & (F.col("type") == "document")).alias("completed_documents"),
        F.count_if(done & (F.col("type") == "profile")).alias("completed_profiles"),
        F.count_if(done & (F.col("type") == "signature")).alias("completed_signatures"),
    )
    return agg.withColumn(
        "completion_rate",
        F.when(F.col("total") > 0, js_round(F.lit(100.0) * F.col("completed") / F.col("total"))),
    )


def display_columns(tasks: DataFrame) -> DataFrame:
    """Labels and the display name of each task."""
    return tasks.select(
        "id",
        label(F.col("type"), TYPE_LABELS).alias("type_label"),
        label(F.col("status"), STATUS_LABELS).alias("status_label"),
        label(F.col("type"), ACTION_LABELS, DEFAULT_ACTION).alias("action"),
        first_present(F.col("documentName"), F.col("formName"), F.col("sectionName")).alias("display_name"),
    )


def field_preview(tasks: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` fields of each task with a value, a missing or empty value shown as a dash."""
    head = F.transform(
        F.slice(F.coalesce(F.col("fields"), F.array().cast(tasks.schema["fields"].dataType)), 1, n),
        lambda f: F.struct(f["label"].alias("label"), F.coalesce(F.nullif(f["value"], F.lit("")), F.lit(MISSING_VALUE)).alias("value")),
    )
    return tasks.select("id", head.alias("preview"))
