"""Active-row filters and the record/value context joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.operators.joins import lookup_join
from sectora.sources.eav import Eav


def not_deleted(flag: str) -> F.Column:
    """``flag IS NULL OR flag = false``."""
    return ~F.coalesce(F.col(flag), F.lit(False))


def active_records(records: DataFrame) -> DataFrame:
    return records.where(not_deleted("record_is_deleted"))


def active_sections(sections: DataFrame) -> DataFrame:
    """Not deleted (null counts as not deleted) and active (null counts as active)."""
    return sections.where(not_deleted("section_is_deleted") & F.coalesce(F.col("section_is_active"), F.lit(True)))


def for_org(df: DataFrame, org_id: int) -> DataFrame:
    """Restrict a table to one tenant; on a table partitioned by org this prunes partitions."""
    return df.where(F.col("org_id") == F.lit(int(org_id)).cast("long"))


def for_section(df: DataFrame, org_id: int, section_id: int) -> DataFrame:
    return for_org(df, org_id).where(F.col("section_id") == F.lit(int(section_id)).cast("long"))


def section_context(eav: Eav) -> DataFrame:
    """Active records of active sections: ``record_id, org_id, section_id, section_name, provider_id``.

    Records stay where they are while the sections are under the broadcast threshold; beyond it the records of
    large sections are salted (``lookup_join``).
    """
    sections = active_sections(eav.sections).select("section_id", "section_name")
    joined = lookup_join(active_records(eav.records), sections, ["section_id"], tiebreak=["record_id"])
    return joined.select("record_id", "org_id", "section_id", "section_name", "provider_id")


def values_with_context(eav: Eav, context: DataFrame | None = None) -> DataFrame:
    """Values of active records with their org and section: inner join on ``record_id``."""
    ctx = section_context(eav) if context is None else context
    return (
        eav.values.join(ctx.select("record_id", "org_id", "section_id"), "record_id", "inner")
        .select("org_id", "section_id", "record_id", "attribute_id", "value")
    )


def org_sections(context: DataFrame) -> DataFrame:
    """Distinct ``(org_id, section_id, section_name)`` that hold at least one active record."""
    return context.select("org_id", "section_id", "section_name").distinct()


def pipeline_counts(eav: Eav) -> DataFrame:
    """Row counts of active records, their values and the attribute definitions: ``(metric, n)``."""
    ctx = section_context(eav)

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")

    return (
        count(ctx, "records")
        .unionByName(count(values_with_context(eav, ctx), "values"))
        .unionByName(count(eav.attributes, "attributes"))
    )
