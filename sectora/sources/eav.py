"""Intake of the entity-attribute-value tables.

Source tables use their own column names (``id``, ``name``, ``is_deleted`` ...); intake
projects, renames and casts them to the engine's names and drops rows whose keys are
null. Everything stays lazy, so the projection reaches the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.sources.files import read_parquet

SOURCE_TABLES = ("provider_profile", "section", "attribute", "attribute_option", "attribute_value")


@dataclass(frozen=True)
class Eav:
    """The five normalised EAV tables."""

    records: DataFrame  # record_id, section_id, provider_id, org_id, record_is_deleted
    sections: DataFrame  # section_id, section_name, section_is_deleted, section_is_active
    attributes: DataFrame  # attribute_id, attribute_name, section_id, org_id, attribute_type
    options: DataFrame  # attribute_id, attribute_option_value
    values: DataFrame  # record_id, attribute_id, value


def project_records(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").cast("long").alias("record_id"),
        F.col("section_id").cast("long").alias("section_id"),
        F.col("provider_id").cast("long").alias("provider_id"),
        F.col("org_id").cast("long").alias("org_id"),
        F.col("is_deleted").cast("boolean").alias("record_is_deleted"),
    )


def project_sections(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").cast("long").alias("section_id"),
        F.col("name").cast("string").alias("section_name"),
        F.col("is_deleted").cast("boolean").alias("section_is_deleted"),
        F.col("is_active").cast("boolean").alias("section_is_active"),
    )


def project_attributes(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").cast("long").alias("attribute_id"),
        F.col("name").cast("string").alias("attribute_name"),
        F.col("section_id").cast("long").alias("section_id"),
        F.col("org_id").cast("long").alias("org_id"),
        F.col("type").cast("string").alias("attribute_type"),
    )


def project_options(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("attribute_id").cast("long").alias("attribute_id"),
        F.col("value").cast("string").alias("attribute_option_value"),
    )


def project_values(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("provider_profile_id").cast("long").alias("record_id"),
        F.col("attribute_id").cast("long").alias("attribute_id"),
        F.col("value").cast("string").alias("value"),
    )


def load_eav(raw: dict[str, DataFrame]) -> Eav:
    """Project/rename/cast the source tables and drop rows with null keys."""
    return Eav(
        records=project_records(raw["provider_profile"]),
        sections=project_sections(raw["section"]),
        attributes=project_attributes(raw["attribute"]).dropna(subset=["section_id", "attribute_id"]),
        options=project_options(raw["attribute_option"]).dropna(subset=["attribute_id", "attribute_option_value"]),
        values=project_values(raw["attribute_value"]).dropna(subset=["record_id", "attribute_id"]),
    )


def read_eav_parquet(spark: SparkSession, base_path: str) -> Eav:
    """Read ``<base>/<table>.parquet`` (file or folder, nested folders allowed) for the five tables."""
    base = base_path.rstrip("/")
    return load_eav({t: read_parquet(spark, f"{base}/{t}.parquet") for t in SOURCE_TABLES})
